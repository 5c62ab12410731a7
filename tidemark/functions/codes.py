"""Code-to-label rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import col

# Staff roles, tried in this order.
ROLE_BY_TYPE_FIRST = ("LOG", "LOG")
ROLE_DIRECTORS = ("D", "SD", "AD", "RD")
ROLE_DIRECTORS_LABEL = "MDS"
ROLE_BY_TYPE_SECOND = ("CS", "CS")
ROLE_SALES = ("S", "SS", "AM", "RM")
ROLE_SALES_LABEL = "P.BH"

# Delivery status by code; anything else counts as not confirmed.
DELIVERY_STATUS = {
    "C": "Đã giao hàng",
    "H": "Chưa Xác Nhận",
    "D": "KH Không Nhận",
    "A": "Đã Xác Nhận",
    "R": "Từ Chối Giao Hàng",
}
DELIVERY_UNKNOWN = "Chưa Xác Nhận"
DELIVERED = "Đã giao hàng"
WITH_CARRIER = "Giao NVC"
CARRIER_UNIT = "Nhà vận chuyển"

# Payment forms that count as cash.
CASH_FORMS = ("B", "C")
CASH, TRANSFER = "TM", "CK"


def label(c: str | Column, mapping: Mapping, default=None, keep_unknown: bool = False) -> Column:
    """Label of a code from a small fixed map; unknown codes get the default (or stay)."""
    c = col(c)
    out = None
    for code, text in mapping.items():
        out = F.when(c == F.lit(code), F.lit(text)) if out is None else out.when(c == F.lit(code), F.lit(text))
    rest = c if keep_unknown else F.lit(default)
    return rest if out is None else out.otherwise(rest)


def replace_values(c: str | Column, mapping: Mapping) -> Column:
    """Value list replaced, everything else kept."""
    return label(c, mapping, keep_unknown=True)


def first_known(*cols: str | Column, default="") -> Column:
    """First non-null of ordered columns (latest week first)."""
    return F.coalesce(*[col(c) for c in cols], F.lit(default))


def later_of(a: str | Column, b: str | Column) -> Column:
    return F.greatest(col(a), col(b))


def payment_class(c: str | Column) -> Column:
    return F.when(col(c).isin(*CASH_FORMS), F.lit(CASH)).otherwise(F.lit(TRANSFER))


def delivery_status(c: str | Column) -> Column:
    return label(c, DELIVERY_STATUS, DELIVERY_UNKNOWN)


def staff_role(user_types: str | Column, position: str | Column) -> Column:
    """Role of a staff member from the type text and the position code."""
    types, position = col(user_types), col(position)
    first, first_label = ROLE_BY_TYPE_FIRST
    second, second_label = ROLE_BY_TYPE_SECOND
    # A missing type text satisfies neither LIKE nor NOT LIKE.
    return (F.when(types.contains(first), F.lit(first_label))
            .when(position.isin(*ROLE_DIRECTORS) & ~types.contains(first), F.lit(ROLE_DIRECTORS_LABEL))
            .when(types.contains(second), F.lit(second_label))
            .when(position.isin(*ROLE_SALES), F.lit(ROLE_SALES_LABEL))
            .otherwise(position))


def any_of(c: str | Column, values: Iterable) -> Column:
    """Membership that is false, not null, for a missing value."""
    return F.coalesce(col(c).isin(*values), F.lit(False))
