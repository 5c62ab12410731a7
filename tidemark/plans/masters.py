"""Masters and access: customers, staff, access matrix, plan, notes, discounts, loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.codes import label, staff_role
from tidemark.functions.dates import clamp_date, date_from_parts, parse_date
from tidemark.functions.nested import at, struct_fields
from tidemark.functions.numbers import to_number
from tidemark.functions.text import address, squash, token
from tidemark.operators.filters import blank
from tidemark.operators.joins import Dimension, alias_dimension, equi, one_per_key, star
from tidemark.operators.names import lower_names
from tidemark.operators.reshape import list_to_rows, melt
from tidemark.operators.sets import dedup, union_by_name
from tidemark.operators.windows import earliest, latest
from tidemark.sources.writers import audited

# Marketplace prices are stored multiplied by this.
PRICE_SCALE = 100_000


# ---- masters ---------------------------------------------------------------------------

def customer_master(customers: DataFrame, dims: Sequence[tuple[DataFrame, str, str, str, Sequence[str]]],
                    address_parts: Sequence[str], licence_end: str | None = None) -> DataFrame:
    """Customers with their dimensions, assembled address and clamped licence date.

    ``dims`` lists (dimension, customer column, dimension key, prefix, columns); each
    dimension is reduced to one row per key.
    """
    out = customers
    for dim, on, key, prefix, columns in dims:
        side = one_per_key(dim.select(key, *columns), key)
        out = alias_dimension(out, side, on, key, prefix, columns)
    out = out.withColumn("address", address(*address_parts))
    return out.withColumn(licence_end, clamp_date(licence_end)) if licence_end else out


# Shop types whose customers are group customers; labels of states and of invoicing.
GROUP_SHOPS = ("CHUOI", "CLC1", "CLC2", "CLC3", "CLC4", "INS1", "INS2", "INS3")
GROUP, NO_GROUP = "G", "No-G"
CUSTOMER_STATES = {"A": "Active", "I": "Inactive"}
OTHER_STATE = "Pending"


def first_invoices(links: DataFrame, invoices: DataFrame, customer: str, invoice: str) -> DataFrame:
    """The first active invoice address of each customer, with the address's columns."""
    active = equi(links.filter("active = 1").select(customer, invoice), invoices, invoice, "inner")
    return earliest(active, [customer], [invoice])


def coded_parts(parts: Mapping[str, str | None]) -> list[Column]:
    """Parts of an address: the name (key) if it is known, else the code (value); nothing for a blank code."""
    out = []
    for name, code in parts.items():
        known = F.coalesce(F.col(name), F.col(code).cast("string")) if code else F.col(name)
        out.append(F.when(~blank(F.coalesce(F.col(code).cast("string"), F.lit(""))), known) if code else known)
    return out


def full_customer_master(customers: DataFrame, links: DataFrame, invoices: DataFrame, dimensions: Sequence[Dimension],
                         customer: str, invoice: str, address_parts: Mapping[str, str | None],
                         invoice_parts: Mapping[str, str | None], invoice_columns: Sequence[str], shop: str, status: str,
                         group_customers: Sequence = ()) -> DataFrame:
    """Customers with their first active invoice address and all dimensions, two address texts, the label of
    their state and the group flag. The invoice's columns come before the dimensions, which may use them."""
    chosen = first_invoices(links, invoices, customer, invoice)
    out = star(customers, [Dimension(chosen, {customer: customer}, {c: c for c in (invoice, *invoice_columns)}), *dimensions])
    grouped = F.coalesce(F.col(shop).isin(*GROUP_SHOPS), F.lit(False)) | F.col(customer).isin(*group_customers)
    return out.withColumns({"address": address(*coded_parts(address_parts)), "invoice_address": address(*coded_parts(invoice_parts)),
                            "state_label": label(status, CUSTOMER_STATES, OTHER_STATE),
                            "group_flag": F.when(grouped, F.lit(GROUP)).otherwise(F.lit(NO_GROUP))})


def staff_hierarchy(staff: DataFrame, names: DataFrame, levels: Mapping[str, str],
                    fallbacks: Sequence[tuple[str, str]] = (), order: Sequence[str | Column] = ()) -> DataFrame:
    """Staff with the names of the people above them; a missing level takes the next one's.

    ``names``: user_name, first_name; ``levels`` maps an id column to its name column.
    """
    people = one_per_key(names.select("user_name", "first_name"), "user_name")
    out = staff
    for id_col, name_col in levels.items():
        out = alias_dimension(out, people, id_col, "user_name", f"__{id_col}_", ["first_name"])
        out = out.withColumnRenamed(f"__{id_col}_first_name", name_col)
    for name_col, from_col in fallbacks:
        out = out.withColumn(name_col, F.coalesce(F.col(name_col), F.col(from_col)))
    return earliest(out, ["staff"], list(order) or [c for c in out.columns if c != "staff"])


def role_master(staff: DataFrame) -> DataFrame:
    """``staff``: user_name, user_types, position, status."""
    return (staff.withColumn("active", F.coalesce((F.col("status") == "AC").cast("int"), F.lit(0)))
            .withColumn("role", staff_role("user_types", "position")))


def follower_list(followers: DataFrame, addresses: DataFrame, key: str) -> DataFrame:
    """Followers known to the address list, with their province."""
    return equi(followers, one_per_key(addresses, key), key, "left")


# ---- wide sheets -----------------------------------------------------------------------

def access_matrix(wide: DataFrame, ids: Sequence[str], staff: DataFrame, group_parts: Sequence[str],
                  person: str, report: str) -> DataFrame:
    """Who may see which report: sheet columns are staff groups, a filled cell grants access.

    The staff group is made of ``group_parts`` joined by dashes; one row per (report, person).
    A group of staff without a column of the sheet raises.
    """
    grants = melt(wide, ids, variable="staff_group", value="granted", drop_nulls=True)
    people = staff.withColumn("staff_group", F.concat_ws("-", *group_parts))
    missing = people.filter(~F.col("staff_group").isin(*[c for c in wide.columns if c not in ids])).first()
    if missing is not None:
        raise ValueError(f"the sheet has no column for the staff group {missing['staff_group']}")
    return equi(grants, people, "staff_group", "inner").select(report, person, "staff_group") \
        .groupBy(report, person).agg(F.min("staff_group").alias("staff_group"))


def production_plan(sheets: Sequence[DataFrame], ids: Sequence[str], days: Sequence[str], month: str,
                    product: str, order_level: Sequence[str]) -> DataFrame:
    """Day columns of the united month sheets as dated quantities, with the order-level columns.

    Cells that are no number are dropped; a day the month does not have gives no row.
    """
    both = union_by_name(sheets)
    both = both.filter(F.col(product).isNotNull())
    cells = melt(both.select(*ids, month, *days), [*ids, month], days, "__day", "__cell", drop_nulls=True)
    cells = (cells.withColumn("quantity", to_number("__cell").cast("bigint"))
             .withColumn("plan_date", date_from_parts(month, "__day"))
             .filter("quantity is not null and plan_date is not null").drop("__day", "__cell"))
    head = one_per_key(both.select(product, month, *order_level), [product, month])
    return equi(cells, head, [product, month], "left")


def consolidated_notes(weekly: DataFrame, ids: Sequence[str], weeks: Sequence[str], calendar: DataFrame,
                       others: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str | Column],
                       texts: Sequence[str], period: Sequence[str] = ()) -> DataFrame:
    """Payment notes of several inputs in one list, the last one per key and day.

    ``calendar``: the columns of ``period`` (a month, say, also among ``ids``), week, note_date.
    Week columns become dated notes; blanks at both ends go.
    """
    long = melt(weekly, ids, weeks, "week", "note", drop_nulls=True)
    dates = [*period, "week"]
    dated = equi(long, one_per_key(calendar, dates), dates, "inner").drop(*dates)
    rows = union_by_name([dated, *others])
    rows = rows.withColumns({c: squash(c) for c in texts}).filter(F.col("note").isNotNull())
    return dedup(rows, keys, order, "last")


def latest_notes(notes: DataFrame, customer: str, date: str, names: DataFrame) -> DataFrame:
    """Check report: the latest note per customer, with the customer's name."""
    last = latest(notes, [customer], [date, "note"])
    return equi(last, one_per_key(names, customer), customer, "left")


def discount_lines(discounts: DataFrame, keys: Sequence[str], list_col: str, promo: str,
                   values: Sequence[str], n: int = 3) -> DataFrame:
    """Promotions per order line: line lists become rows, repeats go, the first n (by promotion)
    become columns, and ``promotions`` tells how many there are. Of a promotion's differing
    texts the greatest counts."""
    line = [*keys, "line_ref"]
    rows = list_to_rows(discounts.select(*keys, list_col, promo, *values), list_col, "line_ref")
    rows = rows.groupBy(*line, promo).agg(F.max(F.struct(promo, *values)).alias("__p"))
    # Place and number in one pass: what is left per line are different promotions, a catalogue's worth.
    of_line = W.partitionBy(*line)
    rows = rows.withColumns({"__n": F.row_number().over(of_line.orderBy(promo)), "promotions": F.count(F.lit(1)).over(of_line)})
    wide = rows.filter(F.col("__n") <= n).groupBy(*line, "promotions").agg(
        *[F.max(F.when(F.col("__n") == i, F.col("__p"))).alias(f"__{i}") for i in range(1, n + 1)])
    return wide.select(*line, *[F.col(f"__{i}.{c}").alias(f"{c}{i}") for c in (promo, *values) for i in range(1, n + 1)],
                       "promotions")


# ---- landed files ----------------------------------------------------------------------

def ticket_rows(tickets: DataFrame, people: Mapping[str, Sequence[str]], custom: Mapping[str, int]) -> DataFrame:
    """Tickets with the fields of nested people and positional custom fields as columns."""
    out = tickets
    for name, fields in people.items():
        out = struct_fields(out, name, fields)
    out = out.withColumns({name: at("custom_fields", n, "value") for name, n in custom.items()})
    return out.drop("custom_fields")


def marketplace_items(items: DataFrame) -> DataFrame:
    """Item rows: prices scaled, the ``item::sku:shop`` key split, rating fields flattened."""
    out = items.withColumns({c: (F.col(c) / F.lit(PRICE_SCALE)) for c in ("price", "price_min", "price_max")})
    rest = token("key", "::", 1)
    return (out.withColumn("item_id", token("key", "::", 0)).withColumn("sku", token(rest, ":", 0))
            .withColumn("rating", F.col("item_rating.rating_star")).drop("item_rating", "key"))


def web_log_levels(log: DataFrame, path: str = "pathname", title: str = "title_page") -> DataFrame:
    """Path levels, title parts and the search keyword of a page title ``a | b: c``."""
    levels = {f"level_{i}": F.get(F.split(path, "/"), F.lit(i)) for i in range(1, 4)}
    second = token(title, "|", 1)
    return (log.withColumns(levels)
            .withColumn("title_1", F.trim(token(title, "|", 0)))
            .withColumn("title_2", F.trim(token(second, ":", 0)))
            .withColumn("keyword", F.when(F.col(title).contains(":"), F.trim(token(second, ":", 1)))))


@dataclass(frozen=True)
class LoadSpec:
    """Cleaning of one landed table."""

    rename: Mapping[str, str] = field(default_factory=dict)
    dates: Mapping[str, str] = field(default_factory=dict)     # column -> text pattern
    numbers: Mapping[str, str] = field(default_factory=dict)   # column -> type
    texts: Sequence[str] = ()                                  # trimmed
    blanks: Mapping[str, object] = field(default_factory=dict)  # fill values
    required: Sequence[str] = ()                               # rows without these are dropped
    derived: Mapping[str, Column] = field(default_factory=dict)
    keep: Sequence[str] = ()


def load_landed(df: DataFrame, spec: LoadSpec, as_of=None) -> DataFrame:
    """One parametrised load: rename, trim, parse, fill, require, derive, select, audit."""
    out = lower_names(df).withColumnsRenamed(dict(spec.rename))
    out = out.withColumns({c: squash(c) for c in spec.texts})
    out = out.withColumns({c: parse_date(c, p) for c, p in spec.dates.items()})
    out = out.withColumns({c: to_number(c, t) for c, t in spec.numbers.items()})
    out = out.fillna(dict(spec.blanks)) if spec.blanks else out
    out = out.dropna(subset=list(spec.required)) if spec.required else out
    out = out.withColumns(dict(spec.derived)) if spec.derived else out
    out = out.select(*spec.keep) if spec.keep else out
    return out if as_of is None else audited(out, as_of)


def carrier_report(sites: Sequence[tuple[DataFrame, str]], code: str, sep: str = "\t") -> DataFrame:
    """Reports of several sites under one schema; the order code is the part before a tab."""
    return union_by_name([df.withColumn("site", F.lit(site)).withColumn(code, token(code, sep, 0))
                  for df, site in sites])


def clean_error_text(c: str | Column, noise: Sequence[str], length: int | None = None) -> Column:
    """Error texts without markup and the listed phrases."""
    out = F.col(c) if isinstance(c, str) else c
    for phrase in noise:
        out = F.replace(out, F.lit(phrase), F.lit(""))
    out = F.trim(out)
    return F.substring(out, 1, length) if length else out


def access_log(log: DataFrame, captions: DataFrame, screen: str = "screen") -> DataFrame:
    """System-access rows with the caption of the screen."""
    return equi(log, one_per_key(captions, screen), screen, "left")
