"""What the operators share: rows carried whole, text keys, tables written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of all contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def carried(docs: DataFrame) -> DataFrame:
    """The frame as one column ``row``: its own names can then clash with nothing."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def released(df: DataFrame, **added: Column) -> DataFrame:
    """The columns of ``row`` again, then the added ones; an added column replaces one of its name."""
    kept = [c for c in df.schema["row"].dataType.names if c not in added]
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *[c.alias(n) for n, c in added.items()])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, also where lambdas refer to it."""
    return F.transform(F.array(value), use)[0]


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; a null text has the key of the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
