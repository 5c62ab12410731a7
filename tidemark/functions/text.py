"""Text helpers."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import col

# Characters removed from column names.
NAME_NOISE = " /():.+\n-*&,"


def plain_name(name: str) -> str:
    """Column name without accents and without the characters above (driver side)."""
    decomposed = unicodedata.normalize("NFD", name.replace("đ", "d").replace("Đ", "D"))
    return "".join(ch for ch in decomposed
                   if not unicodedata.combining(ch) and ch not in NAME_NOISE)


def squash(c: str | Column) -> Column:
    """White space removed at both ends."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def match_key(c: str | Column) -> Column:
    """Form under which loosely typed names are compared."""
    return F.upper(F.trim(col(c)))


def none_if_blank(c: str | Column) -> Column:
    return F.when(~col(c).rlike(r"^\s*$"), col(c))


def token(c: str | Column, sep: str, n: int) -> Column:
    """n-th piece (0-based) of a text cut at a literal separator; null when there is none."""
    return F.get(F.split(col(c), _literal(sep)), F.lit(n))


def pieces(c: str | Column, sep: str = ",") -> Column:
    """All pieces with the blanks around them removed (an empty text is one empty piece)."""
    tight = F.regexp_replace(F.trim(col(c)), rf"\s*{_literal(sep)}\s*", sep)
    return F.split(tight, _literal(sep))


def joined_key(*cols: str | Column) -> Column:
    """Composite key where a null part counts as empty text."""
    return F.concat_ws("", *[col(c).cast("string") for c in cols])


def strict_key(*cols: str | Column) -> Column:
    """Composite key that is null as soon as one part is."""
    return F.concat(*[col(c).cast("string") for c in cols])


def address(*parts: str | Column, sep: str = ", ") -> Column:
    """Non-blank parts with separators only between them."""
    return F.concat_ws(sep, *[none_if_blank(F.trim(col(p))) for p in parts])


def scrub(c: str | Column, characters: str, by: str = " ") -> Column:
    """Each of the characters replaced."""
    return F.translate(col(c), characters, by * len(characters))


def url_path_level(c: str | Column, n: int) -> Column:
    """n-th path level (1-based) of a URL or path."""
    path = F.regexp_replace(col(c), r"^[a-zA-Z]+://[^/?#]*|[?#].*$", "")
    level = F.get(F.split(path, "/"), F.lit(n))
    return F.when(level != "", level)


def url_parameter(c: str | Column, name: str) -> Column:
    """Raw value of a query parameter; null when absent."""
    found = F.regexp_extract(col(c), rf"[?&]{name}=([^&#]*)", 1)
    return F.when(found != "", found)


def _literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\-" else ch for ch in sep)
