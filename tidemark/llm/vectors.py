"""What the vector operators share: vectors as whole numbers, and as arrays inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64


def whole_numbers(df: DataFrame, id_col: str, vector_col: str, offset: int = 0, size: int | None = None) -> DataFrame:
    """``id`` and ``x``: floor(64 * component) + offset, of the vectors that are not null or empty and have
    neither null nor non-finite components (and, with ``size``, exactly that many)."""
    v = F.col(f"`{vector_col}`")
    # A null compares as unknown, a NaN as greater than everything.
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    length = F.size(v) == size if size is not None else F.size(v) > 0
    x = F.transform(v, lambda c: F.floor(SCALE * c.cast("double")) + F.lit(offset).cast("bigint"))
    return df.where(v.isNotNull() & length & fits).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), x.alias("x"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A column of lists of ``size`` numbers as rows of a matrix."""
    return np.asarray(column.flatten()).reshape(len(column), size)


def packed(x: np.ndarray) -> bytes:
    """Rows as bytes, in the narrowest of 16, 32 and 64 bits that holds them; the first byte tells which."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    for width, kind in ((2, "<i2"), (4, "<i4"), (8, "<i8")):
        if -(1 << 8 * width - 1) <= low and high < 1 << 8 * width - 1:
            return bytes([width]) + x.astype(kind).tobytes()
    raise AssertionError("64 bits hold every long")


def unpacked(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).reshape(-1, size).astype(np.int64)
