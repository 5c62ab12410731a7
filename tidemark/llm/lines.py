"""Line dedup: lines that many documents share are dropped from all of them.

Normalised lines are exploded and hashed, documents are counted per hash, and the lines of
frequent hashes are left out when the text is put together again by position. Only hashes,
ids and positions are shuffled by line; texts move once, to meet their dropped positions.

Defined cases: a null or empty text is one empty line; lines without a character but white
space have no key and always stay; rows that repeat an id count as one document, all rows
without an id as one; a document that loses all lines keeps the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import SPACE, ascii_lower, carried, let, released, text_key
from tidemark.sources.scratch import written


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _keep(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped positions (sorted), in order; linear in the lines."""
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    return let(F.struct(lines.alias("l"), bounds.alias("b")), lambda s: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(s["b"]) - 2),
        lambda i: F.slice(s["l"], s["b"][i] + 2, s["b"][i + 1] - s["b"][i] - 1))))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows with their text cut, and ``n_lines`` (before), ``n_dropped``."""
    rows = carried(docs).withColumn("id", F.col(f"row.`{id_col}`")) \
        .withColumn("tkey", text_key(F.col(f"row.`{text_col}`")))
    text = F.col(f"row.`{text_col}`")
    keyed = written(rows.select("id", "tkey", F.posexplode(split_lines(text)).alias("pos", "line"))
                    .withColumn("key", line_key(F.col("line")))
                    .where(F.length("key") >= max(1, min_chars))
                    .select("id", "tkey", "pos", F.unhex(F.md5("key")).alias("h")), "line-keys")
    # One row per line and document first, so that a line of a third of all documents is counted in many tasks.
    # Written, so that the join below shuffles both sides itself and Spark can split a hot hash.
    common = written(keyed.select("h", "id").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") >= min_docs).select("h"), "common-lines")
    dropped = (keyed.join(common, "h").groupBy(F.col("id").alias("d_id"), F.col("tkey").alias("d_tkey"))
               .agg(F.sort_array(F.collect_set("pos")).alias("dropped")))
    joined = rows.join(dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("tkey") == F.col("d_tkey")), "left")
    gone = F.coalesce(F.col("dropped"), F.array().cast("array<int>"))
    lines = split_lines(text)
    cut = F.when(F.col("dropped").isNull(), F.coalesce(text, F.lit(""))) \
        .otherwise(F.array_join(_keep(lines, gone), "\n"))
    return released(joined, **{text_col: cut, "n_lines": F.size(lines).cast("bigint"),
                               "n_dropped": F.size(gone).cast("bigint")})
