"""Mirror as a stream of change rows.

Each micro-batch is written once, as its own partition of an append-only change log, so a
batch costs what it holds and not what the table holds, and a batch replayed after a
failure replaces exactly its own partition. The table's state is the latest row per key
over base and log, whatever the order in which late rows arrived.

Deletes are notices with a key and a time of their own. They join the stream of changes as
tombstones, rows marked ``DELETED`` without other values, so that a change and a delete are ordered
by time like two changes; a key whose latest row is a tombstone is not in the state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.windows import latest

BATCH = "batch_id"
DELETED = "is_deleted"


def read_changes(spark: SparkSession, folder: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(folder)


def drop_repeats(changes: DataFrame, keys: Sequence[str], updated: str, delay: str = "1 day") -> DataFrame:
    """Identical change rows delivered again within the delay are dropped by state."""
    event = "__event_time"
    # Watermarks want a zoned timestamp; the session zone is UTC.
    marked = changes.withColumn(event, F.col(updated).cast("timestamp")).withWatermark(event, delay)
    return marked.dropDuplicatesWithinWatermark([*keys, updated]).drop(event)


def with_deletes(changes: DataFrame, notices: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Changes and delete notices (keys and the columns of ``order``) as one stream, or one frame, of log rows."""
    named = [*keys, *order]
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in changes.schema if f.name not in named]
    stones = notices.select(*named, *blank, F.lit(True).alias(DELETED))
    return changes.withColumn(DELETED, F.lit(False)).unionByName(stones)


def write_change_log(changes: DataFrame, log: str, checkpoint: str, keys: Sequence[str],
                     order: Sequence[str | Column]) -> StreamingQuery:
    """Start the stream and process what is there; in a batch the last row per key counts."""

    def land(batch: DataFrame, number: int) -> None:
        rows = latest(batch, keys, order).withColumn(BATCH, F.lit(number).cast("bigint"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH).parquet(log))

    return (changes.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_state(base: DataFrame | None, log: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """Latest row per key over the stored base and the change log; deleted keys are left out."""
    rows = log.drop(BATCH)
    deletes = DELETED in rows.columns
    if base is not None:
        base = base.withColumn(DELETED, F.lit(False)) if deletes and DELETED not in base.columns else base
        rows = base.select(*rows.columns).unionByName(rows)
    out = latest(rows, keys, order)
    return out.filter(~F.coalesce(DELETED, F.lit(False))).drop(DELETED) if deletes else out


def compact(base: DataFrame | None, log: DataFrame, keys: Sequence[str],
            order: Sequence[str | Column], path: str) -> None:
    """State written as a new base; the log it covers can then be retired."""
    current_state(base, log, keys, order).write.mode("errorifexists").parquet(path)
