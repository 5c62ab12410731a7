"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; safe to apply to a session somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the consumer has to shuffle once more for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task sorts and joins about 20 times its bytes of a shuffle or file, and several operators of a
    # stage hold rows at once: small shares keep a task's memory the same however large the tables are.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "8m",
    # Enough to be put together from; a small shuffle still ends as a partition or two.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    # Recursive queries are bounded by their levels, not by the number of rows.
    "spark.sql.cteRecursionRowLimit": "-1",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings above; ``settings`` use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # No Python call site per column expression: plans build about a third faster.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
