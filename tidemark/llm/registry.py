"""Queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.base import Query, Tables
from tidemark.sources.scratch import put_bytes, shared_folder

registered: dict[str, Query] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(put_bytes(
            spark, f"{shared_folder(spark)}/py-files/{context.applicationId}", f"{package.name}.zip", archive.getvalue()))
        _shipped.add(context.applicationId)
    return spark


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; the session's settings are left as they are."""

    def register(fn: Callable[[Tables], DataFrame]):
        registered[name] = Query(lambda spark, folder: fn(Tables(ship(spark), folder)), sql)
        return fn

    return register
