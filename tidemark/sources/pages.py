"""Paged sources: an interface that answers page by page and declares how many rows there are.

Every page is an input partition of a Python data source, so pages are fetched by the tasks, side by
side, and a lost task fetches its page again. Rows of a run are written before they are counted;
pages that came short of what the first page declares are planned anew, alone, until all are
complete or the attempts are used up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.operators.quality import QualityError
from tidemark.operators.sets import union_by_name
from tidemark.sources.scratch import written

PAGE = "__page"
# (page, attempt) -> (declared rows of all pages, rows of this page); called in the tasks.
Fetch = Callable[[int, int], tuple[int, Sequence[tuple]]]


@dataclass
class Page(InputPartition):
    number: int


def _source(fetch: Fetch, ddl: str, pages: Sequence[int], attempt: int) -> type[DataSource]:
    """A data source class of its own for one run: it carries its pages and how to fetch them."""

    class Reader(DataSourceReader):
        def partitions(self):
            return [Page(n) for n in pages]

        def read(self, partition) -> Iterator[tuple]:
            _, rows = fetch(partition.number, attempt)
            for row in rows:
                yield (partition.number, *row)

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tidemark_pages"

        def schema(self) -> str:
            return f"`{PAGE}` int, {ddl}"

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return Pages


def read_pages(spark: SparkSession, fetch: Fetch, schema: str, page_size: int, attempts: int = 3) -> DataFrame:
    """All rows of all pages, or an error that names the pages that stayed incomplete.

    The first page's declared number of rows tells how many pages there are and how many rows each must hold.
    """
    declared, _ = fetch(1, 0)
    pages = list(range(1, -(-declared // page_size) + 1))
    if not pages:
        return spark.createDataFrame([], schema)
    expected = {n: min(page_size, declared - (n - 1) * page_size) for n in pages}
    parts, missing = [], pages
    for attempt in range(attempts):
        spark.dataSource.register(_source(fetch, schema, missing, attempt))
        rows = written(spark.read.format("tidemark_pages").load(), "pages")
        got = {r[PAGE]: r["n"] for r in rows.groupBy(PAGE).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per page
        short = [n for n in missing if got.get(n, 0) != expected[n]]
        complete = rows.filter(~F.col(PAGE).isin(short)) if short else rows
        parts.append(complete.drop(PAGE))
        if not short:
            return union_by_name(parts)
        missing = short
    raise QualityError(f"pages {missing} are incomplete after {attempts} attempts")
