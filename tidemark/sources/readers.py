"""Sources. Schemas are declared; nothing is inferred in a production path."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.functions.dates import on_days
from tidemark.operators.names import rename_all
from tidemark.operators.sets import union_by_name


def jdbc_options(url: str, query: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000,
                 partition: tuple[str, str, str, int] | None = None) -> dict[str, str]:
    """Reader options of a query on a database.

    ``partition`` = (column, lower, upper, number) splits a large read over tasks; such a
    read has to be given as a derived table instead of a query.
    """
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partition is None:
        options["query"] = query
    else:
        column, lower, upper, number = partition
        options |= {"dbtable": f"({query}) src", "partitionColumn": column,
                    "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(number)}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[key] = value
    return options


def read_database(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()


def read_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text over the given frames."""
    return spark.sql(text, **tables) if tables else spark.sql(text)


def report_source(table: DataFrame, date: str, first, last) -> DataFrame:
    """A procedure called with (from, to) days: the same rows as a filtered table."""
    return table.filter(on_days(date, first, last))


def report_function(spark: SparkSession, name: str, table: DataFrame, date: str, parameters: Sequence[tuple[str, str]] = (),
                    condition: str = "true") -> str:
    """A procedure as a SQL table function ``name(first_day, last_day, …)``: rows of the days, both included.

    Further parameters (name, type) may occur in ``condition``. The optimizer inlines the function, so its
    arguments reach the scan as filters.
    """
    view = f"__{name}_rows"
    table.createOrReplaceTempView(view)
    args = ", ".join(f"{n} {t}" for n, t in [("first_day", "DATE"), ("last_day", "DATE"), *parameters])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS TABLE({columns})
        RETURN SELECT * FROM {view} WHERE `{date}` >= {name}.first_day AND `{date}` < date_add({name}.last_day, 1) AND ({condition})""")
    return name


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str | StructType, *,
             day_first: bool = True, header: bool = True, columns: Sequence[str] | None = None,
             **options) -> DataFrame:
    """CSV with a declared schema, so codes keep their leading zeros.

    Date columns of the schema are read day first unless told otherwise.
    """
    dates = {"dateFormat": "dd/MM/yyyy"} if day_first else {}
    reader = spark.read.schema(schema).options(header=str(header).lower(), **dates, **options)
    out = reader.csv(paths if isinstance(paths, str) else list(paths))
    return out.select(*columns) if columns else out


# A link table is a list kept by hand; longer ones are refused, never cut.
MAX_LINKS = 10_000


def read_linked_csvs(spark: SparkSession, links: DataFrame, path_col: str,
                     schemas: str | dict[str, str], **options) -> DataFrame:
    """All files named in a small link table, united by name.

    One scan when all files share a schema; otherwise one scan per distinct schema.
    """
    paths = sorted(r[0] for r in links.select(path_col).distinct().limit(MAX_LINKS + 1).collect())
    if not paths:
        raise ValueError("the link table names no file")
    if len(paths) > MAX_LINKS:
        raise ValueError(f"the link table names more than {MAX_LINKS} files; give their folder instead")
    if isinstance(schemas, str):
        return read_csv(spark, paths, schemas, **options)
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(schemas[p], []).append(p)
    return union_by_name([read_csv(spark, ps, s, **options) for s, ps in groups.items()])


def promote_header(df: DataFrame, marker: Column) -> DataFrame:
    """The rows matching ``marker`` become the column names and leave the data.

    They are found by content, since row order is not a property of a distributed file; every
    file may bring its own header, as long as all of them are equal.
    """
    found = df.filter(marker).distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError("exactly one header must match")
    names = [str(v) for v in found[0]]
    return rename_all(df.filter(~F.coalesce(marker, F.lit(False))), names)


def read_payload(spark: SparkSession, path: str, schema: str | StructType, array: str,
                 whole_files: bool = False) -> DataFrame:
    """Landed API pages, one JSON object per line (or per file), to one row per array element."""
    pages = spark.read.schema(schema).option("multiLine", str(whole_files).lower()).json(path)
    return pages.select(F.explode(array).alias("__row")).select("__row.*")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table (settings, maps), of known size for the join planner."""
    fields = StructType.fromDDL(schema)
    columns = zip(*rows) if rows else [() for _ in fields]
    arrow = pa.table([pa.array(list(c), t.type) for c, t in zip(columns, to_arrow_schema(fields))],
                     names=fields.names)
    return spark.createDataFrame(arrow, fields)


def day_extract(table: DataFrame, date: str, on) -> DataFrame:
    """All rows of one day, tagged with that day for a partitioned file."""
    return table.filter(on_days(date, on, on)).withColumn("dt", F.to_date(date))
