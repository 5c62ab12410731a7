"""Where intermediate tables go, and how they go away again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one the session names for checkpoints, else its warehouse."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or \
        spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    folder = (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    if not named and not spark.sparkContext.master.startswith("local") and folder.startswith(("file:", "/")):
        raise ValueError(f"machines do not share {folder}: name a shared folder in {CHECKPOINT_SETTING}")
    return folder


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run under the shared folder."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, however often it is used,
    and still there when executors are lost. It stays until ``drop_scratch``."""
    folder = run_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """The names of the folders in a folder; none if it does not exist."""
    path, files = _path(spark, folder)
    if not files.exists(path):
        return []
    return [f.getPath().getName() for f in files.listStatus(path) if f.isDirectory()]


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


def put_bytes(spark: SparkSession, folder: str, name: str, content: bytes) -> str:
    """A file in the shared folder; its address."""
    path, files = _path(spark, f"{folder}/{name}")
    out = files.create(path)
    out.write(bytearray(content))
    out.close()
    return path.toString()


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has put into the shared folder, and the catalog's tables on it.

    For when its results have been read: frames made from these tables cannot be read again.
    """
    folder = application_folder(spark)
    for row in spark.sql("SHOW TABLE EXTENDED LIKE '*'").select("tableName", "isTemporary", "information").collect():
        if not row["isTemporary"] and folder.removeprefix("file:").lstrip("/") in row["information"]:
            spark.sql(f"DROP TABLE IF EXISTS `{row['tableName']}`")
    delete_folder(spark, folder)
