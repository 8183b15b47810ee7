"""Written tables that cut lineage: they live in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only on one machine, as in tests, where the session names no folder.
LOCAL_FALLBACK = "/tmp/checkpoints"
_WRITTEN: list[tuple[str, str | None]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a local one on a local master, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (named or LOCAL_FALLBACK).rstrip("/")


def materialize(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    A lost executor costs at most a re-read, never the work behind the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    note_written(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def note_written(path: str, table: str | None = None) -> None:
    """Remember a written table, for `clear`."""
    _WRITTEN.append((path, table))


def clear(spark: SparkSession) -> int:
    """Delete what this process has written so far; call it when results that read it are stored. Gives the number of tables."""
    n = 0
    while _WRITTEN:
        path, table = _WRITTEN.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        n += bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True))
    return n
