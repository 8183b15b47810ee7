"""Readers with fixed schemas; a missing path is an empty table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _or_empty(spark: SparkSession, read, schema: str | StructType) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def numbered_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(path, line_no, line) of text files, each read whole: line numbers, and any Python encoding. For lexicons of some MB."""
    files = _or_empty(spark, lambda: spark.read.format("binaryFile").load(path), "path string, modificationTime timestamp, length long, content binary")

    @F.pandas_udf("string")
    def decode(content):
        return content.map(lambda b: bytes(b).decode(encoding, "replace"))

    return files.select("path", F.posexplode(F.split(decode("content"), "\r?\n")).alias("line_no", "line"))


def elements(spark: SparkSession, path: str, end: str) -> DataFrame:
    """(value): XML text cut after each `end` tag, undeclared entities left as they are. Large files are split by Spark."""
    return _or_empty(spark, lambda: spark.read.option("lineSep", end).text(path), "value string")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _or_empty(spark, lambda: spark.read.schema(schema).json(path), schema)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table with a header line; missing cells are empty."""
    x = _or_empty(spark, lambda: spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", escape=""), schema)
    return x.na.fill("")


def page_ranges(spec: str, column: str = "frame"):
    """`1-3,7` as a condition; an empty one holds always."""
    tests = [F.col(column).between(int(a), int(b or a)) for a, _, b in (p.partition("-") for p in spec.split(",") if p.strip())]
    out = F.lit(not tests)
    for t in tests:
        out = out | t
    return out


def stale(fetched_at, days: int = 7):
    """Whether an ISO time, or none, is older than some days."""
    return fetched_at.isNull() | (F.to_timestamp(fetched_at) < F.current_timestamp() - F.make_dt_interval(F.lit(days)))
