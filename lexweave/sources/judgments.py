"""Judged tables, sampling conditions, re-read columns and built dictionaries, by their paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators.stages import read_head
from lexweave.sources import files
from lexweave.sources.pages import layout_lines

JUDGED = "no string, id string, skk_key string, notation string, reading string, method string, judgment string, note string"
META = "n int, seeds array<bigint>, dicts array<string>, sampled_at string, commit string, judge string, inputs string, human_check string, caveat string, population string"


def _with_path(spark: SparkSession, path: str, schema: str) -> DataFrame:
    x = files.tsv(spark, path, schema)
    return x.withColumn("path", F.input_file_name())


def judged(spark: SparkSession, path: str) -> DataFrame:
    """All judged tables under a path, with label (folder), name (file) and file_ord (by path)."""
    x = _with_path(spark, path, JUDGED)
    label, name = F.regexp_extract("path", "([^/]+)/[^/]+$", 1), F.regexp_extract("path", "([^/]+)\\.tsv$", 1)
    return x.withColumn("label", label).withColumn("name", name).withColumn("file_ord", F.col("path"))


def known_judgments(rows: DataFrame) -> DataFrame:
    """The last judgment, o or x, of each (id, skk_key, notation), by file and number; other rows don't count."""
    keys = ["id", "skk_key", "notation"]
    last = rows.where(F.col("judgment").isin("o", "x")).groupBy(*keys).agg(F.max_by(F.struct("judgment", "note"), F.struct("file_ord", F.col("no").try_cast("long"))).alias("j"))
    return last.select(*keys, "j.judgment", "j.note")


def accepted_judgments(rows: DataFrame) -> DataFrame:
    """(id, skk_key, notation) judged right; of spellings joined by a middle dot the first."""
    return rows.where("judgment = 'o'").select("id", "skk_key", F.split("notation", "・")[0].alias("notation")).distinct()


def sample_metas(spark: SparkSession, path: str) -> DataFrame:
    """Sampling conditions by label (folder), in order of time; no seeds is an empty list."""
    x = files._or_empty(spark, lambda: spark.read.schema(META).json(path, multiLine=True), META).withColumn("label", F.regexp_extract(F.input_file_name(), "([^/]+)/[^/]+$", 1))
    return x.withColumn("seeds", F.coalesce("seeds", F.array().cast("array<bigint>"))).orderBy("sampled_at", "label")


def rereadings(spark: SparkSession, path: str) -> DataFrame:
    """(id, text, reading, notation) of re-read columns, one XML file each, named by the entry's id."""
    x = files._or_empty(spark, lambda: spark.read.option("wholetext", True).text(path).withColumn("path", F.input_file_name()), "value string, path string")
    lines = layout_lines(x.select(F.regexp_extract("path", "([^/]+)\\.xml$", 1).alias("pid"), F.col("value").alias("xml")))
    return read_head(lines.select(F.col("pid").alias("id"), "y", "text"))


def dictionary_pairs(lines: DataFrame) -> DataFrame:
    """(key, word) of a built dictionary's lines, without notes."""
    x = lines.where(~F.col("line").startswith(";") & F.col("line").contains(" /"))
    at = F.instr("line", " /")
    words = F.filter(F.transform(F.split(F.substring("line", at + 2, F.length("line")), "/"), lambda w: F.split(w, ";")[0]), lambda w: w != "")
    return x.select(F.substring("line", F.lit(1), at - 1).alias("key"), F.explode(words).alias("word")).distinct()


def changed_pairs(old: DataFrame, new: DataFrame) -> DataFrame:
    """(side, key, word) added and removed between two builds."""
    return new.exceptAll(old).select(F.lit("added").alias("side"), "*").unionByName(old.exceptAll(new).select(F.lit("removed").alias("side"), "*"))
