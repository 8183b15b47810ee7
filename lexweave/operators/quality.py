"""Judged accuracy, votes over re-readings, and updates by earlier judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import text as t

BARE = "[-ー・\\s]"


def accuracy(judged: DataFrame, name: str = "name") -> DataFrame:
    """(name, n, correct, rate, low, high, errors) from rows (name, id, judgment); a row without judgment is an error."""
    x = judged.withColumn("judgment", F.when(F.col("judgment").isin("o", "x"), F.col("judgment")).otherwise(F.raise_error(F.concat(F.lit("not judged: "), F.coalesce("id", F.lit("?"))))))
    x = x.groupBy(name).agg(F.count("*").alias("n"), F.count_if(F.col("judgment") == "o").alias("correct"), F.array_sort(F.collect_list(F.when(F.col("judgment") == "x", F.col("id")))).alias("errors"))
    low, high = t.wilson(F.col("correct"), F.col("n"))
    return x.select(name, "n", "correct", (F.col("correct") / F.col("n")).alias("rate"), low.alias("low"), high.alias("high"), "errors")


def vote_rereadings(readings: DataFrame) -> DataFrame:
    """(id, reading) from rows (id, system, reading), system 0 being the head: the reading most systems have, separators apart.

    A tie, an empty winner, or the head's own keep the head's reading; else the
    first system's reading of the winning form is taken. Ids without a head go.
    """
    bare = readings.withColumn("bare", F.coalesce(F.regexp_replace("reading", BARE, ""), F.lit("")))
    per = bare.groupBy("id", "bare").agg(F.count("*").alias("n"), F.min(F.struct("system", "reading")).alias("first"), F.max(F.when(F.col("system") == 0, True)).alias("is_head"), F.max(F.when(F.col("system") == 0, F.col("reading"))).alias("head"))
    whole = per.groupBy("id").agg(
        F.max("n").alias("top"),
        F.collect_list(F.struct("n", "bare", "first", "is_head")).alias("forms"),  # as many as systems
        F.max("head").alias("head"), F.max("is_head").alias("has_head"),
    )
    best = F.filter("forms", lambda f: f["n"] == F.col("top"))
    only = F.get(best, F.lit(0))
    keep = (F.size(best) > 1) | F.coalesce(only["is_head"], F.lit(False)) | (only["bare"] == "")
    return whole.where("has_head").select("id", F.when(keep, F.col("head")).otherwise(only["first"]["reading"]).alias("reading"))


def apply_judgments(clean: DataFrame, judged: DataFrame) -> DataFrame:
    """Unverified entries that were judged right become accepted, with a fix that says so. judged: (id, skk_key, notation)."""
    known = judged.select("id", "skk_key", "notation").distinct().withColumn("_judged", F.lit(True))
    x = clean.join(known, ["id", "skk_key", "notation"], "left")
    now = F.coalesce("_judged", F.lit(False)) & (F.col("status") == "unverified")
    fix = F.array(F.struct(F.lit("status").alias("field"), F.lit("unverified").alias("from"), F.lit("accepted").alias("to"), F.lit("judged").alias("reason")))
    fixes = F.coalesce("fixes", F.array().cast("array<struct<field:string,from:string,to:string,reason:string>>"))
    return x.withColumn("fixes", F.when(now, F.concat(fixes, fix)).otherwise(fixes)).withColumn("method", F.when(now, "judged").otherwise(F.col("method"))).withColumn("status", F.when(now, "accepted").otherwise(F.col("status"))).drop("_judged").select(*clean.columns)


def carry_over(sample: DataFrame, known: DataFrame) -> DataFrame:
    """Sample rows with the last earlier judgment and note of their (id, skk_key, notation), else empty cells. known has file_ord."""
    keys = ["id", "skk_key", "notation"]
    last = known.where(F.col("judgment").isin("o", "x")).groupBy(*keys).agg(F.max_by(F.struct("judgment", "note"), "file_ord").alias("_j"))
    x = sample.join(last, keys, "left")
    return x.withColumn("judgment", F.coalesce("_j.judgment", F.lit(""))).withColumn("note", F.coalesce("_j.note", F.lit(""))).drop("_j")


def digest(files: DataFrame) -> DataFrame:
    """(digest) of (path, content): the first 12 digits of the hash of all files' hashes, by path. Only hashes are gathered."""
    h = files.select("path", F.sha2("content", 256).alias("h"))
    return h.agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(F.struct("path", "h")))["h"], "\n").cast("binary"), 256), 1, 12).alias("digest"))


#: Ids of one range of digest_by_range.
DIGEST_BLOCK = 20_000


def digest_by_range(rows: DataFrame, group: str, id: str, block: int = DIGEST_BLOCK) -> DataFrame:
    """(group, digest) of rows with an integer id and a binary `content`: as `digest`, but of the hashes of ranges of `block` ids.

    Null content adds nothing; a group without any content has a null digest. Ids must be distinct within a group.
    """

    def over(k: str) -> Column:
        joined = F.array_join(F.array_sort(F.collect_list(F.struct(k, "_h")))["_h"], "\n")
        return F.when(F.count("_h") > 0, F.sha2(joined.cast("binary"), 256))

    h = rows.select(group, F.expr(f"`{id}` div {block}").alias("_block"), F.col(id).alias("_id"), F.sha2("content", 256).alias("_h"))
    ranges = h.groupBy(group, "_block").agg(over("_id").alias("_h"))
    return ranges.groupBy(group).agg(F.substring(over("_block"), 1, 12).alias("digest"))
