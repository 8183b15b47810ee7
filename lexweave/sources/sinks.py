"""Sinks: dictionaries with a header, TSV, count tables of a report, judged samples, EUC-JP."""

from __future__ import annotations

from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType

from lexweave.functions import text as t
from lexweave.operators import dictionary

# Rows of the character set that count, first and last; row 13 is a vendor's.
ROWS = ((1, 8), (16, 84))


@cache
def _encodable() -> frozenset[str]:
    out = set(map(chr, range(0x80)))
    for lo, hi in ROWS:
        for row in range(lo, hi + 1):
            for cell in range(1, 95):
                try:
                    out.add(bytes([0xA0 + row, 0xA0 + cell]).decode("euc_jp"))
                except UnicodeDecodeError:
                    continue
    return frozenset(out)


@F.pandas_udf(BooleanType())
def is_euc_jp(s: pd.Series) -> pd.Series:
    """Whether all characters are ASCII or in the two-byte set without vendor rows; null for null."""
    own = _encodable()
    return s.map(lambda x: None if x is None else all(c in own for c in x)).astype("boolean")


@F.pandas_udf(BinaryType())
def to_euc_jp(s: pd.Series) -> pd.Series:
    own = _encodable()

    def one(x: str | None) -> bytes | None:
        if x is None:
            return None
        bad = next((c for c in x if c not in own), None)
        if bad is not None:
            raise ValueError(f"not in the character set: {bad!r}")
        return x.encode("euc_jp")

    return s.map(one)


def encodable_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (section, key, word, note, ord) for EUC-JP: keys and words that it lacks go, notes are emptied; and the number of words that went under keys that stay."""
    x = entries.where(is_euc_jp("key")).withColumn("_word", is_euc_jp("word"))
    kept = x.where("_word").withColumn("note", F.when(is_euc_jp("note"), F.col("note")).otherwise(""))
    return kept.drop("_word"), x.agg(F.count_if(~F.col("_word")).alias("dropped"))


def dictionary_text(entries: DataFrame, header: list[str]) -> DataFrame:
    """(ord, line) of a dictionary file: header, then each section under its mark."""
    lines = dictionary.rendered(entries)
    rank = F.when(F.col("section") == "ari", 0).otherwise(1)
    body = lines.select(F.struct((rank * 2 + 2).alias("a"), F.when(F.col("section") == "ari", F.lit("")).otherwise(F.col("key")).alias("up"), F.col("key")).alias("ord"), "line")
    marks = [*((0, f"{i:06d}", h) for i, h in enumerate(header)), (1, "", ";; okuri-ari entries."), (3, "", ";; okuri-nasi entries.")]
    head = lines.sparkSession.createDataFrame(marks, "a int, up string, line string").select(F.struct("a", "up", F.lit("").alias("key")).alias("ord"), "line")
    whole = head.unionByName(body)
    # section ari has its keys in falling order
    return whole.orderBy("ord.a", "ord.up", F.when(F.col("ord.a") == 2, F.col("ord.key")).desc(), "ord.key")


def write_text(lines: DataFrame, path: str) -> None:
    """One file of sorted lines (column line). For dictionaries, whose size is that of a lexicon."""
    lines.select("line").coalesce(1).write.mode("overwrite").text(path)


TSV = ("id", "status", "method", "skk_key", "modern", "reading", "notation", "shinjitai", "pos_raw", "order", "reason", "source_reading", "source_notation", "fixes", "line", "crop")


def crop_url(base: str, pid: Column, frame: Column, bbox: Column, pad: int = 20, most_height: int = 400) -> Column:
    """The address of a padded crop of a page image; the height is limited before it is padded."""
    x, y = F.greatest(bbox["x"] - pad, F.lit(0)), F.greatest(bbox["y"] - pad, F.lit(0))
    return F.format_string(f"{base}/%s/R%07d/%d,%d,%d,%d/full/0/default.jpg", pid, frame, x, y, bbox["width"] + 2 * pad, F.least(bbox["height"], F.lit(most_height)) + 2 * pad)


def tsv_rows(clean: DataFrame, crop: Column) -> DataFrame:
    """Clean entries as flat cells, null as empty."""
    cells = {
        "pos_raw": F.col("pos.raw"), "source_reading": F.col("source.reading"), "source_notation": F.col("source.notation"), "fixes": t.flat_fixes(F.coalesce("fixes", F.array().cast("array<struct<field:string,from:string,to:string,reason:string>>"))),
        "line": F.col("source.line"), "crop": crop,
    }
    return clean.select(*[t.flat_cell(cells.get(c, F.col(c))).alias(c) for c in TSV])


def report(clean: DataFrame) -> DataFrame:
    """(table, value, n, share): counts by status, method, reason and so on; shares are of all rows, in every table, most frequent first."""
    tables = {
        "status": F.col("status"), "method": F.when(F.col("status") == "accepted", F.col("method")), "excluded": F.when(F.col("status") == "excluded", F.col("reason")),
        "unverified": F.when(F.col("status") == "unverified", F.coalesce("reason", F.lit("-"))), "order": F.col("order"), "pos": F.col("pos.category"),
    }
    one = F.array(*[F.struct(F.lit(k).alias("table"), v.alias("value")) for k, v in tables.items()])
    fixes = F.transform(F.coalesce("fixes", F.array().cast("array<struct<field:string,from:string,to:string,reason:string>>")), lambda x: F.struct(F.lit("fix").alias("table"), F.concat(x["field"], F.lit(": "), x["reason"]).alias("value")))
    # one pass; a row gives each table a value at most, and a fix table one for each fix
    long = clean.select(F.explode(F.concat(F.filter(one, lambda s: s["value"].isNotNull()), fixes)).alias("x")).select("x.*")
    counts = long.groupBy("table", "value").agg(F.count("*").alias("n"))
    total = Window.partitionBy(F.lit(1))
    rows = F.sum(F.when(F.col("table") == "status", F.col("n"))).over(total)
    return counts.withColumn("share", F.col("n") / rows).orderBy("table", F.desc("n"), "value")


def sample_rows(drawn: DataFrame, known: DataFrame) -> DataFrame:
    """Numbered sample rows with earlier judgments, in the columns of judged tables."""
    from lexweave.operators.quality import carry_over

    return carry_over(drawn, known).select("no", "id", "skk_key", "notation", "reading", "method", "judgment", "note").orderBy("no")


def upsert_section(table: DataFrame, new: DataFrame, label: str = "label") -> DataFrame:
    """Sections of a document by label: new ones replace old ones and come first."""
    old = table.join(new.select(label).distinct(), label, "left_anti")
    return new.withColumn("_new", F.lit(0)).unionByName(old.withColumn("_new", F.lit(1))).orderBy("_new", F.desc(label)).drop("_new")
