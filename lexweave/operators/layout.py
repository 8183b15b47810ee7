"""Page layout: tiers of a column page, heads on tiers, the second reader's heads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import kana


def greedy_peaks(bins: DataFrame, group: Sequence[str], value: str, n: str, least: int, gap: int) -> DataFrame:
    """(group, peaks): bins by falling count (ties: `first`, if there, else the value), kept if `gap` from all kept ones, ascending.

    A group has as many bins as its range has, a few hundred.
    """
    tie = "first" if "first" in bins.columns else value
    ranked = bins.where(F.col(n) >= least).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct((-F.col(n)).alias("n"), F.col(tie).alias("tie"), F.col(value).alias("v")))).alias("_b"))
    kind = dict(bins.dtypes)[value]
    far = lambda kept, v: F.forall(kept, lambda k: F.abs(k - v) >= gap)
    peaks = F.aggregate("_b", F.array().cast(f"array<{kind}>"), lambda kept, b: F.when(far(kept, b["v"]), F.concat(kept, F.array(b["v"]))).otherwise(kept))
    return ranked.select(*group, F.array_sort(peaks).alias("peaks"))


def upper_median_by_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, median): sorted[floor(n / 2)], from counts of distinct values. Nulls don't count."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*group)
    upto = F.sum("_n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    at = counts.withColumn("_upto", upto).withColumn("_half", F.floor(F.sum("_n").over(w) / 2))
    return at.where("_upto > _half").groupBy(*group).agg(F.min(value).alias("median"))


@dataclass(frozen=True)
class Heads:
    """Pixels, and lines of a tier."""

    bin: int = 10
    least: int = 5
    gap: int = 300
    margin: int = 60


@dataclass(frozen=True)
class SecondReader:
    bin: int = 10
    least: int = 6
    gap: int = 300
    above: tuple[int, int] = (12, 65)
    width: float = 1.1
    below: tuple[int, int] = (-10, 60)


def with_side(lines: DataFrame) -> DataFrame:
    """Add side: R for lines whose centre is in the right half of the page (the page's width, or its rightmost edge)."""
    page = Window.partitionBy("pid", "frame")
    width = F.coalesce(F.max("page_width").over(page), F.greatest(F.max(F.col("x") + F.col("width")).over(page), F.lit(0)))
    return lines.withColumn("side", F.when(F.col("x") + F.col("width") / 2 >= width / 2, "R").otherwise("L"))


def tiers(sided: DataFrame, size: int, least: int, gap: int) -> DataFrame:
    """(pid, frame, side, peaks) of where lines begin."""
    keys = ["pid", "frame", "side"]
    bins = sided.groupBy(*keys, (F.floor(F.col("y") / size) * size).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.min("line_idx").alias("first"))
    return greedy_peaks(bins, keys, "bin", "n", least, gap)


def _nearest(peaks: Column, y: Column) -> Column:
    return F.coalesce(F.array_min(F.transform(peaks, lambda t, i: F.struct(F.abs(y - t).alias("d"), i.alias("i"))))["i"], F.lit(0))


def extract_candidates(lines: DataFrame, p: Heads = Heads()) -> DataFrame:
    """Heads in reading order, with ids.

    lines: pid, frame, page_width, line_idx, text, x, y, width, height, conf.
    Right side first, then the nearest tier, then from right to left.
    """
    sided = with_side(lines)
    x = sided.join(tiers(sided, p.bin, p.least, p.gap), ["pid", "frame", "side"], "left").withColumn("head", kana.parse_head(F.col("text"))).where("head IS NOT NULL")
    peaks = F.coalesce("peaks", F.array().cast("array<int>"))
    on = F.filter(F.transform(peaks, lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda s: F.abs(F.col("y") - s["t"]) <= p.margin)
    x = x.withColumn("_on", F.get(on, F.lit(0))).withColumn("_near", _nearest(peaks, F.col("y")))
    order = Window.partitionBy("pid", "frame").orderBy(F.when(F.col("side") == "R", 0).otherwise(1), "_near", F.desc("x"), "line_idx")
    return x.select(
        F.format_string("%s-%03d-%04d", "pid", "frame", F.row_number().over(order)).alias("id"), "pid", "frame", "side",
        (F.col("_on.i") + 1).alias("tier"), (F.col("y") - F.col("_on.t")).alias("offset"),
        "head.reading", "head.notation", F.when(F.col("head.notation").isNotNull(), "written").otherwise("none").alias("notation_kind"), "head.kango", "head.pos",
        F.col("text").alias("line"), "conf", F.struct("x", "y", "width", "height").alias("bbox"),
    )


def extract_second_reader(lines: DataFrame, p: SecondReader = SecondReader()) -> DataFrame:
    """(pid, frame, x, y, reading, notation, ord): wide lines of kana a little above a tier, with the piece below each."""
    sided = with_side(lines).withColumn("_c", F.col("x") + F.col("width") / 2)
    keys = ["pid", "frame", "side"]
    heads = sided.join(tiers(sided, p.bin, p.least, p.gap), keys).join(upper_median_by_counts(sided, keys, "width"), keys)
    reading = F.regexp_replace("text", "\\s", "")
    above = lambda t: (t - F.col("y")).between(*p.above)
    heads = heads.withColumn("reading", reading).where(F.col("reading").rlike("^[ぁ-ゖゝゞァ-ヺー\\-－‐・]+$") & (F.col("width") >= F.col("median") * p.width) & F.exists("peaks", above))
    other = sided.select(*keys, F.col("line_idx").alias("_i"), F.col("_c").alias("_c2"), F.col("y").alias("_y2"), F.col("text").alias("_t"))
    near = (F.abs(F.col("_c2") - F.col("_c")) <= F.col("width") / 2) & (F.col("_y2") - F.col("y") - F.col("height")).between(*p.below) & (F.col("_i") != F.col("line_idx"))
    # lines of one half page only: the equal keys bound the pairs
    below = heads.join(other, keys).where(near).groupBy("pid", "frame", "side", "line_idx").agg(F.min(F.struct("_y2", "_i", "_t")).alias("_n"))
    trimmed = F.regexp_replace(F.regexp_replace("_n._t", "\\s", ""), "^[一{｛【〔\\[（(|｜]+|[}｝】〕\\]）)|｜]+$", "")
    notation = F.when(trimmed.rlike(f"[{kana.HAN}]"), trimmed)
    ordinal = F.struct(F.when(F.col("side") == "R", 0).otherwise(1).alias("side"), F.col("line_idx").alias("line"))
    return heads.join(below, [*keys, "line_idx"], "left").select("pid", "frame", "x", "y", "reading", notation.alias("notation"), ordinal.alias("ord"))


def link_readers(candidates: DataFrame, second: DataFrame, dx: int = 40, dy: int = 60) -> DataFrame:
    """Each candidate with the second reader's entry of its page within (dx, dy), the nearest in x, then the first; null without."""
    a = candidates.select("id", "pid", "frame", F.col("bbox.x").alias("_x"), F.col("bbox.y").alias("_y"))
    b = second.select("pid", "frame", F.col("x").alias("_x2"), F.col("y").alias("_y2"), F.struct("reading", "notation").alias("ndl"), "ord")
    pairs = a.join(b, ["pid", "frame"]).where((F.abs(F.col("_x") - F.col("_x2")) <= dx) & (F.abs(F.col("_y") - F.col("_y2")) <= dy))
    best = pairs.groupBy("id").agg(F.min_by("ndl", F.struct(F.abs(F.col("_x") - F.col("_x2")), "ord")).alias("ndl"))
    return candidates.join(best, "id", "left")
