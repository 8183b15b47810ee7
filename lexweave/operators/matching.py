"""Joins of the linkage core: first match by rank, bands, nearest values, none-of-the-forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_match(candidates: DataFrame, keys: Sequence[str], rank: Sequence[str | Column], keep: Sequence[str]) -> DataFrame:
    """Of each key's candidates the one of the smallest rank tuple (method, option, variant, form).

    One aggregate with map-side combine; no window, so that a key with very
    many candidates is never sorted.
    """
    order = [F.col(r) if isinstance(r, str) else r for r in rank]
    packed = F.struct(*[c.alias(f"_r{i}") for i, c in enumerate(order)], *[F.col(c) for c in keep])
    best = candidates.groupBy(*keys).agg(F.min(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in keep])


def band_join(left: DataFrame, right: DataFrame, equal: Sequence[str], x: tuple[str, str], width: int) -> DataFrame:
    """Inner pairs with equal keys and |left.x - right.x| <= width.

    Both sides are cut into cells of `width`; the left side looks into its cell
    and both neighbours, so that the join is an equi-join on (keys, cell) and a
    hot key spreads over its cells.
    """
    cell = lambda c: F.floor(F.col(c) / width)
    probe = left.withColumn("_cell", F.explode(F.array(cell(x[0]) - 1, cell(x[0]), cell(x[0]) + 1)))
    build = right.withColumn("_cell", cell(x[1]))
    joined = probe.join(build, [*equal, "_cell"]).drop("_cell")
    return joined.where(F.abs(F.col(x[0]) - F.col(x[1])) <= width)


def nearest_in_band(left: DataFrame, right: DataFrame, equal: Sequence[str], x: tuple[str, str], width: int, left_id: str, tie: str, keep: Sequence[str]) -> DataFrame:
    """Each left row with its nearest right row in the band, nulls without one; ties go to the smaller `tie`."""
    pairs = band_join(left, right, equal, x, width).withColumn("_d", F.abs(F.col(x[0]) - F.col(x[1])))
    best = first_match(pairs, [left_id], ["_d", tie], ["_d", *keep]).withColumnRenamed("_d", "distance")
    return left.join(best, left_id, "left")


def nearest_of(value: Column, marks: Sequence[float]) -> Column:
    """The mark nearest to the value; of two equally near ones the first given."""
    best = F.array_min(F.array(*(F.struct(F.abs(value - F.lit(m)).alias("d"), F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in enumerate(marks))))
    return best["m"]


def none_of_forms(items: DataFrame, item_id: str, forms: str, base: DataFrame, word: str) -> DataFrame:
    """Items (id, array of forms) of which no form is a word of base. Items without forms stay."""
    hit = items.select(item_id, F.explode(forms).alias(word)).distinct().join(base.select(word).distinct(), word, "left_semi").select(item_id).distinct()
    return items.join(hit, item_id, "left_anti")


def hamming_one(a: Column, b: Column) -> Column:
    """Whether two strings of one length differ in one character."""
    chars = lambda s: F.split(s, "")
    off = F.aggregate(F.zip_with(chars(a), chars(b), lambda p, q: F.when(p == q, 0).otherwise(1)), F.lit(0), lambda s, d: s + d)
    return (F.length(a) == F.length(b)) & (off == 1)


def deletions(s: Column) -> Column:
    """The string with each one character left out, with the place: strings one substitution apart share an entry."""
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(i.cast("string"), F.lit(":"), F.substring(s, F.lit(1), i - 1), F.lit("_"), F.substring(s, i + 1, F.length(s))))


def both_directions(edges: DataFrame, a: str, b: str) -> DataFrame:
    """An undirected relation: each edge both ways, once, without loops."""
    swapped = edges.select(F.col(b).alias(a), F.col(a).alias(b))
    return edges.select(a, b).unionByName(swapped).where(F.col(a) != F.col(b)).distinct()


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; Spark cuts each task's rows to k a group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)
