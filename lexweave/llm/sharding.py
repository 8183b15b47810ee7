"""Hierarchical weighted hash tree: regions hold racks, racks hold shards.

A document descends the tree. At each level every child draws -ln(u) / weight,
with u a hash of (doc_id, the child's own id), and the smallest draw wins, so
that a child's share is proportional to the weight below it. A changed weight
changes only that child's draw: rows move into (or out of) the subtree whose
weight changed and nowhere else.

Layout: `base` shards fill racks of `rack` and regions of `racks` racks. Shards
added later each open a region of their own, so that what moves on growth can
land only in the added shard.

Only DataFrame expressions are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.storage import materialize

#: Rows that one window task of the slot numbering gets, about.
ROWS_PER_SLOT_RANGE = 50_000
LEAST_SLOT_RANGES = 64


@dataclass(frozen=True)
class Tree:
    """Weights by shard, in shard order, and the fan-out."""

    weights: tuple[float, ...]
    base: int
    rack: int = 4
    racks: int = 2
    regions: list[list[list[int]]] = field(init=False, compare=False)

    def __post_init__(self) -> None:
        per_region = self.rack * self.racks
        cut = lambda xs, n: [xs[i : i + n] for i in range(0, len(xs), n)]
        old = [cut(r, self.rack) for r in cut(list(range(min(self.base, len(self.weights)))), per_region)]
        object.__setattr__(self, "regions", old + [[[s]] for s in range(self.base, len(self.weights))])

    def grown(self, weight: float = 1.0) -> Tree:
        return Tree((*self.weights, weight), self.base, self.rack, self.racks)


def even_tree(shards: int = 40) -> Tree:
    return Tree((1.0,) * shards, shards)


def _children(tree: Tree) -> tuple[list[list[float]], list[list[list[float]]]]:
    """Weights of racks by region, and of shards by region and rack."""
    w = tree.weights
    racks = [[sum(w[s] for s in shards) for shards in region] for region in tree.regions]
    return racks, [[[w[s] for s in shards] for shards in region] for region in tree.regions]


def _descend(key: Column, level: str, parent: Column | None, weights: Column) -> Column:
    """The child with the smallest draw; a child without weight never wins, ties go to the first."""

    def draw(weight: Column, i: Column) -> Column:
        # 52 bits of the hash, never 0, as a number in (0, 1)
        h = F.xxhash64(key, F.lit(level), i) if parent is None else F.xxhash64(key, F.lit(level), parent, i)
        u = (F.shiftrightunsigned(h, 12).cast("double") + 0.5) / F.lit(float(1 << 52))
        return F.struct(F.when(weight > 0, -F.log(u) / weight).otherwise(F.lit(float("inf"))).alias("d"), i.alias("i"))

    return F.array_min(F.transform(weights, draw))["i"]


def place(docs: DataFrame, key: str, tree: Tree, out: str = "shard") -> DataFrame:
    """Add column `out`, the shard of each row. Rows with a null key draw as one key."""
    racks, shards = _children(tree)
    lit = lambda x: F.array(*map(lit, x)) if isinstance(x, list) else F.lit(x)
    k = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    # one struct for the steps of the descent, so that no column of docs is overwritten
    step = next(x for i in range(len(docs.columns) + 1) if (x := f"_step{i}") not in docs.columns)
    region, rack, shard = F.col(f"{step}.region"), F.col(f"{step}.rack"), F.col(f"{step}.shard")
    return (
        docs.withColumn(step, F.struct(_descend(k, "region", None, lit([float(sum(r)) for r in racks])).alias("region")))
        .withColumn(step, F.struct(region.alias("region"), _descend(k, "rack", region, lit(racks)[region]).alias("rack")))
        .withColumn(step, F.struct(region.alias("region"), rack.alias("rack"), _descend(k, "shard", region * 1000 + rack, lit(shards)[region][rack]).alias("shard")))
        .withColumn(out, lit(tree.regions)[region][rack][shard].cast("int"))
        .drop(step)
    )


#: Copies of one row that are made from one array.
COPIES_PER_ARRAY = 10_000


def repeated(rows: DataFrame, count: str, number: str) -> DataFrame:
    """Each row `count` times, with column `number` from 0; no array holds more than COPIES_PER_ARRAY numbers."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(COPIES_PER_ARRAY).cast("long")))
    return rows.withColumn(number, first).withColumn(number, F.explode(F.sequence(F.col(number), F.least(F.col(number) + COPIES_PER_ARRAY, F.col(count)) - 1)))


def slots(counted: DataFrame, ranges: int, order: list[str], shard: str, count: str) -> DataFrame:
    """Number the rows of each shard from 0 without gaps; counted: distinct rows with how often each comes.

    A shard is split into ranges by a hash of the order columns; counts by
    (shard, range) are summed up over the ranges of a shard and rows are
    numbered within a range, so that no task holds a whole shard. Equal rows
    are one until they have their numbers.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order]
    rows = counted.withColumn("_range", F.pmod(F.xxhash64(*text, F.lit("slot")), F.lit(ranges)).cast("int"))
    before = (
        rows.groupBy(shard, "_range")
        .agg(F.sum(count).alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy(shard).orderBy("_range")) - F.col("_n"))
        .drop("_n")
    )
    w = Window.partitionBy(shard, "_range").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("_upto", F.sum(count).over(w)).join(before, [shard, "_range"])
    return (
        repeated(numbered, count, "_copy")
        .withColumn("slot", (F.col("_before") + F.col("_upto") - F.col(count) + F.col("_copy")).cast("long"))
        .drop("_range", "_upto", "_before", "_copy", count)
    )


def shard_documents(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 16, text_crc32 the CRC-32 of those
    bytes; a null text counts as empty. Law `key`: only doc_id and the number
    of shards decide, so equal ids share a shard, whatever their texts. Null
    ids share one shard. Other columns are ignored; an empty table gives an
    empty result. Rows equal in id, checksum and size take consecutive slots.
    """
    tree = even_tree(shards)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    counted = materialize(rows.groupBy(*order).agg(F.count("*").alias("_count")), "slots")
    ranges = max(LEAST_SLOT_RANGES, -(-counted.count() // ROWS_PER_SLOT_RANGE))
    placed = place(place(counted, "doc_id", tree), "doc_id", tree.grown(), "grown_shard")
    out = slots(placed, ranges, order, "shard", "_count")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """docs with column shard, placed by doc_id; a column of this name is replaced. Nothing is shuffled."""
    return place(docs.drop("shard"), "doc_id", even_tree(shards))


def op4_shard_tree(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
