"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts.

Each document has a key, the MD5 of its id, which is uniform and does not
depend on the input's order. Rows are dealt to ranges of (source, leading key
digits), each range is sorted by key, and sums over whole ranges give each row
the number of its source's words before it. A source's budget then cuts its
order at an exact word; a budget above the source's size takes whole epochs
first.

Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm.sharding import repeated
from lexweave.storage import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Rows that a key range of one source gets, about, if that source had all rows.
ROWS_PER_RANGE = 20_000


#: Rows of about 100 bytes.
BROADCAST_SOURCES = 100_000


def _key() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))


def _name() -> Column:
    """The source, or what stands for a null one."""
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    The i-th source by code point (null last) weighs weights[i mod len]; the
    sources share the sum of all sizes. A target stops at `most` times its
    source's size; the excess is shared again by weight. That is the level L
    with sum(min(most * size, L * weight)) = total; sources below their level
    come first when sorted by size / weight, so that one prefix sum finds L.
    One row for each source, so one task is enough.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("_i") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("_i", F.row_number().over(by_name) - 1)
        .withColumn("_w", w)
        .withColumn("_cap", F.col("source_size").cast("double") * most)
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    )
    every = Window.partitionBy(F.lit(1))
    upto = Window.partitionBy(F.lit(1)).orderBy("_ratio", "_i")
    levels = (
        ranked.withColumn("_total", F.sum(F.col("source_size").cast("double")).over(every))
        .withColumn("_caps", F.sum("_cap").over(upto) - F.col("_cap"))
        .withColumn("_rest", F.sum("_w").over(every) - F.sum("_w").over(upto) + F.col("_w"))
        .withColumn("_level", (F.col("_total") - F.col("_caps")) / F.col("_rest"))
        .withColumn("_free", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_i", "_level"))).over(every)["_level"])
    )
    target = F.least(F.col("_cap"), F.coalesce(F.col("_free"), F.lit(0.0)) * F.col("_w"))
    return levels.select("source", "source_size", target.alias("target"))


def take_words(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Add source_size, target and the words `before` each row in its source's order to rows of doc_id, source, size and n_copies.

    Rows are distinct and read several times: give a written table. A row's
    copies follow each other.
    """
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n_copies")).alias("source_size"))
    targets = source_targets(sources, weights, most).withColumn("_source", _name()).drop("source")
    digits, n = 1, rows.count()
    while 16**digits * ROWS_PER_RANGE < n or digits < 2:
        digits += 1
    keyed = (
        rows.withColumn("_source", _name())
        .withColumn("_key", _key())
        .withColumn("_range", F.substring("_key", 1, digits))
        .withColumn("_words", F.col("size") * F.col("n_copies"))
    )
    before = (
        keyed.groupBy("_source", "_range")
        .agg(F.sum("_words").alias("_sum"))
        .withColumn("_before", F.sum("_sum").over(Window.partitionBy("_source").orderBy("_range")) - F.col("_sum"))
        .drop("_sum")
    )
    ordered = Window.partitionBy("_source", "_range").orderBy("_key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        keyed.withColumn("_upto", F.sum("_words").over(ordered))
        .join(before, ["_source", "_range"])
        .join(targets, "_source")
        .withColumn("before", F.col("_before") + F.col("_upto") - F.col("_words"))
        .drop("_source", "_key", "_range", "_before", "_upto", "_words")
    )


def _epochs() -> Column:
    """How often a source is taken as a whole."""
    return F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)


def _rest() -> Column:
    """Words of the last epoch from a row and its copies on."""
    return F.floor("target") - _epochs() * F.col("source_size") - F.col("before")


def _counted(docs: DataFrame) -> DataFrame:
    """The written table of distinct (doc_id, source, size) with n_copies; size: number of words, 0 for a null text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return materialize(docs.select("doc_id", "source", size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("n_copies")), "mix")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row for each input row: doc_id, size, source_size, target, taken.

    size is the number of words, 0 for a null text. A document at a cut gives
    the words up to the cut. Rows with the same id are ordered by size, equal
    rows follow each other; a null id is an id. Other columns are ignored; an
    empty table gives an empty result, and a source without words has target 0.
    """
    rows = repeated(take_words(_counted(docs), weights, most), "n_copies", "_copy")
    last = F.greatest(F.lit(0), F.least(F.col("size"), _rest() - F.col("_copy") * F.col("size")))
    return rows.select("doc_id", "size", "source_size", "target", (_epochs() * F.col("size") + last).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """docs as the mix takes them: a row for each epoch, whole or cut, that a document is in.

    A source's cut is a key: documents up to it come in the last epoch, the one
    at the cut whole, so that a source exceeds its target by less than one
    document (or the rows of one id). Documents without words follow the same
    order. Texts aren't shuffled where the sources' cuts can be broadcast.
    """
    taken = take_words(_counted(docs), weights, most)
    last = (F.col("size") > 0) & (_rest() > 0)
    cuts = taken.groupBy(_name().alias("name")).agg(F.first(_epochs()).cast("int").alias("epochs"), F.max(F.when(last, _key())).alias("cut"))
    cuts = materialize(cuts, "cuts")
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    # columns of docs may have any name: theirs go in one struct
    own = docs.select(F.struct(*docs.columns).alias("doc"), _name().alias("name"), _key().alias("key")).join(cuts, "name")
    times = F.col("epochs") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    out = own.withColumn("times", times).where("times > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(*(F.col("doc")[c].alias(c) for c in docs.columns))


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS i, 3.0::DOUBLE * source_size AS cap
  FROM s
), l AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - (sum(cap) OVER (ORDER BY cap / w, i) - cap))
            / (sum(w) OVER () - sum(w) OVER (ORDER BY cap / w, i) + w) AS level
  FROM r
), t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, (cap / w, i)) FROM l WHERE level <= cap / w), 0.0) * w) AS target
  FROM l
), o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - start)))::BIGINT AS taken
FROM o
"""
