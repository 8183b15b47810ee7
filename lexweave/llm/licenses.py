"""License scans by diagonal voting.

Every two consecutive words of a text are a gram. Grams are joined to the
places where they stand in the templates; a match at word p of the text and
word t of a template votes for the diagonal p - t. A template that stands in
the text word for word gets all its votes on one diagonal; words added or left
out move the rest to a neighbouring one, so that diagonals at most GAP apart
are merged. A merged span is verified by the share of the template's grams
that it holds and by its length. Grams are compared by hash and by text.

Base phrases count only where their words stand consecutively, that is where
one diagonal holds every gram.

Only DataFrame expressions are used. Templates are a table; their grams are
broadcast where they are few.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.llm.license_texts import TEXTS
from lexweave.storage import materialize

GAP = 2
#: Share of a template's grams that a merged span must hold.
LEAST_SHARE = 0.75
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Phrase and label.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Grams of templates that are broadcast, about 100 bytes each; with more the join is by shuffle.
BROADCAST_GRAMS = 200_000


def _words(text: str) -> list[str]:
    """What `words` gives, for the templates of this module."""
    return re.findall("[0-9a-z]+", text.lower())


TEMPLATES = [(k, "base" if k < len(BASE) else "own", label, w) for k, (label, w) in enumerate([(label, phrase.split(" ")) for phrase, label in BASE] + [(label, _words(text)) for label, text in TEXTS])]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _grams(w: Column) -> Column:
    """(one, two) for every two consecutive words."""
    last = F.greatest(F.size(w) - 1, F.lit(0))
    return F.arrays_zip(F.slice(w, F.lit(1), last).alias("one"), F.slice(w, F.lit(2), last).alias("two"))


def template_table(spark: SparkSession) -> DataFrame:
    """(label, text) of the module's own templates."""
    return spark.createDataFrame(list(TEXTS), "label string, text string")


def template_grams(templates: DataFrame) -> DataFrame:
    """A written table with a row for each gram: template, kind, label, n_grams, t, one, two, h. The base phrases come first.

    Templates (label, text) are numbered by label and text; one of a single
    word, or of none, is left out.
    """
    spark = templates.sparkSession
    base = spark.createDataFrame([(k, "base", label, w) for k, kind, label, w in TEMPLATES if kind == "base"], "template int, kind string, label string, w array<string>")
    number = F.row_number().over(Window.orderBy("label", "text")) + len(BASE) - 1  # a template is a license: thousands at most
    own = templates.where("label IS NOT NULL AND text IS NOT NULL").select("label", "text").distinct().select(number.alias("template"), F.lit("own").alias("kind"), "label", words(F.col("text")).alias("w"))
    rows = base.unionByName(own).where(F.size("w") > 1).select("template", "kind", "label", (F.size("w") - 1).alias("n_grams"), F.posexplode(_grams(F.col("w"))).alias("t", "g"))
    return materialize(rows.select("template", "kind", "label", "n_grams", "t", F.col("g.one").alias("one"), F.col("g.two").alias("two"), F.xxhash64("g.one", "g.two").alias("h")), "templates")


def gram_matches(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """A written table: row, doc_id, n_words, p (place), and the template's columns of each gram that some template has.

    A document's first gram, or none if it has a single word, is always there,
    with null template columns if no template has it.
    """
    few = grams.count() <= BROADCAST_GRAMS
    split = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("w"))
    each = split.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(_grams(F.col("w"))).alias("p", "g"))
    each = each.select("row", "doc_id", "n_words", "p", F.xxhash64("g.one", "g.two").alias("h"), F.col("g.one").alias("one"), F.col("g.two").alias("two"))
    joined = each.join(F.broadcast(grams) if few else grams, ["h", "one", "two"], "left")
    return materialize(joined.where("template IS NOT NULL OR coalesce(p, 0) = 0").select("row", "doc_id", "n_words", "p", "template", "kind", "label", "n_grams", "t"), "grams")


def spans(matches: DataFrame) -> DataFrame:
    """Merged diagonals: row, template, kind, label, lo, hi (words), share, exact starts of base phrases."""
    voted = (
        matches.where("template IS NOT NULL")
        .groupBy("row", "template", "kind", "label", "n_grams", (F.col("p") - F.col("t")).alias("diagonal"))
        .agg(F.count("*").alias("votes"), F.min("p").alias("lo"), F.max("p").alias("hi"), F.collect_set("t").alias("ts"))
    )
    w = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(w) <= GAP, 0).otherwise(1)
    return (
        voted.withColumn("island", new)
        .withColumn("island", F.sum("island").over(w))
        .groupBy("row", "template", "kind", "label", "n_grams", "island")
        .agg(
            F.min("lo").alias("lo"),
            (F.max("hi") + 2).alias("hi"),
            (F.size(F.array_distinct(F.flatten(F.collect_list("ts")))) / F.first("n_grams")).alias("share"),
            F.collect_list(F.when(F.col("votes") == F.col("n_grams"), F.col("diagonal"))).alias("exact"),
        )
    )


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """One row for each document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the largest share of a template that one merged span holds, 0
    without any. A null or empty text has no words and empty label lists. Rows
    with the same doc_id are scanned apart. Other columns are ignored. templates:
    (label, text) of licenses, those of license_texts if not given.
    """
    matches = gram_matches(docs, template_grams(template_table(docs.sparkSession) if templates is None else templates))
    is_base = F.col("kind") == "base"
    verified = ~is_base & (F.col("share") >= LEAST_SHARE) & (F.col("hi") - F.col("lo") <= 2 * (F.col("n_grams") + 1))
    per = (
        spans(matches)
        .groupBy("row")
        .agg(
            F.sum(F.when(is_base, F.size("exact")).otherwise(0)).alias("n_base"),
            F.min(F.when(is_base, F.array_min("exact"))).alias("first_word"),
            F.max(F.when(is_base, F.array_max("exact"))).alias("last_word"),
            F.collect_set(F.when(is_base & (F.size("exact") > 0), F.col("label"))).alias("base"),
            F.collect_set(F.when(verified, F.col("label"))).alias("own"),
            F.max("share").alias("score"),
        )
    )
    none = F.array().cast("array<string>")
    base, own = F.coalesce("base", none), F.coalesce("own", none)
    documents = matches.where("coalesce(p, 0) = 0").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"))
    return documents.join(per, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op5_diagonal_votes(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_VALUES = ", ".join(f"({k}, '{kind}', '{label}', {len(w) - 1}, {t}, '{w[t]} {w[t + 1]}')" for k, kind, label, w in TEMPLATES for t in range(len(w) - 1))
OP5_SQL = rf"""
WITH tpl(template, kind, label, n_grams, t, gram) AS (VALUES {_VALUES}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), g AS (
  SELECT r, k - 1 AS p, w[k] || ' ' || w[k + 1] AS gram FROM (SELECT r, w, unnest(range(1, len(w))) AS k FROM d)
), v AS (
  SELECT r, template, kind, label, n_grams, p - t AS diagonal, count(*) AS votes, min(p) AS lo, max(p) AS hi, list(DISTINCT t) AS ts
  FROM g JOIN tpl USING (gram) GROUP BY ALL
), i AS (
  SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS island
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= {GAP} THEN 0 ELSE 1 END AS new FROM v)
), s AS (
  SELECT r, template, kind, label, n_grams, min(lo) AS lo, max(hi) + 2 AS hi, len(list_distinct(flatten(list(ts)))) / n_grams AS share,
         list(diagonal) FILTER (WHERE votes = n_grams) AS exact
  FROM i GROUP BY r, template, kind, label, n_grams, island
), per AS (
  SELECT r, sum(CASE WHEN kind = 'base' THEN coalesce(len(exact), 0) ELSE 0 END) AS n_base,
         min(CASE WHEN kind = 'base' THEN list_min(exact) END) AS first_word, max(CASE WHEN kind = 'base' THEN list_max(exact) END) AS last_word,
         list(DISTINCT label) FILTER (WHERE kind = 'base' AND coalesce(len(exact), 0) > 0) AS base,
         list(DISTINCT label) FILTER (WHERE kind = 'own' AND share >= {LEAST_SHARE} AND hi - lo <= 2 * (n_grams + 1)) AS own,
         max(share) AS score
  FROM s GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ','), '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN per USING (r)
"""
