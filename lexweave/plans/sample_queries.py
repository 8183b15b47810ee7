"""Seeded samples of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.operators import sampling
from lexweave.plans.registry import query, table


@query("""
WITH p AS (SELECT doc_id, source FROM documents ORDER BY md5('101:' || doc_id::VARCHAR), doc_id LIMIT 120)
SELECT doc_id, source, row_number() OVER (ORDER BY md5('101:' || doc_id::VARCHAR), doc_id) AS no FROM p
""")
def nested_sample(spark, sf):
    """A sample by hash order, numbered; a subset of it is a fair sample of the subset."""
    from pyspark.sql import Window

    d = sampling.hash_sample(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 120, 101)
    return d.withColumn("no", F.row_number().over(Window.orderBy(F.md5(F.concat(F.lit("101:"), F.col("doc_id").cast("string"))), "doc_id")))


@query()
def mulberry_sample(spark, sf):
    """The repeatable shuffle, by source."""
    return sampling.sample(table(spark, sf, "documents").select("source", "doc_id"), "source", "doc_id", "doc_id", 10, [101, 202, 303])
