"""A training corpus in five stages: quality, near copies, benchmark, mix, shards.

Each stage takes (spark, docs, sf_dir), works on all rows of docs, and returns
a DataFrame; all but the last have the columns of documents. Between stages
the rows are written as Parquet in the folder that executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import decontaminate, jaccard, mixing, quality, sharding
from lexweave.storage import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at Jaccard 3/4 over five words, the one of the smallest id stays."""
    return jaccard.one_of_each(docs).select(*COLUMNS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of ten words of benchmark items, and items of fewer words as a whole, are cut out wherever they occur."""
    return decontaminate.remove_spans(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gives its target's words: its documents come once for each epoch, those after the cut not at all."""
    return mixing.mixed(docs).select(*COLUMNS)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.sharded(docs.select(*COLUMNS))


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("shard", shard_stage),
]

#: A fitted classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(F.col(c) for c in COLUMNS))
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
