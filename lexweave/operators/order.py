"""Order checks over short frames of a volume's reading order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.text import upper_median

#: Neighbours on each side, and violations that are still in order.
WINDOW = 6
MOST_VIOLATIONS = 3


def _frames(group: Sequence[str], seq: Sequence[str], key: str):
    w = Window.partitionBy(*group).orderBy(*seq)
    return F.collect_list(key).over(w.rowsBetween(-WINDOW, -1)), F.collect_list(key).over(w.rowsBetween(1, WINDOW))


def outliers(df: DataFrame, group: Sequence[str], seq: Sequence[str], key: str) -> DataFrame:
    """Add `outlier`: more than three of the neighbours before are greater or after are smaller. Null keys don't count."""
    before, after = _frames(group, seq, key)
    n = F.size(F.filter("_a", lambda x: x > F.col(key))) + F.size(F.filter("_b", lambda x: x < F.col(key)))
    return df.withColumn("_a", before).withColumn("_b", after).withColumn("outlier", n > MOST_VIOLATIONS).drop("_a", "_b")


def bounds(df: DataFrame, group: Sequence[str], seq: Sequence[str], key: str) -> DataFrame:
    """Add `lo` and `hi`: the upper medians of the neighbours before and after; '' and U+FFFF without any."""
    before, after = _frames(group, seq, key)
    out = df.withColumn("_a", before).withColumn("_b", after)
    return out.withColumn("lo", F.coalesce(upper_median(F.col("_a")), F.lit(""))).withColumn("hi", F.coalesce(upper_median(F.col("_b")), F.lit("￿"))).drop("_a", "_b")
