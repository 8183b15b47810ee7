"""Column helpers that the queries and operators share: cleaning, rules, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normal_key(c: Column) -> Column:
    """Letters and single spaces, lower-cased, trimmed."""
    letters = F.regexp_replace(c, "[^A-Za-z ]+", "")
    return F.lower(F.regexp_replace(F.trim(letters), " +", " "))


def first_rule(rules: Sequence[tuple[Column, str, str | None]], status: str, reason: str | None) -> Column:
    """struct(status, reason) of the first rule that holds, else the given one."""
    pair = lambda s, r: F.struct(F.lit(s).alias("status"), F.lit(r).cast("string").alias("reason"))
    out = None
    for test, s, r in rules:
        out = F.when(test, pair(s, r)) if out is None else out.when(test, pair(s, r))
    return out.otherwise(pair(status, reason))


def count_share(df: DataFrame, keys: Sequence[str], n: str = "n", share: str = "share") -> DataFrame:
    """Counts by keys, and their share of all rows. The total is taken over the counts, a short table."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(n))
    return counts.withColumn(share, F.col(n) / F.sum(n).over(Window.partitionBy(F.lit(1))))


def flat_cell(c: Column) -> Column:
    """A cell of a tab-separated file: tabs and line ends become one space each, null is empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[\\t\\r\\n]", " ")


def flat_fixes(fixes: Column) -> Column:
    """`field:from→to(reason)` joined by `; `."""
    return F.array_join(F.transform(fixes, lambda x: F.concat(x["field"], F.lit(":"), x["from"], F.lit("→"), x["to"], F.lit("("), x["reason"], F.lit(")"))), "; ")


def upper_median(xs: Column) -> Column:
    """sorted[floor(n / 2)] of an array, null without any."""
    return F.try_element_at(F.array_sort(xs), F.floor(F.size(xs) / 2).cast("int") + 1)


def positional_vote(readings: Column) -> Column:
    """One reading out of several systems' (an array; nulls are left out).

    Separators don't count. Fewer than two: null. Three or more of equal length:
    at each place the first character that two of them have, or the first one's.
    Else the first string that occurs twice or more.
    """
    xs = F.transform(F.filter(readings, lambda x: x.isNotNull()), lambda x: F.translate(x, "-", ""))
    same_length = F.forall(xs, lambda x: F.length(x) == F.length(F.try_element_at(xs, F.lit(1))))

    def majority(cs: Column) -> Column:
        major = F.filter(cs, lambda c: F.size(F.filter(cs, lambda d: d == c)) > 1)
        return F.coalesce(F.get(major, F.lit(0)), F.get(cs, F.lit(0)))

    def by_place(chars: Column) -> Column:
        def at(i: Column) -> Column:
            return F.get(F.transform(F.array(F.transform(chars, lambda c: F.get(c, i))), majority), F.lit(0))

        places = F.size(F.get(chars, F.lit(0)))
        return F.when(places == 0, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(places - 1, F.lit(0))), at), ""))

    def of_three(chars: Column) -> Column:
        a, b, c = (F.get(chars, F.lit(i)) for i in range(3))
        outvoted = F.zip_with(b, c, lambda x, y: F.when(x == y, x))
        return F.array_join(F.zip_with(a, outvoted, lambda x, y: F.coalesce(y, x)), "")

    # texts are split once, as the variable of a function over one array, not once for each place
    characters = F.transform(xs, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, "")))
    placed = F.get(F.transform(F.array(characters), lambda cs: F.when(F.size(cs) == 3, of_three(cs)).otherwise(by_place(cs))), F.lit(0))
    twice = F.get(F.filter(xs, lambda x: F.size(F.filter(xs, lambda y: y == x)) > 1), F.lit(0))
    return F.when(F.size(xs) < 2, F.lit(None).cast("string")).when((F.size(xs) >= 3) & same_length, placed).otherwise(twice)


def wilson(k: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    """Lower and upper end of the Wilson interval, within [0, 1]; [0, 1] for n = 0."""
    p, zz = F.try_divide(k, n), z * z
    mid, div = p + F.try_divide(F.lit(zz), 2 * n), 1 + F.try_divide(F.lit(zz), n)
    half = z * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(zz), 4 * n * n))
    low = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), (mid - half) / div))
    high = F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), (mid + half) / div))
    return low, high


def detectable_rate(n: Column, power: float = 0.9) -> Column:
    """The smallest error rate of which n rows show one with this power."""
    return 1 - F.pow(F.lit(1 - power), 1 / n)
