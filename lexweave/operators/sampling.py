"""Seeded samples: a 32-bit generator and shuffle that others can repeat, and hash order where any fair draw will do.

The exact shuffle is sequential, so it runs over ids only, in one task for each
pool; the pools are judged samples' populations, not raw data. `hash_sample`
draws from tables of any size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

M = 0xFFFFFFFF
#: The generator's step, and what is added to the first seed for a top-up.
STEP = 0x6D2B79F5
TOP_UP, TOP_UP_SUBSET = 1, 7919


def uniform(seed: int) -> Iterator[float]:
    """The 32-bit generator mulberry32: numbers in [0, 1)."""
    state = seed & M
    while True:
        state = (state + STEP) & M
        t = (state ^ (state >> 15)) * (state | 1) & M
        t ^= (t + ((t ^ (t >> 7)) * (t | 61) & M)) & M
        yield (t ^ (t >> 14)) / 4294967296


def shuffled(n: int, seed: int) -> list[int]:
    """0 to n - 1 in the order of a Fisher-Yates shuffle from the end."""
    order, draw = list(range(n)), uniform(seed)
    for last in range(n - 1, 0, -1):
        other = int(next(draw) * (last + 1))
        order[last], order[other] = order[other], order[last]
    return order


def draw(ids: Sequence[str], n: int, seed: int) -> list[str]:
    return [ids[i] for i in shuffled(len(ids), seed)[: max(0, n)]]


def draw_many(ids: Sequence[str], n: int, seeds: Sequence[int]) -> list[str]:
    """An equal part of n from each seed, without repeats; what is short comes from the rest by one more seed."""
    part = -(-n // len(seeds))
    out = list(dict.fromkeys(x for s in seeds for x in draw(ids, part, s)))[:n]
    if len(out) < n:
        seen = set(out)
        out += draw([x for x in ids if x not in seen], n - len(out), seeds[0] + TOP_UP)
    return out


def draw_nested(ids: Sequence[str], subset: Sequence[str], n: int, seeds: Sequence[int]) -> tuple[list[str], list[str]]:
    """A sample of ids and one of a subset, which takes over what the first already drew."""
    whole, inside = draw_many(ids, n, seeds), set(subset)
    taken = [x for x in whole if x in inside][:n]
    have = set(taken)
    return whole, taken + draw([x for x in subset if x not in have], n - len(taken), seeds[0] + TOP_UP_SUBSET)


def sample(pool: DataFrame, group: str, item: str, ord: str, n: int, seeds: Sequence[int]) -> DataFrame:
    """(group, item, no): the repeatable draw within each group, items in the order of `ord`."""
    kinds = dict(pool.dtypes)

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("_ord")
        items = draw_many(own[item].tolist(), min(n, len(own)), seeds)
        return pd.DataFrame({group: own[group].iloc[0], item: items, "no": range(1, len(items) + 1)})

    return pool.select(group, item, F.col(ord).alias("_ord")).groupBy(group).applyInPandas(run, f"{group} {kinds[group]}, {item} {kinds[item]}, no int")


def hash_sample(df: DataFrame, item: str, n: int, seed: int) -> DataFrame:
    """n rows by the order of a seeded hash of the item: each task keeps n, and n are kept of those."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(item).cast("string"))), item).limit(n)


def seeds_used_elsewhere(metas: DataFrame, label: str, seeds: Sequence[int]) -> DataFrame:
    """(label, shared) of other labels (label, seeds) that have one of these seeds."""
    own = F.array(*[F.lit(int(s)).cast("long") for s in seeds])
    shared = F.array_intersect(F.col("seeds"), own)
    return metas.where(F.col("label") != label).select("label", shared.alias("shared")).where(F.size("shared") > 0)
