import math
import random
from collections import defaultdict

import pytest

from lexweave.llm import mixing


def brute_targets(sizes):
    """Share by weight, stop at three times the size, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, rest = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while rest > 1e-9 and open_:
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if target[s] + rest * weight[s] / w > 3 * sizes[s]]
        add = {s: rest * weight[s] / w for s in open_}
        rest = 0.0
        for s, a in add.items():
            t = target[s] + a
            if t > 3 * sizes[s]:
                rest += t - 3 * sizes[s]
                t = 3.0 * sizes[s]
            target[s] = t
        open_ -= set(over)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_shared_again_until_none_is_above(spark, seed):
    r = random.Random(seed)
    sizes = {s: r.choice([0, 3, 10, 200, 5000]) for s in ["a", "b", "é", "z1", "z2", "z3", None][: r.randint(2, 7)]}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want), (got, want)


def test_each_source_gives_its_target(spark):
    r = random.Random(5)
    docs = [(i, " ".join("w" for _ in range(r.randint(0, 40))), r.choice(["s1"] * 8 + ["s2", "s3", None])) for i in range(600)]
    docs += [(None, None, "s1"), (None, "a b", None), (5, "x y z", "s1"), (5, "x y z", "s1"), (7, "", "s9")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as size", "'x' as target")
    rows = mixing.mix_documents(frame).collect()
    assert len(rows) == len(docs)
    assert mixing.mix_documents(frame).collect() and sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(frame).collect()))
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    by_target = defaultdict(int)
    for x in rows:
        assert x["taken"] <= 3 * x["size"] and x["taken"] >= 0
        by_target[x["source_size"], round(x["target"], 6)] += x["taken"]
    for s, t in want.items():
        assert abs(by_target[sizes[s], round(t, 6)] - t) < 1


def test_mixed_rows_follow_the_cuts(spark):
    r = random.Random(6)
    docs = [(i, " ".join("w" for _ in range(r.randint(1, 9))), "s1" if i % 5 else "s2", 3) for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, extra int")
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    words = defaultdict(int)
    for x in out.collect():
        words[x["source"]] += len(x["text"].split())
    sizes = defaultdict(int)
    for _, t, s, _ in docs:
        sizes[s] += len(t.split())
    for s, t in brute_targets(sizes).items():
        assert 0 <= words[s] - math.floor(t) < 10


def test_empty(spark):
    assert mixing.mix_documents(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
