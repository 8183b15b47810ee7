import random

import numpy as np
import pytest

from lexweave.llm import components as cc
from lexweave.llm import jaccard as jc
from lexweave.llm.components import components
from tests.llm.cases import documents, frame, words


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(docs):
    sets = []
    for _, t in docs:
        w = lower(t).translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= 75 * (len(a) + len(sets[j]) - o):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


def families(r):
    """Chains of near copies, in which the ends don't link, and a large family."""
    out, base = [], words(r, 200, 5000).split()
    for k in range(12):
        base = base[: 10 * k] + [f"e{k}_{j}" for j in range(6)] + base[10 * k + 6 :]
        out.append(" ".join(base))
    hub = words(r, 150, 5000).split()
    for k in range(60):
        w = list(hub)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"x{k}"
        out.append(" ".join(w))
    short = [words(r, n, 3) for n in (1, 1, 2, 3, 4, 4, 5, 6) for _ in range(4)]
    return [(1000 + i, t) for i, t in enumerate(out + short)]


@pytest.mark.parametrize("chunk", [jc.CHUNK, 7])
def test_against_brute_force(spark, chunk):
    docs = [d[:2] for d in documents()] + families(random.Random(3))
    random.Random(8).shuffle(docs)
    got = jc.join_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), chunk=chunk).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_one_of_each_group_stays(spark):
    docs = frame(spark)
    kept = jc.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, c in brute([d[:2] for d in documents()]) if d is not None and c == d}
    rows = kept.collect()
    assert {r["doc_id"] for r in rows if r["doc_id"] is not None} == want
    assert jc.join_components(frame(spark, [])).collect() == []


def test_tree_join_skips_no_allowed_pair():
    r = np.random.default_rng(5)
    centers = r.integers(0, 6, size=(9, 16))
    points = np.clip(centers[r.integers(9, size=400)] + r.integers(-1, 2, size=(400, 16)), 0, None).astype(np.int32)
    sizes = points.sum(1)
    union = jc.Union(400)
    jc.tree_join(points, sizes, list(range(400)), union)
    plain = jc.Union(400)
    for i in range(400):
        for j in range(i):
            if jc.allowed(np.minimum(points[i], points[j]).sum(), sizes[i] + sizes[j]):
                plain.join(i, j)
    same = {}
    assert all(same.setdefault(plain.find(i), union.find(i)) == union.find(i) for i in range(400)) and len(set(same.values())) == len(same)


@pytest.mark.parametrize("per_task", [200_000, 0.001])
def test_components_of_paths_and_stars(spark, monkeypatch, per_task):
    monkeypatch.setattr(cc, "EDGES_PER_TASK", per_task)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_first_hashes_with_room_are_found_exactly():
    r = np.random.default_rng(1)
    for _ in range(20):
        h = r.integers(0, 6, 60).astype(np.uint64) << np.uint64(58)
        sizes = r.integers(20, 400, 60)
        before = (sizes * r.random(60) * 0.25).astype(int)
        size, room = jc.room_codes(sizes, before)
        parts = np.array_split(np.arange(60), 12)
        asked = [(i, b"".join(p for _, p in jc.ask_room(h[q], sizes[q], before[q], q, 1))) for i, q in enumerate(parts)]
        replies, names = dict(jc.answer_room(0, asked)), {}
        for i, q in enumerate(parts):
            got = jc.answers_for(h[q], {jc.sh.SECOND: replies[i]} if replies[i] else {}, 1, jc.sh.SECOND)
            want = [any(b != a and h[b] == h[a] and jc.roomy(size[[a]], room[[a]], size[[b]], room[[b]])[0] for b in range(60)) for a in q]
            assert (got > 0).tolist() == want
            for a, g in zip(q, got, strict=True):
                seen = names.setdefault(int(h[a]), int(g)) if g else 0
                assert not g or seen == g
        assert len(set(names.values())) == len(names)


def test_no_link_lacks_room():
    r = np.random.default_rng(2)
    for _ in range(3000):
        a, b = r.integers(1, 600, 2)
        left = r.integers(1, min(a, b) + 1)  # hashes that both may share, from their first common one on
        if 7 * left >= 3 * (a + b):
            before = np.array([r.integers(0, a - left + 1), r.integers(0, b - left + 1)])
            size, room = jc.room_codes(np.array([a, b]), before)
            assert jc.roomy(size[:1], room[:1], size[1:], room[1:])[0]


def test_many_sets_of_one_shard_with_a_hash():
    h = np.full(30, 5 << 60, np.uint64)
    sizes, before = np.full(30, 100), np.arange(30)
    asked = [(0, b"".join(p for _, p in jc.ask_room(h, sizes, before, before, 1)))]
    assert len(asked[0][1]) == 15
    assert (jc.answers_for(h, {jc.sh.SECOND: dict(jc.answer_room(0, asked))[0]}, 1, jc.sh.SECOND) > 0).all()


def test_every_pair_with_room_still_meets():
    r = np.random.default_rng(7)
    # sets as lists of hashes in a common order, dealt to shards; few distinct groups
    families = [r.choice(40, size=r.integers(2, 12), replace=False) for _ in range(25)]
    families += families[:6]
    has = [sorted(i for i, f in enumerate(families) if n in f) for n in range(40)]
    h = np.concatenate([np.array(x, np.uint64) for x in has]) << np.uint64(58)
    k = np.concatenate([np.full(len(x), n) for n, x in enumerate(has)])
    sizes, before = np.full(len(h), 200), np.concatenate([np.arange(len(x)) for x in has])
    shards = [np.flatnonzero(np.isin(k, q)) for q in np.array_split(np.arange(40), 3)]
    asked = [(i, b"".join(p for _, p in jc.ask_room(h[q], sizes[q], before[q], k[q], 1))) for i, q in enumerate(shards)]
    replies, kept = dict(jc.answer_room(0, asked)), set()
    for i, q in enumerate(shards):
        at = jc.meetings(k[q], jc.answers_for(h[q], {jc.sh.SECOND: replies[i]}, 1, jc.sh.SECOND))
        kept |= {(int(h[q][a]), int(k[q][a])) for a in at}
    assert len(kept) < len(h)
    for a in range(40):
        for b in range(a):
            if set(has[a]) & set(has[b]):
                assert any((x << 58, a) in kept and (x << 58, b) in kept for x in set(has[a]) & set(has[b]))
