import hashlib
import random

import numpy as np
import pytest

from lexweave.llm import substrings as sub
from tests.llm.cases import documents, frame


def brute(docs):
    first = {}
    order = lambda d: float("inf") if d is None else d
    for d, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            first[w] = min(first.get(w, float("inf")), order(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < order(d):
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def some_periodic(r):
    rows = [("ab" * 100), ("ab" * 60) + "c" + ("ab" * 60), "x" * 200, "x" * 49, "x" * 50, "x" * 51, "é" * 80, "\0" * 120, "日本" * 40]
    rows += ["".join(r.choice("ab") for _ in range(300)) for _ in range(6)]
    rows += [rows[-1][:150] + "Z" + rows[-1][150:], rows[-2][20:90] + rows[-3][100:180]]
    return [(i % 17, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs = [d[:2] for d in documents(seed)] + some_periodic(random.Random(seed))
    got = sub.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_clashing_columns_and_bytes(spark):
    rows = sub.dedup_substrings(frame(spark), with_text=True).collect()
    assert all(hashlib.sha256(r["kept_bytes"]).hexdigest() == r["kept_sha256"] for r in rows)
    assert sub.dedup_substrings(frame(spark, [])).collect() == []


def test_cover_gives_every_shift():
    assert {(a - b) % sub.PERIOD for a in sub.COVER for b in sub.COVER} == set(range(sub.PERIOD))


def test_blocks_give_the_same_strings():
    r = np.random.default_rng(2)
    slot, n = 124, 300
    text = np.zeros(slot * n + 200, np.uint8)
    piece = r.integers(97, 99, size=(20, 75)).astype(np.uint8)
    places = []
    for k in range(n):
        text[k * slot : k * slot + 75] = piece[r.integers(20)]
        places += [k * slot + j for j in range(26)]
    places = np.array(places)
    got = set()
    for block in (50, 1 << 20):
        groups = []
        for own, agree in sub.same_strings(text, places, 75, block):
            for i, same in zip(own.tolist(), agree.tolist(), strict=True):
                groups.append([i]) if not same else groups[-1].append(i)
        got.add(frozenset(frozenset(g) for g in groups))
        by = {}
        for i, p in enumerate(places.tolist()):
            by.setdefault((p % 31, text[p : p + 50].tobytes()), set()).add(i)
        assert {frozenset(g) for g in groups} == {frozenset(g) for g in by.values()}
    assert len(got) == 1


def test_suffixes_come_in_true_order():
    """Against sorted suffixes, with long ties between places of all residues."""
    r = np.random.default_rng(6)
    room, n = 75, 40
    slot = 31 * 6
    text = np.zeros(slot * n + 400, np.uint8)
    for k in range(n):
        own = np.tile(r.integers(97, 99, size=r.integers(1, 4)), 80)[:75]
        own[r.integers(0, 75, size=k % 3)] = 99
        text[k * slot + k % 31 : k * slot + k % 31 + 75] = own
    places = np.array([k * slot + k % 31 + j for k in range(n) for j in range(26)])
    suffix = [text[p : p + room].tobytes() for p in places]
    got = [i for own, _ in sub.same_strings(text, places, room) for i in own.tolist()]
    assert sorted(got) == list(range(len(places)))
    assert [suffix[i] for i in got] == sorted(suffix)
    assert len({s[:50] for s in suffix}) < len(suffix) / 2


def test_cuts_give_the_stretches_back():
    texts = ["", "a" * 200, "short", "".join(chr(97 + (k * k) % 23) for k in range(3000)), "é" * 60, "x" * 49]
    data, offsets = sub.bt.utf8(sub.pa.array(texts))
    want = sub.stretches(data, offsets)
    got = sub.known_stretches(sub.sh.Shard(0, np.arange(6), np.zeros(6, bool), offsets, data, sub.packed_cuts(data, offsets)))
    assert all((getattr(got, f) == getattr(want, f)).all() for f in ("p0", "p1", "at", "hash", "row", "sig")) and len(want.at) > 100
    assert len(sub.packed_cuts(data[:0], offsets[:1])) == 0
