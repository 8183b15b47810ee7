import hashlib
import random
import re

import numpy as np
import pytest

from lexweave.llm import decontaminate as dc
from tests.llm.cases import documents, frame

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items, n=10):
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, own = WORD.findall(lower(t)), set(), set()
        for length in {len(x) for x in windows}:
            for k in range(len(w) - length + 1):
                if (x := windows.get(tuple(w[k : k + length]))) is not None:
                    hit |= set(range(k, k + length))
                    own |= {str(i) for i in x if i is not None}
        out.append((d, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items(docs):
    long = [t for _, t, *_ in docs if t and len(t.split()) > 40]
    return [(1, " ".join(long[0].split()[5:25])), (10, long[1].upper()), (2, "w1 w2"), (3, "W7"), (4, None), (5, "..."), (None, " ".join(long[2].split()[:12])), (2, " ".join(long[3].split()[3:13]))]


@pytest.mark.parametrize("chars", [dc.PHRASE_CHARS, 200])
def test_against_brute_force(spark, monkeypatch, chars):
    docs = documents()
    bench = items(docs)
    if chars == 200:  # several blocks of phrases, merged by document
        blocks = dc.phrase_blocks
        monkeypatch.setattr(dc, "phrase_blocks", lambda b, n: blocks(b, n, chars))
    got = dc.digest(frame(spark), spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute([d[:2] for d in docs], bench)


def test_nothing_to_find(spark):
    docs = frame(spark)
    rows = dc.digest(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(rows) == docs.count() and not any(r["contaminated"] for r in rows)
    assert dc.digest(frame(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def test_removed_spans_leave_no_window(spark):
    docs = documents()
    bench = [x for x in items(docs) if x[0] not in (2, 3)]
    table = spark.createDataFrame(bench, "item_id long, text string")
    out = dc.remove_spans(frame(spark), table)
    assert out.columns == frame(spark).columns
    rows = out.collect()
    assert not any(r[5] for r in brute([(r["doc_id"], r["text"]) for r in rows], bench))
    dirty = {(d, n) for d, n, *_, c in brute([d[:2] for d in docs], bench) if c}
    assert dirty
    clean = sorted((str(d[:2]) for d in docs if not brute([d[:2]], bench)[0][5]))
    kept = {str((r["doc_id"], r["text"])) for r in rows}
    assert all(c in kept for c in clean)


@pytest.mark.parametrize("chars", [60, 200])
def test_blocks_of_phrases_cut_like_one(spark, monkeypatch, chars):
    """Items overlap, also across blocks: what one block cuts must not hide another's windows."""
    docs = documents()
    long = [t.split() for _, t, *_ in docs if t and len(t.split()) > 60]
    bench = [(100 * i + k, " ".join(w[k : k + 14])) for i, w in enumerate(long[:6]) for k in (3, 12, 20, 29)]
    bench += [(1000 + i, " ".join(w[6:8])) for i, w in enumerate(long[:6])]
    table = spark.createDataFrame(bench, "item_id long, text string")
    one = dc.remove_spans(frame(spark), table).collect()
    blocks = dc.phrase_blocks
    assert len(list(blocks(table, 10, chars))) > 1
    monkeypatch.setattr(dc, "phrase_blocks", lambda b, n: blocks(b, n, chars))
    out = dc.remove_spans(frame(spark), table)
    assert out.columns == frame(spark).columns
    assert sorted(map(str, out.collect())) == sorted(map(str, one))


def test_fm_index_finds_all_places():
    r = np.random.default_rng(3)
    runs = [r.integers(1, 4, size=r.integers(1, 60)) for _ in range(40)]
    runs += runs[:5]
    seq = np.concatenate([np.append(x, 0) for x in runs]).astype(np.int64)
    index = dc.FMIndex(seq, 4, sample=5)
    for _ in range(200):
        p = r.integers(1, 4, size=r.integers(1, 8))
        lo, hi = index.search(p[None, :].astype(np.int64))
        found = sorted(index.locate(np.arange(lo[0], max(lo[0], hi[0]))).tolist())
        assert found == [k for k in range(len(seq) - len(p) + 1) if (seq[k : k + len(p)] == p).all()]


def test_suffix_order_is_by_text():
    r = random.Random(4)
    runs = [[r.randint(1, 2) for _ in range(r.randint(1, 30))] for _ in range(12)]
    seq = np.array([x for run in runs + runs[:3] for x in [*run, 0]], np.int64)
    key = lambda i: (*(x for x in seq[i : i + list(seq[i:]).index(0)].tolist()), 0, i)
    assert dc.suffix_order(seq).tolist() == sorted(range(len(seq)), key=key)
