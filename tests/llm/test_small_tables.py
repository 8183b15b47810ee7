"""Tables of no, one and two rows, of blanks only and of copies only, one row a partition; and words and lines of a kilobyte and more."""

import numpy as np
import pytest

from lexweave.llm import bytestext as bt
from lexweave.llm import decontaminate, jaccard, lines, rules, shards, substrings
from tests.llm import test_decontaminate, test_jaccard, test_lines, test_rules, test_substrings

TEXT = "one two three four five six seven eight nine ten eleven twelve " * 2
TABLES = {
    "none": [],
    "one word": [(1, "hello there world")],
    "two": [(1, TEXT), (2, "hello")],
    "blanks": [(1, None), (2, ""), (3, " \n "), (None, None)],
    "copies and blanks": [(4, TEXT), (2, TEXT), (None, TEXT), (2, TEXT), (5, " ")],
}


def table(spark, rows):
    # one row a partition
    return spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(max(1, len(rows)), "doc_id", "text")


@pytest.mark.parametrize("name", TABLES)
def test_small_tables(spark, name):
    rows = TABLES[name]
    docs = table(spark, rows)
    items = [(1, "hello"), (2, "two three"), (3, "")]
    got = decontaminate.digest(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == test_decontaminate.brute(rows, items)
    assert sorted(map(tuple, substrings.dedup_substrings(docs).collect()), key=str) == test_substrings.brute(rows)
    assert sorted(map(tuple, jaccard.join_components(docs).collect()), key=str) == test_jaccard.brute(rows)
    assert sorted(map(tuple, lines.dedup_lines(docs, least_docs=2).collect()), key=str) == test_lines.brute(rows, 2, 1)
    kept = sorted(map(tuple, jaccard.one_of_each(docs).collect()), key=str)
    blank = [r for r in rows if not (r[1] or "").strip()]
    firsts = {}
    for r in sorted((r for r in rows if r not in blank), key=lambda r: (r[0] is None, r[0])):
        firsts.setdefault(r[1], r)
    assert kept == sorted([*blank, *firsts.values()], key=str)


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_long_structured_words_differ(spark):
    """Two words that any polynomial modulo a power of two confuses, of three lengths."""
    rows = []
    for n in (1024, 2048, 4096):
        x, y = thue_morse(n), thue_morse(n, "b", "a")
        texts = (f"{x} {x} {y}", y, x, f"{x}\n{y}", f"{y}\n{x}\n{x}", " ".join([x, y, x, x, y, y]), " ".join([y, x, x, x, y, y]))
        rows += [(n + i, t) for i, t in enumerate(texts)]
    docs = table(spark, rows).coalesce(4)
    items = [(1, x)]
    got = decontaminate.digest(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == test_decontaminate.brute(rows, items)
    assert sorted(map(tuple, jaccard.join_components(docs).collect()), key=str) == test_jaccard.brute(rows)
    assert sorted(map(tuple, lines.dedup_lines(docs, least_docs=3).collect()), key=str) == test_lines.brute(rows, 3, 1)
    data, offsets = bt.utf8(shards.pa.array([t for _, t in rows]))
    stats = rules.text_stats(data, offsets)
    for k, (_, t) in enumerate(rows):
        want = test_rules.brute(t)
        assert tuple(int(stats[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want[:5]


def test_hash_doesnt_depend_on_the_place():
    r = np.random.default_rng(1)
    data = r.integers(0, 4, 4000).astype(np.uint8)
    starts = np.sort(r.integers(0, 3900, 300))
    ends = starts + r.integers(0, 100, 300)
    h = bt.span_hash(data, starts, ends)
    alone = [bt.span_hash(data[a:z], np.array([0]), np.array([z - a]))[0] for a, z in zip(starts, ends, strict=True)]
    assert h.tolist() == alone
    by = {}
    assert all(by.setdefault(data[a:z].tobytes(), x) == x for a, z, x in zip(starts, ends, h, strict=True)) and len(set(by.values())) == len(by)
    assert (bt.span_hash(data, starts, ends, 1) != h).all()


def test_a_word_of_equal_hash_is_no_hit(monkeypatch):
    """Hits are compared by bytes: a hash that confuses all words of one length finds the right ones only."""
    monkeypatch.setattr(bt, "span_hash", lambda data, starts, ends, seed=0: (ends - starts).astype(np.uint64))
    phrases = decontaminate.Phrases.of([("1", "aa bbb")], 10)
    data, offsets = bt.utf8(shards.pa.array(["xx aa bbb yy zzz", "yy zzz", "aa bbb"]))
    f = decontaminate.search_shard(data, offsets, phrases)
    assert f.hit.tolist() == [False, True, True, False, False, False, False, True, True] and f.rows.tolist() == [0, 2]


@pytest.mark.parametrize("bits", range(20, 31))
def test_buckets_of_any_number(bits):
    buckets, r = 1 << bits, np.random.default_rng(bits)
    keys = np.unique(r.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2))
    asked = list(shards.hash_question(keys, np.zeros(len(keys), bool), buckets))
    assert sum(int.from_bytes(p[:4], "little") for _, p in asked) == len(keys) and all(0 <= b < buckets and b + shards.SECOND < 1 << 31 for b, _ in asked)
    b, p = asked[0]
    assert [x for _, x in shards.repeated_answer(b, [(0, p), (1, p)])] == [np.packbits(np.ones(int.from_bytes(p[:4], "little"), bool)).tobytes()] * 2
    rows = list(jaccard.ask_room(keys, np.full(len(keys), 50), np.zeros(len(keys), int), np.arange(len(keys)), buckets))
    assert sum(len(p) for _, p in rows) == 15 * len(keys)
