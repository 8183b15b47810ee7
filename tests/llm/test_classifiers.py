import random
import zlib

import numpy as np
import pytest

from lexweave.llm import language, quality
from tests.llm.cases import documents, frame, words


def fold(d, n):
    return zlib.crc32(str(d).encode()) % n


def corpus():
    r = random.Random(1)
    vocabulary = {"en": ["the", "thing", "ather", "ening", "shand"], "fr": ["leau", "quel", "ément", "oire", "ençais"], "de": ["schei", "ungen", "verb", "über", "tzend"]}
    docs, labels = [], []
    for i in range(600):
        lang = ("en", "fr", "de")[i % 3]
        w = [r.choice(vocabulary[lang]) + r.choice(vocabulary[lang]) for _ in range(r.randint(5, 150))]
        good = r.random() < 0.7
        text = " ".join(w).capitalize() if good else " ".join(x.upper() + "!!" for x in w)
        docs.append((i, text, lang, "s", len(text), 0, 0, "", "", "", 0))
        labels.append((i, int(good), 0))
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = corpus()
    table = spark.createDataFrame(labels + [(None, 1, 0), (3, None, None), (99999, 1, 0)], "doc_id long, quality int, toxic int")
    odd = [(5000 + i, t, None, None, 0, 0, 0, "", "", "", 0) for i, t in enumerate([None, "", " ", "x " * 40000])] + [(None, "abc", None, None, 0, 0, 0, "", "", "", 0), docs[0]]
    rows = quality.classify(frame(spark, docs + odd), table).collect()
    assert len(rows) == len(docs) + len(odd)
    truth = {d: q for d, q, _ in labels}
    out = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(out) > 60 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.97
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["doc_id"] is None or r["held_out"] == (fold(r["doc_id"], 5) == 0)
    kept = quality.keep_good(frame(spark, docs), table)
    assert kept.columns == frame(spark).columns and 0 < kept.count() < len(docs)


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.classify(frame(spark), none).collect()} == {0.5}
    assert quality.classify(frame(spark, []), none).collect() == []


def test_gradients_are_right():
    r = np.random.default_rng(3)
    m = quality.Model(5, hidden=4, gate=3)
    x, first, y = r.normal(size=(7, 5)), np.array([0, 2, 3, 7]), np.array([1.0, 0.0, 1.0])
    _, grads = m.gradients(x, first, y)
    for name in quality.Model.NAMES:
        p = getattr(m, name)
        for at in [tuple(r.integers(0, n) for n in p.shape) for _ in range(3)]:
            old, step = p[at], 1e-5
            p[at] = old + step
            up = m.gradients(x, first, y)[0]
            p[at] = old - step
            down = m.gradients(x, first, y)[0]
            p[at] = old
            assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-5, name


def test_passages_cover_the_whole_text():
    texts = ["", "a" * 5000, "word " * 700, "é" * 900, "b"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, first = quality.passages(data, offsets)
    for i in range(len(texts)):
        s, e = starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]]
        assert s[0] == offsets[i] and e[-1] == offsets[i + 1] and (s[1:] == e[:-1]).all()


def test_language_on_held_out_rows(spark):
    docs, _ = corpus()
    odd = [(5000 + i, t, None, None, 0, 0, 0, "", "", "", 0) for i, t in enumerate([None, "", "123 !!", "\n", "日本語"])]
    rows = language.identify(frame(spark, docs + odd), language.train(frame(spark, docs))).collect()
    truth = {d[0]: d[2] for d in docs}
    by = {r["doc_id"]: r for r in rows}
    out = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) > 0.97
    assert [by[5000 + i]["lang_pred"] for i in range(4)] == ["und"] * 4 and by[5004]["lang_pred"] in ("en", "fr", "de") and by[5004]["rejected"]
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_language_without_anything_to_learn(spark):
    assert language.train(frame(spark, [])) is None
    assert {r["lang_pred"] for r in language.identify(frame(spark), None).collect()} == {"und"}
    assert len(language.identify(frame(spark), language.train(frame(spark))).collect()) == len(documents())


@pytest.mark.parametrize("n", [1, 2])
def test_few_rows(spark, n):
    r = random.Random(n)
    docs = [(i, words(r, 5), "en", None, 0, 0, 0, "", "", "", 0) for i in range(n)]
    assert len(language.identify(frame(spark, docs), language.train(frame(spark, docs))).collect()) == n
