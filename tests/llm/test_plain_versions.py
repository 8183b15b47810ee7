"""Operators against plain-Python versions written from their descriptions: one value at a time, no arrays."""

import math
import re
import struct

import numpy as np
import xxhash

from lexweave.llm import language, licenses, quality, sharding
from tests.llm.cases import documents, frame
from tests.llm.test_classifiers import corpus

ODD = [(5000 + i, t, None, None, 0, 0, 0, "", "", "", 0) for i, t in enumerate([None, "", " ", "!", "Why? NO!! x|y", "é à ü ", "a" * 1300, "日本語 テキスト " * 60, "one\ntwo\n\nthree " * 90])]


def passage_cuts(raw):
    """About equal parts of 512 bytes at most, inner cuts moved to a space that follows within a quarter."""
    parts = max(1, -(-len(raw) // quality.PASSAGE_BYTES))
    cuts = [0]
    for k in range(1, parts):
        at = len(raw) * k // parts
        space = next((i for i in range(at, len(raw)) if raw[i] in b" \t\n\x0b\x0c\r"), len(raw))
        cuts.append(space if space < min(at + quality.PASSAGE_BYTES // 4, len(raw)) else at)
    return list(zip(cuts, [*cuts[1:], len(raw)], strict=True))


def plain_features(raw):
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw)]
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    out = []
    for a, z in passage_cuts(raw):
        own = raw[a:z]
        x = [sum(1 for c in own if s[c]) / max(len(own), 1) for s in quality._SETS]
        # words that start in the passage; the word before the first counts as its neighbour
        at = [k for k, (s, _) in enumerate(words) if a <= s < z]
        n = max(len(at), 1)
        text = [lower[s:e] for s, e in words]
        x.append(sum(words[k][1] - words[k][0] for k in at) / n / 10)
        x.append(len({text[k] for k in at}) / n)
        x.append(sum(1 for k in at if k and text[k] == text[k - 1]) / n)
        x.append(min(len(at), 100) / 100)
        x.append(math.log1p(len(own)) / 7)
        alnum = lambda c: 48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123 or c >= 128
        x.append(sum(1 for k in at if not alnum(raw[words[k][1] - 1])) / n)
        pairs = [0] * quality.PAIRS
        for i in range(a, min(z, len(raw) - 1)):
            pairs[((lower[i] * 31 + lower[i + 1]) * 2654435761 % (1 << 32) >> 16) % quality.PAIRS] += 1
        out.append(x + [4 * c / max(len(own), 1) for c in pairs])
    return out


def plain_score(m, bag):
    sigm = lambda v: 1 / (1 + math.exp(-v))
    dot = lambda v, w: sum(p * q for p, q in zip(v, w, strict=True))
    hs, es = [], []
    for x in bag:
        x = [(v - a) / s for v, a, s in zip(x, m.mean.tolist(), m.scale.tolist(), strict=True)]
        h = [math.tanh(dot(x, c) + b) for c, b in zip(m.W.T.tolist(), m.b.tolist(), strict=True)]
        hs.append(h)
        es.append(sum(a * math.tanh(dot(h, v)) * sigm(dot(h, u)) for a, v, u in zip(m.a.tolist(), m.V.T.tolist(), m.U.T.tolist(), strict=True)))
    weight = [math.exp(e - max(es)) for e in es]
    z = [sum(w * h[k] for w, h in zip(weight, hs, strict=True)) / sum(weight) for k in range(len(hs[0]))]
    return sigm(max(-30, min(30, dot(z, m.c.tolist()) + float(m.d[0]))))


def test_quality_scores(spark):
    docs, labels = corpus()
    m = quality.train(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = docs[:40] + ODD
    got = {r["doc_id"]: r["score"] for r in quality.score_expr(frame(spark, rows, 2), m).collect()}
    for d, t, *_ in rows:
        assert abs(got[d] - plain_score(m, plain_features((t or "").encode()))) < 1e-4, t


def plain_grams(text):
    folded = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in (text or "").encode())
    folded = re.sub(rb" +", b" ", folded)
    out = {}
    for k in (1, 2, 3):
        for i in range(len(folded) - k + 1):
            h = 0
            for c in folded[i : i + k]:
                h = (h * 257 + c + 1) % (1 << 32)
            place = (h * 2654435761 % (1 << 32) >> 16) % language.DIM
            out[place] = out.get(place, 0) + 1
    return out


def test_languages(spark):
    docs, _ = corpus()
    m = language.train(frame(spark, docs))
    assert sorted(m.names) == sorted(["de", "en", "fr"] * language.CENTROIDS)
    rows = docs[:60] + ODD
    got = {r["doc_id"]: r for r in language.identify(frame(spark, rows), m).collect()}
    idf, points = m.idf.tolist(), m.points.tolist()
    for d, t, *_ in rows:
        if t is None or not any(c.isalpha() for c in t):
            assert tuple(got[d][c] for c in ("lang_pred", "score", "rejected")) == ("und", 0.0, True)
            continue
        v = {g: math.log1p(n) * idf[g] for g, n in plain_grams(t).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cos = [sum(x * p[g] for g, x in v.items()) / norm for p in points]
        best = max(range(len(cos)), key=lambda i: cos[i])
        assert got[d]["lang_pred"] == m.names[best] and abs(got[d]["score"] - cos[best]) < 1e-9
        assert got[d]["rejected"] == (1 - cos[best] > m.far[best] + 1e-9)


def test_centroids_are_settled():
    """Of plain k-means: each document is nearest to the centroid that is the mean direction of its own documents."""
    docs, _ = corpus()
    counts = np.zeros((80, language.DIM), int)
    for i, (_, t, *_) in enumerate([d for d in docs if d[2] == "en"][:80]):
        for g, n in plain_grams(t).items():
            counts[i, g] = n
    idf = language.inverse_frequency(80, (counts > 0).sum(0))
    assert all(math.isclose(idf[g], math.log(81 / (1 + sum(1 for row in counts if row[g]))) + 0.1) for g in range(0, language.DIM, 97))
    c, far = language.cluster(counts, idf, rounds=40)
    vectors = [[math.log1p(x) * w for x, w in zip(row, idf.tolist(), strict=True)] for row in counts.tolist()]
    vectors = [[x / math.sqrt(sum(y * y for y in v)) for x in v] for v in vectors]
    near = [max(range(len(c)), key=lambda i: sum(x * y for x, y in zip(v, c[i].tolist(), strict=True))) for v in vectors]
    for i in range(len(c)):
        total = [sum(x) for x in zip(*(v for v, k in zip(vectors, near, strict=True) if k == i), strict=True)]
        norm = math.sqrt(sum(x * x for x in total))
        assert all(abs(x / norm - y) < 1e-9 for x, y in zip(total, c[i].tolist(), strict=True))
        assert all(1 - sum(x * y for x, y in zip(v, c[i].tolist(), strict=True)) <= far[i] + 0.05 for v, k in zip(vectors, near, strict=True) if k == i)


def draw(parts, weight):
    """-ln(u) / weight, u from Spark's xxhash64 of the parts, chained by seed from 42."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else struct.pack("<i", p), seed)
    return -math.log(((seed >> 12) + 0.5) / (1 << 52)) / weight if weight > 0 else math.inf


def descend(key, weights, base, rack, racks):
    """Regions of `racks` racks of `rack` shards; shards beyond `base` each have a region of their own."""
    regions = []
    for r in range(0, base, rack * racks):
        own = list(range(r, min(base, r + rack * racks)))
        regions.append([own[i : i + rack] for i in range(0, len(own), rack)])
    regions += [[[s]] for s in range(base, len(weights))]
    least = lambda n, parts, weight: min(range(n), key=lambda i: (draw([key, *parts, i], weight(i)), i))
    a = least(len(regions), ["region"], lambda i: sum(weights[s] for x in regions[i] for s in x))
    b = least(len(regions[a]), ["rack", a], lambda i: sum(weights[s] for s in regions[a][i]))
    c = least(len(regions[a][b]), ["shard", a * 1000 + b], lambda i: weights[regions[a][b][i]])
    return regions[a][b][c]


def test_shards(spark):
    rows = sharding.shard_documents(frame(spark)).collect()
    for r in rows:
        key = "null" if r["doc_id"] is None else str(r["doc_id"])
        assert r["shard"] == descend(key, [1.0] * 40, 40, 4, 2)
        assert r["grown_shard"] == descend(key, [1.0] * 41, 40, 4, 2)
    tree = sharding.Tree((3.0, 0.0, 1.0, 2.0, 5.0, 0.5, 1.0), 6, 2, 2)
    for r in sharding.place(frame(spark).select("doc_id"), "doc_id", tree).collect():
        assert r["shard"] == descend("null" if r["doc_id"] is None else str(r["doc_id"]), tree.weights, 6, 2, 2)


def plain_scan(text, templates):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    labels, score = set(), 0.0
    for kind, label, t in templates:
        n, votes = len(t) - 1, {}
        for p in range(len(w) - 1):
            for q in range(n):
                if w[p : p + 2] == t[q : q + 2]:
                    votes.setdefault(p - q, []).append((p, q))
        islands = []
        for d in sorted(votes):
            if islands and d - islands[-1][-1] <= licenses.GAP:
                islands[-1].append(d)
            else:
                islands.append([d])
        for own in islands:
            hits = [x for d in own for x in votes[d]]
            share = len({q for _, q in hits}) / n
            lo, hi = min(p for p, _ in hits), max(p for p, _ in hits) + 2
            score = max(score, share)
            if kind == "own" and share >= licenses.LEAST_SHARE and hi - lo <= 2 * (n + 1):
                labels.add(label)
            if kind == "base" and any(len(votes[d]) == n for d in own):
                labels.add(label)
    return len(w), ",".join(sorted(labels)), score


def test_licenses(spark):
    mit = dict(licenses.TEXTS)["mit-text"]
    edited = mit.replace("merge, publish, ", "").replace("sublicense", "sub license it").upper()
    texts = [mit, "Before. " + edited + " After.", mit[: len(mit) // 2], mit + "\n\n" + dict(licenses.TEXTS)["bsd-3-clause-text"], "Licensed under CC BY-SA 4.0, all rights reserved"]
    rows = documents() + [(900 + i, t, None, None, 0, 0, 0, "", "", "", 0) for i, t in enumerate(texts)]
    own = [(kind, label, w) for _, kind, label, w in licenses.TEMPLATES]
    got = licenses.scan(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["labels"], round(r["score"], 9)) for r in got) == sorted((str(d), n, ls, round(s, 9)) for d, t, *_ in rows for n, ls, s in [plain_scan(t, own)])
    by = {r["doc_id"]: r["labels"].split(",") for r in got}
    assert "mit-text" in by[900] and "mit-text" in by[901] and "mit-text" not in by[902] and {"mit-text", "bsd-3-clause-text"} <= set(by[903])


def test_licenses_of_a_given_table(spark):
    table = spark.createDataFrame([("house", "You may read this and nothing more"), ("one", "word"), (None, "x y"), ("none", None)], "label string, text string")
    docs = spark.createDataFrame([(1, "so: you MAY read this, and nothing more."), (2, "may read"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(docs, table).collect()}
    assert got == {1: "house", 2: "", 3: ""}
