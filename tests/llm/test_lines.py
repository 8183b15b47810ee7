import hashlib
from collections import Counter

import numpy as np
import pytest

from lexweave.llm import lines
from tests.llm.cases import documents, frame


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))


def brute(docs, least_docs, least_chars):
    split = [(d, (t or "").split("\n")) for d, t in docs]
    count = Counter(k for _, ls in split for k in {key(x) for x in ls} if len(k) >= least_chars)
    out = []
    for d, ls in split:
        kept = [x for x in ls if not (len(key(x)) >= least_chars and count[key(x)] >= least_docs)]
        out.append((d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("least_docs", "least_chars"), [(10, 1), (2, 1), (2, 0), (3, 5)])
def test_against_brute_force(spark, least_docs, least_chars):
    docs = documents()
    common = [(500 + i, f"own {i}\n  Common LINE\t\n\n\r\x0bé\x0c", None, None, 0, 0, 0, "", "", "", 0) for i in range(12)]
    got = lines.dedup_lines(frame(spark, docs + common), least_docs, least_chars).collect()
    assert sorted(map(tuple, got), key=str) == brute([d[:2] for d in docs + common], least_docs, least_chars)


def test_empty(spark):
    assert lines.dedup_lines(frame(spark, [])).collect() == []


def test_perfect_hash():
    r = np.random.default_rng(1)
    keys = np.zeros(5000, lines.KEY)
    keys["h"], keys["f"] = r.integers(0, 2**63, 5000), r.integers(0, 2**32, 5000)
    keys["h"][:9] = 77  # equal hashes, different fingerprints
    assert sorted(lines.PerfectHash(keys)(keys).tolist()) == list(range(len(keys)))
    table = lines.LineTable(keys, np.arange(len(keys)))
    assert (table.probe(keys) == np.arange(len(keys))).all()
    other = keys.copy()
    other["f"] += np.uint32(1)
    assert (table.probe(other) == 0).mean() > 0.99
    again = lines.LineTable.from_bytes(table.to_bytes())
    assert (again.probe(keys) == np.arange(len(keys))).all() and (again.probe(other) == table.probe(other)).all()
    assert lines.LineTable(keys[:0], np.zeros(0)).probe(keys[:5]).tolist() == [0] * 5
    with pytest.raises(ValueError, match="distinct"):
        lines.PerfectHash(np.concatenate([keys, keys[:1]]))


def test_other_documents_probe_the_index(spark):
    """The index is a table by itself: documents that it wasn't built from probe its arrays."""
    old = spark.createDataFrame([(i, f"Common line\nown {i}\n twice" if i < 2 else f"common LINE \nown {i}") for i in range(6)], "doc_id long, text string")
    index = lines.line_index(lines.sh.pack(old), 4)
    assert index.columns == ["bucket", "n_keys", "arrays"] and sum(r["n_keys"] for r in index.collect()) == 8
    new = lines.sh.pack(spark.createDataFrame([(100, "COMMON line\nnew\ntwice"), (101, "new")], "doc_id long, text string").coalesce(1))
    bits = {}
    for r in lines.probe(new, index, 4, least_docs=2).collect():
        bits[r["bucket"]] = r["reply"]
    shard = next(lines.sh.unpack(next(iter(new.toArrow().to_batches()))))
    keys, _ = lines._shard_keys(shard, 1)
    known = set()
    for b, own in lines.sh.split_sorted(keys["h"], 4):
        if b in bits:
            hit = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=own.stop - own.start).astype(bool)
            known |= set(keys["h"][own][hit].tolist())
    want = [lines.bt.span_hash(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]))[0] for x in (b"common line", b"twice")]
    assert known == set(want)
