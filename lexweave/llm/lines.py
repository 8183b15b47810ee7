"""Line dedup: documents probe a sharded minimal perfect hash of line keys.

1. Each task sends the hash and fingerprint of every distinct line key of its
   documents, and in how many of them it stands, to the hash bucket of its
   leading bits. A bucket builds a minimal perfect hash over its distinct keys,
   which indexes a fingerprint and a count array, and writes them: the index.
2. Document shards probe the index: a bucket's arrays meet the distinct keys of
   every shard, and one bit for each goes back. Lines are never joined.

A key is known by 96 bits, a 64-bit hash and an independent 32-bit fingerprint.
Documents other than those of the index can probe it as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexweave.llm import bytestext as bt
from lexweave.llm import shards as sh
from lexweave.storage import materialize

LEAST_DOCS = 10
LEAST_CHARS = 1
#: Places of a level for each key that is left.
GAMMA = 1.5
MOST_LEVELS = 200
#: A line key's hash and fingerprint.
KEY = np.dtype([("h", "<u8"), ("f", "<u4")])
#: Keys that a task counts before it sends them.
TASK_KEYS = 1 << 19
_START = np.array([c & 0xC0 != 0x80 for c in range(256)])


def _spread(keys: np.ndarray) -> np.ndarray:
    """One number of a key's hash and fingerprint."""
    return bt.mix(keys["h"] ^ bt.mix(keys["f"].astype(np.uint64)))


class PerfectHash:
    """Minimal perfect hash of distinct keys (KEY): in each level a key alone at its place is set there, the others go on."""

    def __init__(self, keys: np.ndarray) -> None:
        self.n, self.levels = len(keys), []
        done, left = 0, _spread(keys)
        while len(left):
            m = max(64, int(GAMMA * len(left)))
            at = self._place(left, len(self.levels), m)
            alone = np.bincount(at, minlength=m) == 1
            words = np.zeros(m // 64 + 1, np.uint64)
            packed = np.packbits(alone.astype(np.uint8), bitorder="little")
            words.view(np.uint8)[: len(packed)] = packed
            before = done + np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((m, words, before))
            done = int(before[-1])
            left = left[~alone[at]]
            if len(self.levels) > MOST_LEVELS:
                raise ValueError("keys aren't distinct")

    @staticmethod
    def _place(spread: np.ndarray, level: int, m: int) -> np.ndarray:
        h = bt.mix(spread + np.uint64((level + 1) * int(bt.BASE) & 0xFFFFFFFFFFFFFFFF))
        return (h % np.uint64(m)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, 0 to n - 1; -1 or any number for a key that wasn't given."""
        out, left, spread = np.full(len(keys), -1, np.int64), np.arange(len(keys)), _spread(keys)
        for level, (m, words, before) in enumerate(self.levels):
            at = self._place(spread[left], level, m)
            low = (at & 63).astype(np.uint64)
            word = words[at >> 6]
            here = (word >> low) & np.uint64(1) == 1
            out[left[here]] = (before[at >> 6] + np.bitwise_count(word & ((np.uint64(1) << low) - np.uint64(1))))[here]
            left = left[~here]
        return out


class LineTable:
    """Fingerprints and counts in the order of a perfect hash."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.index = PerfectHash(keys)
        at = self.index(keys)
        self.fingerprints, self.counts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32)
        self.fingerprints[at] = keys["f"]
        self.counts[at] = np.minimum(counts, 0xFFFFFFFF)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 where the fingerprint differs."""
        at = self.index(keys)
        known = at >= 0
        known[known] = self.fingerprints[at[known]] == keys["f"][known]
        return np.where(known, self.counts[np.where(known, at, 0)] if len(self.counts) else 0, 0)

    def to_bytes(self) -> bytes:
        sizes = np.array([self.index.n, len(self.index.levels), *(m for m, _, _ in self.index.levels)], "<i8")
        return sh.compress(b"".join(x.tobytes() for x in (sizes, *(a for _, w, b in self.index.levels for a in (w, b)), self.fingerprints, self.counts)))

    @classmethod
    def from_bytes(cls, packed: bytes) -> LineTable:
        raw, at = sh.decompress(packed), 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self, n_levels = cls.__new__(cls), 0
        self.index = PerfectHash.__new__(PerfectHash)
        self.index.n, n_levels = take("<i8", 2).tolist()
        self.index.levels = [(m, take("<u8", m // 64 + 1), take("<i8", m // 64 + 2)) for m in take("<i8", n_levels).tolist()]
        self.fingerprints, self.counts = take("<u4", self.index.n), take("<u4", self.index.n)
        return self


def line_keys(data: np.ndarray, offsets: np.ndarray, least_chars: int) -> tuple[np.ndarray, ...]:
    """Start, end, row and key of each line, and whether its key is long enough."""
    n = len(offsets) - 1
    feed = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], feed + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], feed]), kind="stable")
    row = np.repeat(np.arange(n), 1 + np.diff(np.searchsorted(feed, offsets)))
    ws, we, _ = bt.word_bounds(data, offsets, bt.NONSPACE)
    lo, hi = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    some = hi > lo
    s, e = starts.copy(), starts.copy()
    s[some], e[some] = ws[lo[some]], we[hi[some] - 1]
    low = bt.LOWER[data]
    keys = np.empty(len(s), KEY)
    keys["h"], keys["f"] = bt.span_hash(low, s, e), bt.span_hash(low, s, e, 1) >> np.uint64(32)
    chars = np.concatenate([[0], np.cumsum(_START[data], dtype=np.int64)])
    return starts, ends, row, keys, chars[e] - chars[s] >= least_chars


def _distinct(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.lexsort((keys["f"], keys["h"]))
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


def _shard_keys(s: sh.Shard, least_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a shard's documents in order, and in how many of them each stands."""
    _, _, row, keys, ok = line_keys(s.data, s.offsets, least_chars)
    keys, row = keys[ok], row[ok]
    order = np.lexsort((row, keys["f"], keys["h"]))
    keys, row = keys[order], row[order]
    once = np.ones(len(keys), bool)
    once[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return _distinct(keys[once], np.ones(int(once.sum()), np.int64))


def line_index(packed: DataFrame, buckets: int, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The written index: bucket, n_keys, arrays (LineTable). Keys of one bucket are those whose hash has its leading bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = _distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            rows = [(b, sh.compress(keys[own].tobytes() + counts[own].tobytes())) for b, own in sh.split_sorted(keys["h"], buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], ["bucket", "payload"])

        for batch in batches:
            for s in sh.unpack(batch):
                held.append(_shard_keys(s, least_chars))
                if sum(len(k) for k, _ in held) >= TASK_KEYS:
                    yield from flush()
        if held:
            yield from flush()

    def build(table: pa.Table) -> pa.Table:
        raw = [sh.decompress(p) for p in table.column("payload").to_pylist()]
        sizes = [len(r) // (KEY.itemsize + 8) for r in raw]
        keys, counts = _distinct(np.concatenate([np.frombuffer(r, KEY, n) for r, n in zip(raw, sizes, strict=True)]), np.concatenate([np.frombuffer(r, "<i8", n, KEY.itemsize * n) for r, n in zip(raw, sizes, strict=True)]))
        return pa.table({"bucket": table.column("bucket")[:1], "n_keys": pa.array([len(keys)], pa.int64()), "arrays": pa.array([LineTable(keys, counts).to_bytes()], pa.binary())})

    counted = packed.mapInArrow(count, "bucket int, payload binary")
    return materialize(counted.groupBy("bucket").applyInArrow(build, "bucket int, n_keys long, arrays binary"), "lineindex")


def probe(packed: DataFrame, index: DataFrame, buckets: int, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(shard, bucket, reply): for each distinct key of a shard, in order, a bit whether the index counts least_docs documents for it."""

    def emit(s: sh.Shard) -> Iterator[tuple[int, bytes]]:
        keys, _ = _shard_keys(s, least_chars)
        for b, own in sh.split_sorted(keys["h"], buckets):
            yield b, keys[own].tobytes()

    def meet(asked: pa.Table, arrays: pa.Table) -> pa.Table:
        table = LineTable.from_bytes(arrays.column("arrays")[0].as_py()) if len(arrays) else LineTable(np.zeros(0, KEY), np.zeros(0))
        rows = []
        for batch in asked.to_batches():
            for bucket, shard, p in zip(*(batch.column(c).to_pylist() for c in ("bucket", "shard", "payload")), strict=True):
                bits = table.probe(np.frombuffer(p, KEY)) >= least_docs
                if bits.any():
                    rows.append((shard, bucket, np.packbits(bits).tobytes()))
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([r[1] for r in rows], pa.int32()), "reply": pa.array([r[2] for r in rows], pa.binary())})

    return sh.ask(packed, emit).groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(meet, "shard long, bucket int, reply binary")


RESULT = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def dedup_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, with_text: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_lines, n_dropped, kept_sha256 (and kept_text).

    A line's key is the line without ASCII whitespace at its ends, A-Z
    lower-cased. Keys of least_chars code points found in least_docs rows lose
    all their lines. A null or empty text is one empty line, which is kept if
    least_chars is at least 1. Each row counts as a document, whatever its id.
    Other columns are ignored; an empty table gives an empty result.
    """
    packed = sh.pack(docs)
    buckets = sh.bucket_count(packed, 0.05)
    answers = probe(packed, line_index(packed, buckets, least_chars), buckets, least_docs, least_chars)

    def apply(s: sh.Shard, replies: dict[int, bytes]) -> pa.RecordBatch:
        starts, ends, row, own_keys, ok = line_keys(s.data, s.offsets, least_chars)
        keys, back = np.unique(own_keys[ok], return_inverse=True)  # by hash, then fingerprint: the order of the question
        gone = np.zeros(len(keys), bool)
        for b, own in sh.split_sorted(keys["h"], buckets):
            if b in replies:
                gone[own] = np.unpackbits(np.frombuffer(replies[b], np.uint8), count=own.stop - own.start).astype(bool)
        drop = np.zeros(len(row), bool)
        drop[ok] = gone[back]
        n_lines = np.bincount(row, minlength=len(s.ids))
        n_dropped = np.bincount(row[drop], minlength=len(s.ids))
        at, shas, texts, raw = np.concatenate([[0], np.cumsum(n_lines)]), [], [], s.data.tobytes()
        for r in range(len(s.ids)):
            if n_dropped[r]:
                kept = b"\n".join(raw[starts[k] : ends[k]] for k in range(at[r], at[r + 1]) if not drop[k])
            else:
                kept = raw[s.offsets[r] : s.offsets[r + 1]]
            shas.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode("utf-8", "replace"))
        columns = [s.id_array(), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(shas, pa.string())]
        return pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())] * with_text, ["doc_id", "n_lines", "n_dropped", "kept_sha256"] + ["kept_text"] * with_text)

    return sh.finish(packed, answers, apply, RESULT + ", kept_text string" * with_text)


def op10_perfect_hash_lines(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, k, lines[k] AS line,
         translate(regexp_replace(regexp_replace(lines[k], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS k FROM d)
), f AS (
  SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), m AS (
  SELECT l.*, f.key IS NOT NULL AS gone FROM l LEFT JOIN f USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (r) GROUP BY r
"""
