"""Benchmark decontamination with an FM-index over each training shard.

A shard is a run of whole documents of about SHARD_BYTES. Its words become
symbols of the test phrases' vocabulary; words outside it cannot stand in an
occurrence and end a run of words, as a document's end does. Runs too short
for any phrase are left out. Over the rest an FM-index is built: suffix order,
Burrows-Wheeler transform in a wavelet matrix, and positions sampled every
SAMPLE words and at each run's start. All phrases are searched backwards
together, occurrences are located by walking to a sampled position, and their
spans are merged by document.

Phrases are windows of `n` consecutive words of an item; an item of fewer
words, but not none, is one window. Documents never leave their task, so that
nothing is shuffled. Phrases go to the tasks in blocks of at most PHRASE_CHARS
characters of test text, one block after the other: a larger test set takes
several passes over the uncut texts, between which texts are written with the
words and items that were hit so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm import bytestext as bt
from lexweave.storage import materialize

N = 10
SHARD_BYTES = 8 << 20
SAMPLE = 16
PHRASE_CHARS = 16 << 20


class Wavelet:
    """Wavelet matrix over non-negative symbols: rank and access for arrays of positions."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.n, self.bits = len(symbols), max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        cur = symbols
        for shift in range(self.bits - 1, -1, -1):
            b = (cur >> shift) & 1
            packed = np.packbits(b.astype(np.uint8), bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=ones[1:])
            zeros = self.n - int(ones[-1])
            self.levels.append((words, ones, zeros))
            cur = np.concatenate([cur[b == 0], cur[b == 1]])
        self.first = np.searchsorted(self._bitrev(cur), self._bitrev(np.arange(sigma)), "left")

    def _bitrev(self, x: np.ndarray) -> np.ndarray:
        # the last level's order is by reversed bits
        out = np.zeros_like(x)
        for i in range(self.bits):
            out |= ((x >> i) & 1) << (self.bits - 1 - i)
        return out

    @staticmethod
    def _rank1(words: np.ndarray, ones: np.ndarray, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return ones[w] + np.bitwise_count(low)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before position i."""
        start = self.first[c]
        for k, (words, ones, zeros) in enumerate(self.levels):
            r = self._rank1(words, ones, i)
            i = np.where((c >> (self.bits - 1 - k)) & 1, zeros + r, i - r)
        return i - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i, and how often it stands before i."""
        c = np.zeros(len(i), np.int64)
        for words, ones, zeros in self.levels:
            r = self._rank1(words, ones, i)
            bit = (words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)
            c = c * 2 + bit.astype(np.int64)
            i = np.where(bit, zeros + r, i - r)
        return c, i - self.first[c]


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Suffixes of seq in order; a suffix ends at its first 0, and equal ones are in text order."""
    n = len(seq)
    rank = np.empty(n, np.int64)
    # the first four symbols at once; what follows a 0 doesn't count
    width = max(1, int(seq.max(initial=1)).bit_length())
    k = max(1, min(4, 62 // width))
    key, live = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(k):
        s = np.zeros(n, np.int64)
        s[: max(0, n - j)] = seq[j:]
        s[~live] = 0
        live &= s > 0
        key = (key << width) | s
    order = np.argsort(key, kind="stable")
    ended = ~live
    while True:
        sorted_key = key[order]
        new = np.empty(n, bool)
        new[:1] = True
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        new |= ended[order]
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = head
        # a suffix that is alone, or that has ended, keeps its place
        alone = new.copy()
        alone[:-1] &= new[1:]
        if alone.all():
            return order
        place = np.flatnonzero(~alone)
        own = order[place]
        nxt = np.minimum(own + k, n - 1)
        pair = rank[own] * np.int64(n) + rank[nxt]
        srt = np.argsort(pair, kind="stable")
        order[place] = own[srt]
        key = rank * np.int64(n)
        key[own] = pair
        ended = np.zeros(n, bool)
        k *= 2


class FMIndex:
    """seq: symbols from 1, runs ended by 0; its last symbol is 0."""

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = SAMPLE) -> None:
        sa = suffix_order(seq)
        before = seq[sa - 1]
        before[sa == 0] = 0
        self.wavelet = Wavelet(before, sigma)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))])[:sigma]
        self.more = self.less + np.bincount(seq, minlength=sigma)
        self.sampled = (sa % sample == 0) | (before == 0)
        self.at = np.cumsum(self.sampled) - 1
        self.values = sa[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of each pattern; patterns: (count, length) of symbols, none 0."""
        last = patterns[:, -1]
        lo, hi = self.less[last].copy(), self.more[last].copy()
        for j in range(patterns.shape[1] - 2, -1, -1):
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            c = patterns[live, j]
            lo[live] = self.less[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.less[c] + self.wavelet.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row."""
        out = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            done = self.sampled[at]
            out[todo[done]] = self.values[self.at[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            if len(todo):
                c, before = self.wavelet.access(at)
                at = self.less[c] + before
            steps += 1
        return out


@dataclass
class Phrases:
    """vocab: sorted word hashes, symbol i + 1; its word: text[text_at[i]:text_at[i + 1]]; windows: by length, (symbols, window numbers); items of window i: items[first[i]:first[i + 1]]."""

    names: list[str]
    vocab: np.ndarray
    text: np.ndarray
    text_at: np.ndarray
    windows: dict[int, tuple[np.ndarray, np.ndarray]]
    first: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[str, str]], n: int) -> Phrases:
        names = sorted({i for i, _ in rows if i is not None})
        number = {x: k for k, x in enumerate(names)}
        data, offsets = bt.utf8(pa.array([t for _, t in rows], pa.large_string()))
        starts, ends, per = bt.word_bounds(data, offsets, bt.ALNUM)
        data = bt.LOWER[data]
        vocab, place, symbol = np.unique(bt.span_hash(data, starts, ends), return_index=True, return_inverse=True)
        text_at = np.concatenate([[0], np.cumsum((ends - starts)[place])])
        text = np.concatenate([np.zeros(0, np.uint8), *(data[a:z] for a, z in zip(starts[place], ends[place], strict=True))])
        symbol = symbol.astype(np.int64) + 1
        of: dict[tuple[int, ...], set[int]] = {}
        for r, (item, _) in enumerate(rows):
            own = symbol[per[r] : per[r + 1]].tolist()
            for k in range(max(1, len(own) - n + 1) if own else 0):
                items = of.setdefault(tuple(own[k : k + n]), set())
                if item is not None:
                    items.add(number[item])
        keys = list(of)
        first = np.cumsum([0, *(len(of[k]) for k in keys)])
        items = np.array([i for k in keys for i in sorted(of[k])], np.int64)
        windows = {}
        for length in sorted({len(k) for k in keys}):
            own = [i for i, k in enumerate(keys) if len(k) == length]
            windows[length] = (np.array([keys[i] for i in own], np.int64), np.array(own))
        return cls(names, vocab, text, text_at, windows, first, items)

    def are_words(self, symbol: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether each span's bytes are the word of its symbol, and not only of one hash with it."""
        at = self.text_at[symbol - 1]
        size = ends - starts
        ok = size == self.text_at[symbol] - at
        i = np.flatnonzero(ok)
        size = size[i]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        differ = bt.LOWER[data[np.repeat(starts[i], size) + inner]] != self.text[np.repeat(at[i], size) + inner]
        ok[i] = np.bincount(np.repeat(np.arange(len(i)), size)[differ], minlength=len(i)) == 0
        return ok


@dataclass
class Found:
    """Of a shard: words by row, word bounds, which words are hit, and (row, item) pairs in order."""

    per: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hit: np.ndarray
    rows: np.ndarray
    items: np.ndarray


def _covered(found: np.ndarray, n: int) -> np.ndarray:
    """Which of n words some occurrence (first word, word after the last, ...) covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0], 1)
    np.add.at(edge, found[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def search_shard(data: np.ndarray, offsets: np.ndarray, phrases: Phrases) -> Found:
    starts, ends, per = bt.word_bounds(data, offsets, bt.ALNUM)
    n = len(starts)
    none = Found(per, starts, ends, np.zeros(n, bool), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not n or not phrases.windows:
        return none
    h = bt.span_hash(bt.LOWER[data], starts, ends)
    at = np.minimum(np.searchsorted(phrases.vocab, h), len(phrases.vocab) - 1)
    symbol = np.where(phrases.vocab[at] == h, at + 1, 0)
    # runs of vocabulary words within a document that can hold the shortest phrase
    known = np.flatnonzero(symbol)
    if not len(known):
        return none
    doc = np.repeat(np.arange(len(per) - 1), np.diff(per))
    gap = np.ones(len(known), bool)
    gap[1:] = (np.diff(known) != 1) | (doc[known[1:]] != doc[known[:-1]])
    head = np.flatnonzero(gap)
    size = np.diff(np.append(head, len(known)))
    keep = np.repeat(size >= min(phrases.windows), size)
    known, gap = known[keep], gap[keep]
    if not len(known):
        return none
    new = np.arange(len(known)) + np.cumsum(gap) - 1
    seq, where = np.zeros(new[-1] + 2, np.int64), np.zeros(new[-1] + 2, np.int64)
    seq[new], where[new] = symbol[known], known
    index = FMIndex(seq, len(phrases.vocab) + 1)
    found = []
    for length, (patterns, numbers) in phrases.windows.items():
        lo, hi = index.search(patterns)
        count = np.maximum(hi - lo, 0)
        if not count.sum():
            continue
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        word = where[index.locate(rows)]
        found.append(np.stack([word, word + length, np.repeat(numbers, count)], 1))
    if not found:
        return none
    found = np.concatenate(found)
    hit = _covered(found, n)
    # a word that only shares a vocabulary word's hash is none: what covers it doesn't occur
    at = np.flatnonzero(hit)
    wrong = np.zeros(n + 1, np.int64)
    wrong[at + 1] = ~phrases.are_words(symbol[at], data, starts[at], ends[at])
    wrong = np.cumsum(wrong)
    if wrong[-1]:
        found = found[wrong[found[:, 1]] == wrong[found[:, 0]]]
        hit = _covered(found, n)
    pairs = np.unique(np.stack([doc[found[:, 0]], found[:, 2]], 1), axis=0)
    some = np.diff(phrases.first)[pairs[:, 1]]
    rows = np.repeat(pairs[:, 0], some)
    begin = np.repeat(phrases.first[pairs[:, 1]] - np.concatenate([[0], np.cumsum(some)[:-1]]), some)
    items = phrases.items[begin + np.arange(some.sum())]
    both = np.unique(np.stack([rows, items], 1), axis=0)
    return Found(per, starts, ends, hit, both[:, 0], both[:, 1])


def shards(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, offsets = bt.utf8(batch.column(text))
    for lo, hi in bt.cuts(offsets, SHARD_BYTES):
        yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def phrase_blocks(benchmark: DataFrame, n: int, most: int = PHRASE_CHARS) -> Iterator[Phrases]:
    """Items in blocks of about `most` characters, each small enough to send to every task."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // most))
    for k in range(blocks):
        own = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k)
        yield Phrases.of([tuple(r) for r in own.collect()], n)


@dataclass
class Hits:
    """What all blocks of phrases hit in a run of rows: words by row, word bounds, hit words, and the items' names by row, in order."""

    per: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hit: np.ndarray
    items: list[list[str]]

    def counts(self) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(self.hit)])
        return before[self.per[1:]] - before[self.per[:-1]]

    def spans(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the merged spans, and the words after their last."""
        own = self.hit[self.per[row] : self.per[row + 1]].astype(np.int8)
        turn = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
        return turn[::2], turn[1::2]


def _passes(docs: DataFrame, benchmark: DataFrame, n: int, finish: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, Hits], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """finish(rows, bytes, offsets, hits of all blocks of phrases) for runs of rows of docs.

    One block is held at a time. All but the last block's pass write the rows
    with two columns more: hit words as packed bits, and hit items.
    """
    names, blocks = docs.columns, phrase_blocks(benchmark, n)
    bits, items = (next(x for k in range(len(names) + 1) if (x := f"_{c}{k}") not in names) for c in ("bits", "items"))
    between = T.StructType([*docs.schema.fields, T.StructField(bits, T.BinaryType()), T.StructField(items, T.ArrayType(T.StringType()))])
    first, phrases = True, next(blocks)
    while phrases is not None:
        later = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast(phrases)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=first, last=later is None) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch, data, offsets in shards(whole, "text"):
                    f = search_shard(data, offsets, shared.value)
                    x = Hits(f.per, f.starts, f.ends, f.hit, [[] for _ in range(len(batch))])
                    for r, i in zip(f.rows.tolist(), f.items.tolist(), strict=True):
                        x.items[r].append(shared.value.names[i])
                    if not first:
                        for r, (b, own) in enumerate(zip(batch.column(bits).to_pylist(), batch.column(items).to_pylist(), strict=True)):
                            lo, hi = f.per[r], f.per[r + 1]
                            x.hit[lo:hi] |= np.unpackbits(np.frombuffer(b, np.uint8), count=hi - lo).astype(bool) if b else False
                            x.items[r] = sorted({*x.items[r], *own})
                    if last:
                        yield finish(batch.select(names), data, offsets, x)
                    else:
                        some = [np.packbits(x.hit[a:z]).tobytes() if x.hit[a:z].any() else None for a, z in zip(f.per[:-1], f.per[1:], strict=True)]
                        own = pa.array(x.items, pa.list_(pa.string()))
                        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(some, pa.binary()), own], [*names, bits, items])

        docs = docs.mapInArrow(run, schema if later is None else between)
        if later is not None:
            docs = materialize(docs, "marks")
            shared.unpersist()
        first, phrases = False, later
    return docs


DIGEST = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def digest(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words. Items of one id are one item; the words of an
    item without an id are hit, but it isn't listed. Rows with the same doc_id
    are judged apart. Other columns are ignored; empty tables are allowed.
    """

    def finish(batch: pa.RecordBatch, _: np.ndarray, __: np.ndarray, x: Hits) -> pa.RecordBatch:
        n_hit, empty = x.counts(), hashlib.sha256(b"").hexdigest()
        shas = [hashlib.sha256(",".join(own).encode()).hexdigest() if own else empty for own in x.items]
        n_items = [len(own) for own in x.items]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(x.per), pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(shas, pa.string()), pa.array(n_hit > 0)],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    return _passes(docs.select("doc_id", "text"), benchmark, n, finish, DIGEST)


SPANS = "doc_id long, n_words long, starts array<long>, ends array<long>, items array<string>"


def find_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row for each document: doc_id, n_words, its merged spans of hit words [starts, ends) and its items, in order."""

    def finish(batch: pa.RecordBatch, _: np.ndarray, __: np.ndarray, x: Hits) -> pa.RecordBatch:
        spans = [x.spans(r) for r in range(len(batch))]
        longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(x.per), pa.int64()), pa.array([s for s, _ in spans], longs), pa.array([e for _, e in spans], longs), pa.array(x.items, strings)],
            ["doc_id", "n_words", "starts", "ends", "items"],
        )

    return _passes(docs.select("doc_id", "text"), benchmark, n, finish, SPANS)


def _cut(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, x: Hits) -> pa.RecordBatch:
    """The batch without hit words and without rows of nothing else."""
    n_hit = x.counts()
    names = batch.schema.names
    columns = {c: batch.column(c) for c in names}
    if n_hit.any():
        texts = batch.column("text").to_pylist()
        for r in np.flatnonzero(n_hit):
            out, at, lo = [], offsets[r], x.per[r]
            for a, b in zip(*x.spans(r), strict=True):
                out.append(data[at : x.starts[lo + a]].tobytes())
                at = x.ends[lo + b - 1]
            out.append(data[at : offsets[r + 1]].tobytes())
            texts[r] = b" ".join(out).decode("utf-8", "replace")
        columns["text"] = pa.array(texts, batch.schema.field("text").type)
        if "n_chars" in columns:
            kind = batch.schema.field("n_chars").type
            columns["n_chars"] = pa.array([len(t) if h else c for t, h, c in zip(texts, n_hit, columns["n_chars"].to_pylist(), strict=True)], kind)
    left = pa.array((n_hit == 0) | (n_hit < np.diff(x.per)))
    return pa.RecordBatch.from_arrays(list(columns.values()), names).filter(left)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """Documents with all hit spans cut out of `text`; `n_chars`, if there, is set anew.

    A window of n words, or an item of fewer words as a whole, is cut wherever
    it occurs. A cut takes the bytes from the first to the last word of a
    merged span and leaves one space. A document that had hits and has no word
    left goes. Clean documents stay as they are, null and empty texts too.
    """
    return _passes(docs, benchmark, n, _cut, docs.schema)


def op1_fm_index(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP1_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), bw AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, k, k + least(10, len(w)) - 1), ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS k FROM bw WHERE len(w) > 0)
), pos AS (
  SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM dw
), occ AS (
  SELECT p.r, p.k, l.n, array_to_string(list_slice(p.w, p.k, p.k + l.n - 1), ' ') AS s
  FROM pos p, (SELECT DISTINCT n FROM win) l WHERE p.k + l.n - 1 <= len(p.w)
), hit AS (
  SELECT o.r, o.k, o.n, w.item FROM occ o JOIN win w ON o.n = w.n AND o.s = w.s
), words AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS k FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
