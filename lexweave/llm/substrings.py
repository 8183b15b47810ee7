"""Suffix-array dedup of byte strings that also stand in an earlier document.

Suffixes are compared over MATCH bytes at most, so a document's suffixes are
its windows of MATCH bytes. A window goes to the suffix bucket of its
minimizer, the least hash of its GRAM-byte strings: equal windows meet, and
consecutive windows with one minimizer travel as one stretch of text.

1. Shards ask which minimizers stand in two documents or more (five bytes for
   each distinct one). Windows of the others stand in one document only.
2. Shards send the stretches of repeated minimizers, each distinct one once,
   under its smallest doc_id. A bucket sorts their suffixes by difference-cover
   blockwise construction: the suffixes at places of a difference cover are
   ranked first; then the others are sorted one block of leading bytes at a
   time, by their first PERIOD bytes and, in longer ties, by the rank of the
   cover place that both reach by the same shift. Neighbours in that order that
   agree on MATCH bytes are one string, and its smallest doc_id is found.
3. One bit for each window goes back, and shards cut the covered bytes.

Memory is bounded by a shard's and a bucket's size; a string that stands in
very many documents reaches its bucket once for each shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm import bytestext as bt
from lexweave.llm import shards as sh
from lexweave.storage import materialize

MATCH = 50
GRAM = 25
SPAN = MATCH - GRAM + 1  # grams of a window
#: Places whose pairwise differences give every shift modulo PERIOD.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
SUB_BYTES = 1 << 20
#: Suffixes of one sorted block.
BLOCK = 1 << 19
NO_ID = np.iinfo(np.int64).max


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    s = 1
    while s * 2 <= w:
        x = np.minimum(x[:-s], x[s:])
        s *= 2
    return np.minimum(x[: len(x) - (w - s)], x[w - s :]) if s < w else x


@dataclass
class Stretches:
    """Windows p0 to p1 have their minimizer at `at`; row is the document's number in the shard; sig: a hash of the stretch's bytes and the minimizer's place in it."""

    p0: np.ndarray
    p1: np.ndarray
    at: np.ndarray
    hash: np.ndarray
    row: np.ndarray
    sig: np.ndarray


_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def gram_hash(words: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
    """Hash of the GRAM bytes from each place on; words: bytestext.words_at, at: places, or a slice of them."""
    shifted = (lambda k: words[at.start + k : at.stop + k]) if isinstance(at, slice) else (lambda k: words[at + k])
    h = shifted(0).astype(np.uint64)
    for k, step in zip((8, 16, GRAM - 8), _STEPS, strict=True):
        h = (h ^ (h >> np.uint64(32))) * step + shifted(k)
    return bt.mix(h)


def stretch_hash(first: np.ndarray, second: np.ndarray, last: np.ndarray, lead: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Hash of a stretch by those of its first, second and last gram, which cover it: it has at most three grams' bytes."""
    shape = (lead * MATCH + windows).astype(np.uint64)
    return bt.mix(bt.mix(bt.mix(first + shape) ^ second) * _STEPS[1] ^ last)


def stretches(data: np.ndarray, offsets: np.ndarray) -> Stretches:
    parts = []
    for lo, hi in bt.cuts(offsets, SUB_BYTES):
        base, own = offsets[lo], offsets[lo : hi + 1] - offsets[lo]
        d = data[base : offsets[hi]]
        n = len(d)
        if n < MATCH:
            continue
        edge = np.zeros(n + 1, np.int8)
        long = np.diff(own) >= MATCH
        edge[own[:-1][long]] += 1
        edge[own[1:][long] - MATCH + 1] -= 1
        idx = np.flatnonzero(np.cumsum(edge[:-1]))
        if not len(idx):
            continue
        h = gram_hash(bt.words_at(d), slice(0, n - GRAM + 1))
        i = np.arange(len(h))
        mask = np.uint64((1 << n.bit_length()) - 1)
        at = (sliding_min((h & ~mask) | i.astype(np.uint64), SPAN)[idx] & mask).astype(np.int64)
        turn = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (idx[1:] != idx[:-1] + 1)]))
        p0, p1, at = idx[turn], idx[np.append(turn[1:], len(idx)) - 1], at[turn]
        # least hashes are small: spread them again, for buckets by leading bits
        sig = stretch_hash(h[p0], h[p0 + GRAM], h[p1 + MATCH - GRAM], at - p0, p1 - p0 + 1)
        parts.append((p0 + base, p1 + base, at + base, bt.mix(h[at]), np.searchsorted(own, p0, "right") - 1 + lo, sig))
    if not parts:
        z = np.zeros(0, np.int64)
        return Stretches(z, z, z, np.zeros(0, np.uint64), z, np.zeros(0, np.uint64))
    return Stretches(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def packed_cuts(data: np.ndarray, offsets: np.ndarray) -> bytes:
    """Where a shard's stretches are, in six bytes each before compression."""
    s = stretches(data, offsets)
    gap = s.p0 - np.concatenate([[0], s.p1])[:-1]  # from the last window of the stretch before
    return gap.astype("<u4").tobytes() + (s.p1 - s.p0).astype(np.uint8).tobytes() + (s.at - s.p0).astype(np.uint8).tobytes()


def known_stretches(s: sh.Shard) -> Stretches:
    """The stretches of a shard from its packed cuts; only their own grams are hashed."""
    n = len(s.extra) // 6
    gap, windows, lead = (np.frombuffer(s.extra, kind, n, at).astype(np.int64) for kind, at in (("<u4", 0), (np.uint8, 4 * n), (np.uint8, 5 * n)))
    p1 = np.cumsum(gap + windows)
    p0, words = p1 - windows, bt.words_at(s.data)
    sig = stretch_hash(*(gram_hash(words, p) for p in (p0, p0 + GRAM, p1 + MATCH - GRAM)), lead, windows + 1)
    return Stretches(p0, p1, p0 + lead, bt.mix(gram_hash(words, p0 + lead)), np.searchsorted(s.offsets, p0, "right") - 1, sig)


def _minimizers(s: Stretches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, whether more than one row has them, and each stretch's number among them."""
    keys, back = np.unique(s.hash, return_inverse=True)
    low, high = np.full(len(keys), NO_ID), np.full(len(keys), -1)
    np.minimum.at(low, back, s.row)
    np.maximum.at(high, back, s.row)
    return keys, low != high, back


def _repeated(s: Stretches, replies: dict[int, bytes], buckets: int) -> np.ndarray:
    """Which stretches have a minimizer that stands in two documents or more."""
    keys, _, back = _minimizers(s)
    again = sh.repeated_bits(keys, replies, buckets)
    return again[back]


def _ids(s: sh.Shard) -> np.ndarray:
    return np.where(s.null_ids, NO_ID, s.ids)


@dataclass
class Groups:
    """Stretches of repeated minimizers by text: `of` gives each one's group, in order of the minimizer's hash; first: a stretch of the smallest id."""

    stretch: np.ndarray
    of: np.ndarray
    first: np.ndarray
    later: np.ndarray  # by stretch: its document isn't the smallest of its group


def _groups(s: Stretches, ids: np.ndarray, again: np.ndarray) -> Groups:
    at = np.flatnonzero(again)
    sig, doc = s.sig[at], ids[s.row[at]]
    order = np.lexsort((at, doc, sig, s.hash[at]))
    h, g = s.hash[at][order], sig[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])]) if len(at) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    first = order[new]
    of = np.empty(len(at), np.int64)
    of[order] = number
    return Groups(at, of, at[first], doc > doc[first][of] if len(at) else np.zeros(0, bool))


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all spans on end."""
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    return data[np.repeat(starts - before, sizes) + np.arange(sizes.sum())]


def _shifts() -> np.ndarray:
    """SHIFT[a, b]: the least d by which places of residues a and b both reach the cover."""
    inside = np.zeros(2 * PERIOD, bool)
    inside[list(COVER)] = inside[[c + PERIOD for c in COVER]] = True
    return np.array([[next(d for d in range(PERIOD) if inside[(a + d) % PERIOD] and inside[(b + d) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)])


SHIFT = _shifts()
SHIFT_OF = SHIFT.tolist()


class CoverRanks:
    """Ranks of the suffixes at the cover's places that suffixes at `places` reach; they are compared over `room` bytes.

    pairs: by the shifts of all pairs of residues, else by each residue's own.
    """

    def __init__(self, words: np.ndarray, places: np.ndarray, room: int, pairs: bool = False) -> None:
        top = int(places.max(initial=0)) + 2 * PERIOD
        wanted = np.zeros(top, bool)
        residues = np.unique(places % PERIOD)
        for a in residues.tolist() if pairs else ():
            own = places[places % PERIOD == a]
            for d in np.unique(SHIFT[a, residues]).tolist():
                wanted[own + d] = True
        wanted[places + SHIFT[places % PERIOD, places % PERIOD]] = True
        cover = np.flatnonzero(wanted)
        keys = [words[cover + k].astype(np.uint64) for k in range((room - 1) // 8 * 8, -1, -8)]
        order = np.lexsort(keys)
        new = np.zeros(len(cover), bool)
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        self.rank = np.zeros(top, np.int64)
        self.rank[cover[order]] = np.cumsum(new)

    def own(self, p: np.ndarray) -> np.ndarray:
        """The rank that each place reaches by its own residue's shift: an order among places of one residue."""
        r = p % PERIOD
        return self.rank[p + SHIFT[r, r]]

    def compare(self, i: int, j: int) -> int:
        """Order of two suffixes that agree on PERIOD bytes."""
        d = SHIFT_OF[i % PERIOD][j % PERIOD]
        return int(self.rank[i + d]) - int(self.rank[j + d])


def same_strings(text: np.ndarray, places: np.ndarray, room: int, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of places in suffix order, and whether each agrees with the one before it on MATCH bytes.

    Suffixes count as equal if they agree on `room` bytes, MATCH at least; text
    has PERIOD + room bytes and a word more after each place.
    """
    words = np.ndarray((len(text) - 7,), ">u8", np.ascontiguousarray(text), strides=(1,))
    ranks = CoverRanks(words, places, room)
    residue, own_rank = places % PERIOD, ranks.own(places)
    # blocks by the first two bytes
    lead = (words[places].astype(np.uint64) >> np.uint64(48)).astype(np.uint16)
    by = np.argsort(lead, kind="stable")
    ends = np.flatnonzero(np.diff(lead[by])) + 1
    cut = 0
    while cut < len(by):
        k = np.searchsorted(ends, cut + block, "right") - 1
        end = len(by) if len(by) - cut <= block else int(ends[k]) if k >= 0 and ends[k] > cut else int(next((e for e in ends if e > cut), len(by)))
        own = by[cut:end]
        p = places[own]
        keys = [words[p + k].astype(np.uint64) for k in (24, 16, 8, 0)]
        o = np.lexsort((own_rank[own], residue[own], *keys))
        p, own = p[o], own[o]
        keys = [k[o] for k in keys]
        # long ties: suffixes of one residue are in order by their own shift, others by the shift of the pair
        tie = np.ones(max(0, len(p) - 1), bool)
        for k in keys:
            tie &= k[1:] == k[:-1]
        group = np.concatenate([[0], np.cumsum(~tie)]) if len(p) else np.zeros(0, np.int64)
        mixed = np.unique(group[1:][tie & (residue[own][1:] != residue[own][:-1])])
        if len(mixed):
            wide, at = CoverRanks(words, p[np.isin(group, mixed)], room, pairs=True), p.tolist()
            for a, z in zip(np.searchsorted(group, mixed), np.searchsorted(group, mixed, "right"), strict=True):
                order = sorted(range(a, z), key=cmp_to_key(lambda x, y, at=at: wide.compare(at[x], at[y])))
                p[a:z], own[a:z] = p[order], own[order]
        # the first 32 bytes agree within a tie; the rest is compared
        agree = np.zeros(len(p), bool)
        agree[1:] = tie
        for k in (*range(32, MATCH - 8, 8), MATCH - 8):
            last = words[p + k].astype(np.uint64)
            agree[1:] &= last[1:] == last[:-1]
        yield own, agree
        cut = end


def bucket_hits(ids: np.ndarray, lead: np.ndarray, windows: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each window of each stretch, whether a stretch of a smaller id has the same bytes.

    ids, lead (from first window to minimizer), windows: by stretch; text: the
    stretches' bytes on end, windows + MATCH - 1 each.
    """
    sizes = windows + MATCH - 1
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    words = bt.words_at(text)
    sig = stretch_hash(*(gram_hash(words, p) for p in (starts, starts + GRAM, starts + sizes - GRAM)), lead, windows)
    _, first, back = np.unique(sig, return_index=True, return_inverse=True)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, back, ids)
    # distinct stretches, each with its minimizer at a multiple of PERIOD
    d_sizes, d_windows, d_lead = sizes[first], windows[first], lead[first]
    room = int(d_sizes.max())
    # no suffix reaches the next stretch within a shift and `room` bytes
    slot = -(-(room + SPAN + 2 * PERIOD + 8) // PERIOD) * PERIOD
    at = np.arange(len(first)) * slot + (-d_lead) % PERIOD
    laid = np.zeros(len(first) * slot + 2 * PERIOD + 2 * room + 8, np.uint8)
    n_bytes = int(d_sizes.sum())
    inner = np.arange(n_bytes) - np.repeat(np.concatenate([[0], np.cumsum(d_sizes)[:-1]]), d_sizes)
    laid[np.repeat(at, d_sizes) + inner] = text[np.repeat(starts[first], d_sizes) + inner]
    owner = np.repeat(np.arange(len(first)), d_windows)
    before = np.concatenate([[0], np.cumsum(d_windows)])
    places = at[owner] + np.arange(before[-1]) - before[owner]
    hit = np.zeros(before[-1], bool)
    for own, agree in same_strings(laid, places, room):
        head = np.flatnonzero(~agree)
        low = np.minimum.reduceat(least[owner[own]], head)
        hit[own] = np.repeat(low, np.diff(np.append(head, len(own)))) < least[owner[own]]
    # back to all stretches: a later document's windows are hit, all of them
    total = int(windows.sum())
    mine = np.repeat(np.arange(len(ids)), windows)
    k = np.arange(total) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    return hit[before[back[mine]] + k] | (ids > least[back])[mine]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def dedup_substrings(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes).

    Each byte goes that a string of MATCH bytes covers which also starts in a
    document with a smaller doc_id; strings are judged on the input. Null texts
    are empty. Among rows with the same doc_id none is smaller; a null doc_id is
    larger than all others. Other columns are ignored; an empty table gives an
    empty result.
    """
    packed = sh.pack(docs, extra=packed_cuts)
    few, many = sh.bucket_count(packed, 0.35), sh.bucket_count(packed, 1.0)

    def ask_repeated(s: sh.Shard) -> Iterator[tuple[int, bytes]]:
        keys, both, _ = _minimizers(known_stretches(s))
        yield from sh.hash_question(keys, both, few)

    repeated = materialize(sh.answer(sh.ask(packed, ask_repeated), sh.repeated_answer), "repeated")

    def ask_same(s: sh.Shard, replies: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        x, ids = known_stretches(s), _ids(s)
        g = _groups(x, ids, _repeated(x, replies, few))
        one = g.first
        for b, own in sh.split_sorted(x.hash[one], many):
            k = one[own]
            windows = x.p1[k] - x.p0[k] + 1
            text = gather(s.data, x.p0[k], windows + MATCH - 1)
            parts = [ids[x.row[k]].astype("<i8").tobytes(), (x.at[k] - x.p0[k]).astype(np.uint8).tobytes(), windows.astype(np.uint8).tobytes(), text.tobytes()]
            yield b, len(k).to_bytes(4, "little") + sh.compress(b"".join(parts))

    def answer_same(_: int, asked: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        ids, lead, windows, text = [], [], [], []
        for _, p in asked:
            n, raw = int.from_bytes(p[:4], "little"), np.frombuffer(sh.decompress(p[4:]), np.uint8)
            ids.append(raw[: 8 * n].view("<i8"))
            lead.append(raw[8 * n : 9 * n].astype(np.int64))
            windows.append(raw[9 * n : 10 * n].astype(np.int64))
            text.append(raw[10 * n :])
        hits = bucket_hits(*(np.concatenate(x) for x in (ids, lead, windows, text)))
        at = 0
        for (shard, _), w in zip(asked, windows, strict=True):
            bits = hits[at : at + int(w.sum())]
            at += len(bits)
            yield shard, sh.compress(np.packbits(bits)) if bits.any() else b""

    same = sh.answer(sh.ask(packed, ask_same, repeated), answer_same)
    answers = repeated.unionByName(same.withColumn("bucket", (F.col("bucket") + sh.SECOND).cast("int")))

    def apply(s: sh.Shard, replies: dict[int, bytes]) -> pa.RecordBatch:
        x, ids = known_stretches(s), _ids(s)
        g = _groups(x, ids, _repeated(x, replies, few))
        windows = x.p1 - x.p0 + 1
        # bits by group, in the order they were asked
        of_group = windows[g.first]
        before = np.concatenate([[0], np.cumsum(of_group)])
        bits = np.zeros(before[-1], bool)
        for b, own in sh.split_sorted(x.hash[g.first], many):
            if b + sh.SECOND in replies:
                a, z = before[own.start], before[own.stop]
                bits[a:z] = np.unpackbits(np.frombuffer(sh.decompress(replies[b + sh.SECOND]), np.uint8), count=z - a).astype(bool)
        n = len(s.data)
        hit = np.zeros(n, bool)
        w, to, later = windows[g.stretch], before[g.of], g.later
        for a in range(0, len(w), 1 << 16):  # in parts, to bound memory
            z = slice(a, a + (1 << 16))
            mine = np.repeat(np.arange(len(w[z])), w[z])
            k = np.arange(len(mine)) - np.repeat(np.cumsum(w[z]) - w[z], w[z])
            hit[x.p0[g.stretch][z][mine] + k] = later[z][mine] | bits[to[z][mine] + k]
        c = np.zeros(n + 1, np.int32)
        np.cumsum(hit, out=c[1:])
        gone = c[1:] > np.concatenate([np.zeros(min(n, MATCH - 1), np.int32), c[: max(0, n - MATCH + 1)]])
        np.cumsum(gone, out=c[1:])
        n_removed = c[s.offsets[1:]] - c[s.offsets[:-1]]
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        heads = s.offsets[:-1][s.offsets[1:] > s.offsets[:-1]]
        edge[heads] = gone[heads]
        np.cumsum(edge, out=c[1:])
        n_spans = c[s.offsets[1:]] - c[s.offsets[:-1]]
        shas, kept = [], []
        for r in range(len(s.ids)):
            lo, hi = s.offsets[r], s.offsets[r + 1]
            own = s.data[lo:hi][~gone[lo:hi]] if n_removed[r] else s.data[lo:hi]
            shas.append(hashlib.sha256(own.tobytes()).hexdigest())
            if with_text:
                kept.append(own.tobytes())
        columns = [s.id_array(), pa.array(np.diff(s.offsets), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(shas, pa.string())]
        return pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_text, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_bytes"] * with_text)

    return sh.finish(packed, answers, apply, RESULT + ", kept_bytes binary" * with_text)


def op2_difference_cover(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
