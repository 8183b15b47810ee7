"""N-gram Jaccard join with count-vector R-trees.

A document's set is the hashes of its distinct word shingles. Two sets link at
Jaccard 3/4 or more. Equal sets are first made one. Hashes are dealt to groups,
more for larger sets, so that a group has a few; a set's point holds how many of
its hashes each group has. Points of unequal length are compared by folding the
longer one. Two sets share at most the sum over the groups of the smaller count, and two nodes of
an R-tree at most the sum of the smaller of their upper bounds: where that
falls short of what a link needs, the pair, or both subtrees, are left out.
Survivors are verified on the sets.

So that no tree has to hold all points, sets meet by shingle: sets that link
share one of the first size - ceil(3/4 size) + 1 of their hashes, in any order
that is the same for all. The order puts hashes of many documents last.

1. Shards ask which of their sets are equal to others', and report the hashes of a
   sample of their sets, whose counts over all shards tell frequent ones.
2. They ask which first hashes of distinct sets stand in two sets or more whose
   sizes, and places of the hash in the order, leave room for a link. The answer
   names the group of sets; of hashes with one group a set keeps the first.
3. Points of those sets go to the buckets of these first hashes. For each
   hash an R-tree over its sets finds the pairs that the bound allows; those
   within a part that is already connected are skipped, so that a bucket's
   edges are a forest and a large group isn't expanded into pairs.
4. Parts connected by these edges hold all links. The sets of a part meet
   once more and are verified in R-tree order, again skipping what is already
   linked. A part of more than CHUNK sets is split: each chunk is verified by
   itself and against one pivot; sets that are then not in the part's main
   component are verified against all its chunks, block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm import bytestext as bt
from lexweave.llm import shards as sh
from lexweave.llm.components import components
from lexweave.storage import materialize

N = 5
#: A set of `size` hashes has the power of two of groups that is size / PER_GROUP or just above, MOST_GROUPS at most.
PER_GROUP = 4
MOST_GROUPS = 4096
LEAF = 16
#: Sets of one verification group.
CHUNK = 2000
#: Frequent hashes that are put last in the order: by how many of every HOT_SAMPLE-th set have them, HOT_TIMES at least. Any order gives the same links.
HOT = 48_000
HOT_SAMPLE = 32
HOT_TIMES = 3
SUB_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).max


def allowed(overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether 100 * overlap >= 75 * (sizes - overlap), sizes being both sets' sizes added."""
    return 7 * overlap >= 3 * sizes


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, in order, on end, and n + 1 offsets. A row of fewer than n words has one shingle, without words none."""
    values, counts = [], []
    for lo, hi in bt.cuts(offsets, SUB_BYTES):
        own = offsets[lo : hi + 1] - offsets[lo]
        d = bt.LOWER[data[offsets[lo] : offsets[hi]]]
        ws, we, per = bt.word_bounds(d, own, bt.NONSPACE)
        h = bt.span_hash(d, ws, we)
        words = np.diff(per)
        row = np.repeat(np.arange(hi - lo), words)
        g = bt.chain_hash(h, n)
        inside = row[: len(g)] == row[n - 1 :] if len(g) else np.zeros(0, bool)
        g, at = g[inside], row[: len(g)][inside]
        short = np.flatnonzero((words > 0) & (words < n))
        if len(short):
            one = []
            for r in short:
                x = 0
                for v in h[per[r] : per[r + 1]].tolist():
                    x = (x * int(bt.BASE) + v) & 0xFFFFFFFFFFFFFFFF
                one.append(x ^ int(words[r]))
            g, at = np.concatenate([g, bt.mix(np.array(one, np.uint64))]), np.concatenate([at, short])
        o = np.argsort(g)
        o = o[np.argsort(at[o].astype(np.uint16 if hi - lo < 1 << 16 else np.int64), kind="stable")]
        g, at = g[o], at[o]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (at[1:] != at[:-1])
        values.append(g[new])
        counts.append(np.bincount(at[new], minlength=hi - lo))
    first = np.concatenate([[0], *counts]).cumsum()
    return (np.concatenate(values) if values else np.zeros(0, np.uint64)), first.astype(np.int64)


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    c = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


class Sets:
    """The distinct sets of a shard that aren't empty, in the order of their signatures."""

    def __init__(self, s: sh.Shard, n: int) -> None:
        self.values, self.first = shingle_sets(s.data, s.offsets, n)
        self.sizes = np.diff(self.first)
        ids = np.where(s.null_ids, NO_ID, s.ids)
        a, b = _sums(bt.mix(self.values), self.first), _sums(bt.mix(self.values ^ bt.BASE), self.first)
        rows = np.flatnonzero(self.sizes)
        order = rows[np.lexsort((rows, ids[rows], self.sizes[rows], b[rows], a[rows]))]
        x, y, z = a[order], b[order], self.sizes[order]
        new = np.ones(len(order), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])
        self.head = order[new]  # the row of the smallest id
        self.of = np.full(len(ids), -1, np.int64)  # the set of each row
        self.of[order] = np.cumsum(new) - 1
        self.sig = np.stack([a[self.head], b[self.head] ^ self.sizes[self.head].astype(np.uint64)], 1)
        self.ids = ids[self.head]
        self.nodes = s.rows()[self.head]

    def own(self, row: int) -> np.ndarray:
        return self.values[self.first[row] : self.first[row + 1]]


def ask_sets(s: sh.Shard, n: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    x = Sets(s, n)
    for b, own in sh.split_sorted(x.sig[:, 0], buckets):
        yield b, len(x.sig[own]).to_bytes(4, "little") + x.sig[own].tobytes() + x.ids[own].tobytes() + x.nodes[own].tobytes()
    # the hashes of every HOT_SAMPLE-th set, by the place of its first row
    heads = x.head[bt.mix(x.nodes.astype(np.uint64)) % np.uint64(HOT_SAMPLE) == 0]
    if len(heads):
        keys, times = np.unique(np.concatenate([x.own(r) for r in heads]), return_counts=True)
        spread = bt.mix(keys)
        order = np.argsort(spread)
        for b, own in sh.split_sorted(spread[order], buckets):
            yield b + sh.SECOND, sh.compress(np.concatenate([keys[order][own], times[order][own].astype(np.uint64)]))


def answer_sets(bucket: int, asked: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    if bucket >= sh.SECOND:
        halves = [np.frombuffer(sh.decompress(p), np.uint64).reshape(2, -1) for _, p in asked]
        keys, back = np.unique(np.concatenate([x[0] for x in halves]), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, back, np.concatenate([x[1] for x in halves]).astype(np.int64))
        # no more than HOT of one bucket can be among the HOT of all
        top = np.argsort(-times, kind="stable")[:HOT]
        top = top[times[top] >= HOT_TIMES]
        yield -1, keys[top].tobytes() + times[top].astype(np.uint64).tobytes()
        return
    parts = []
    for _, p in asked:
        n = int.from_bytes(p[:4], "little")
        sig = np.frombuffer(p, np.uint64, 2 * n, 4).reshape(n, 2)
        parts.append((sig[:, 0], sig[:, 1], np.frombuffer(p, np.int64, n, 4 + 16 * n), np.frombuffer(p, np.int64, n, 4 + 24 * n)))
    a, b, ids, nodes = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((nodes, ids, b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    head = order[new][np.cumsum(new) - 1]
    out = np.empty((len(order), 2), np.int64)
    out[order, 0], out[order, 1] = nodes[head], ids[head]
    at = 0
    for (shard, _), p in zip(asked, parts, strict=True):
        yield shard, out[at : at + len(p[0])].tobytes()
        at += len(p[0])


def frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The HOT most frequent hashes of the sampled sets and how many of these have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("reply").to_pylist():
                h, times = np.frombuffer(p, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(times)], ["h", "times"])

    rows = sets.where("shard = -1").select("reply").mapInArrow(run, "h long, times long")
    # HOT rows of two numbers at most
    rows = rows.orderBy(F.desc("times"), "h").limit(HOT).collect()
    return np.array([r["h"] for r in rows], np.int64).view(np.uint64), np.array([r["times"] for r in rows], np.int64)


def representatives(x: Sets, replies: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The node and the id that stand for each set of the shard."""
    out = np.zeros((len(x.head), 2), np.int64)
    for b, own in sh.split_sorted(x.sig[:, 0], buckets):
        out[own] = np.frombuffer(replies[b], np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def first_hashes(x: Sets, of: np.ndarray, hot: np.ndarray, hot_times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the rows `of`, the hashes that a linked set must share one of, each one's place in `of`, and how many of the set's hashes come before it."""
    size = x.sizes[of]
    take = size - (3 * size + 3) // 4 + 1
    k = np.repeat(np.arange(len(of)), size)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    h = x.values[x.first[of][k] + inner]
    if len(hot):
        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        times = np.where(hot[at] == h, hot_times[at], 0)
        if times.any():
            o = np.lexsort((h, times, k))
            h = h[o]
    keep = inner < np.repeat(take, size)
    # least hashes are small: spread them again, for buckets by leading bits
    return bt.mix(h[keep]), k[keep], inner[keep]


#: Sizes are sent as powers of STEP, and what of a set is left from a hash on in parts of PARTS; ANY: of several sets.
STEP = 1.05
PARTS = 240
ANY = 255
#: Sets of one shard that have a hash and are sent apart; more of them are sent as one of any room.
MOST_APART = 8
#: Sizes of sets that link differ by this many powers of STEP at most.
REACH = int(np.ceil(np.log(4 / 3) / np.log(STEP))) + 1


def room_codes(sizes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A byte for the size, rounded down, and one for the share of the set from this hash on, rounded up."""
    size = np.minimum(np.floor(np.log(sizes) / np.log(STEP)), ANY - 1).astype(np.uint8)
    return size, np.ceil(PARTS * (sizes - before) / sizes).astype(np.uint8)


def roomy(size_a: np.ndarray, room_a: np.ndarray, size_b: np.ndarray, room_b: np.ndarray) -> np.ndarray:
    """Whether two sets that first meet at this hash may link: what is left of either from it on bounds what they share.

    The first hash, in the common order, of all that two sets share bounds it so; a link passes at that hash.
    """
    wide = (size_a >= ANY - 1) | (size_b >= ANY - 1)
    low_a, low_b = STEP ** size_a.astype(float), STEP ** size_b.astype(float)
    left = np.minimum(low_a * STEP * room_a, low_b * STEP * room_b) / PARTS
    return wide | (7 * left * (1 + 1e-9) >= 3 * (low_a + low_b))


#: Bytes of a set's name in questions, and of a group's in answers.
NAME_BYTES = 8


def _bytes(x: np.ndarray, n: int) -> np.ndarray:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]


def _wide(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 8), np.uint8)
    out[:, : x.shape[1]] = x
    return out.view("<u8")[:, 0]


def ask_room(h: np.ndarray, sizes: np.ndarray, before: np.ndarray, nodes: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """By bucket: hashes in order, without the bits that the bucket tells, with the bytes of room_codes and the set's name; of many sets the sum of their names."""
    order, many = sent_rows(h)
    size, room = room_codes(sizes[order], before[order])
    size[many] = room[many] = ANY
    names = bt.mix(nodes.astype(np.uint64))
    by_hash = np.argsort(h, kind="stable")
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names[by_hash])])
    every = h[by_hash]
    name = np.where(many, sums[np.searchsorted(every, h[order], "right")] - sums[np.searchsorted(every, h[order])], names[order])
    drop = sh.spare_bits(buckets)
    for b, own in sh.split_sorted(h[order], buckets):
        yield b, np.concatenate([_bytes(h[order][own] >> drop, sh.HASH_BYTES), size[own, None], room[own, None], _bytes(name[own], NAME_BYTES)], axis=1).tobytes()


def sent_rows(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that are sent, in order of the hash, and which of them stand for many."""
    order = np.argsort(h, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else np.zeros(0, np.int64)
    length = np.diff(np.append(cut, len(h)))
    many = np.repeat(length > MOST_APART, length)
    head = np.zeros(len(h), bool)
    head[cut] = True
    keep = ~many | head
    return order[keep], many[keep]


def answers_for(h: np.ndarray, replies: dict[int, bytes], buckets: int, offset: int) -> np.ndarray:
    """The answer for each hash, in the order given: its group's name, 0 if it has no room for a link."""
    order, _ = sent_rows(h)
    sent = np.zeros(len(order), np.uint64)
    for b, own in sh.split_sorted(h[order], buckets):
        if b + offset in replies:
            n = own.stop - own.start
            raw = np.frombuffer(replies[b + offset], np.uint8)
            hit = np.unpackbits(raw[: -(-n // 8)], count=n).astype(bool)
            part = np.zeros(n, np.uint64)
            part[hit] = _wide(raw[-(-n // 8) :].reshape(-1, NAME_BYTES))
            sent[own] = part
    out = np.zeros(len(h), np.uint64)
    out[order] = sent
    # those that weren't sent have the answer of the one that stands for them
    _, many = sent_rows(h)
    if many.any():
        keys, at = h[order][many], order[many]
        i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        out = np.where(keys[i] == h, out[at[i]], out)
    return out


def meetings(k: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which of a set's first hashes (k: the set, in the common order) are kept: those with room, but of those with one group the first.

    All sets of a group have all its hashes, in one order, and the earlier hash
    has more room: so they keep the same one, and every pair still meets.
    """
    some = np.flatnonzero(group)
    pair = bt.mix(group[some] ^ bt.mix(k[some].astype(np.uint64)))
    return some[np.sort(np.unique(pair, return_index=True)[1])]


def answer_room(_: int, asked: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """A bit for each row, whether another row of its hash may link to it, and for those the name of all sets of the hash.

    Of the rows of a hash and size only the one with the most room matters, so
    that a row looks at the sizes within reach and not at all other rows.
    """
    width = sh.HASH_BYTES + 2 + NAME_BYTES
    rows = [np.frombuffer(p, np.uint8).reshape(-1, width) for _, p in asked]
    every = np.concatenate(rows)
    h, name = _wide(every[:, : sh.HASH_BYTES]), _wide(every[:, -NAME_BYTES:])
    codes = every[:, sh.HASH_BYTES : sh.HASH_BYTES + 2]
    hit = codes[:, 1] == ANY  # several sets of one shard
    order = np.argsort(h, kind="stable")
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    length = np.diff(np.append(np.flatnonzero(new), len(h)))
    together = np.zeros(len(h), np.uint64)
    if len(h):
        together[order] = np.repeat(bt.mix(np.add.reduceat(name[order], np.flatnonzero(new))) | np.uint64(1), length)
    own = order[np.repeat(length > 1, length)]
    if len(own):
        group = np.repeat(np.arange((length > 1).sum()), length[length > 1])
        size, room = codes[own, 0].astype(np.int64), codes[own, 1].astype(np.int64)
        free = np.zeros(group[-1] + 1, bool)
        free[group[size >= ANY - 1]] = True  # any room, or sizes beyond the code
        # the most room of each (hash, size), and the second most
        o = np.lexsort((-room, size, group))
        cell = group[o] * 256 + size[o]
        top = np.concatenate([[True], cell[1:] != cell[:-1]])
        cells, at = cell[top], np.flatnonzero(top)
        best, holder = room[o][at], o[at]
        second = np.where(np.diff(np.append(at, len(o))) > 1, room[o][np.minimum(at + 1, len(o) - 1)], -1)
        ok = free[group]
        for d in range(-REACH, REACH + 1):
            other = size + d
            want = group * 256 + other
            i = np.minimum(np.searchsorted(cells, want), len(cells) - 1)
            there = (cells[i] == want) & (other >= 0) & (other < ANY - 1)
            most = best[i]
            if d == 0:
                mine = holder[i] == np.arange(len(own))
                most = np.where(mine, second[i], most)
            there &= most >= 0
            ok |= there & roomy(size, room, np.maximum(other, 0), most)
        hit[own] |= ok
    at = 0
    for (shard, _), r in zip(asked, rows, strict=True):
        bits = hit[at : at + len(r)]
        yield shard, np.packbits(bits).tobytes() + _bytes(together[at : at + len(r)][bits], NAME_BYTES).tobytes() if bits.any() else b""
        at += len(r)


def group_bits(sizes: np.ndarray) -> np.ndarray:
    """Log 2 of the number of groups of sets of these sizes."""
    return np.ceil(np.log2(np.clip(sizes / PER_GROUP, 8, MOST_GROUPS))).astype(np.int64)


def count_vectors(values: np.ndarray, first: np.ndarray, groups: int) -> np.ndarray:
    """(sets, groups) counts of sets given on end."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    return np.bincount(row * groups + (values % np.uint64(groups)).astype(np.int64), minlength=n * groups).reshape(n, groups).astype(np.int32)


class Points:
    """Count vectors of sets by number of groups; fold: as if there were half as many."""

    def __init__(self, sizes: np.ndarray, flat: np.ndarray) -> None:
        """flat: all vectors on end."""
        self.sizes, self.bits = sizes, group_bits(sizes)
        first = np.concatenate([[0], np.cumsum(np.int64(1) << self.bits)])
        self.at = np.zeros(len(sizes), np.int64)
        self.by: dict[int, np.ndarray] = {}
        for b in np.unique(self.bits).tolist():
            own = np.flatnonzero(self.bits == b)
            self.at[own] = np.arange(len(own))
            self.by[b] = flat[first[own][:, None] + np.arange(1 << b)]
        self.folded = {b: x[:, : x.shape[1] // 2] + x[:, x.shape[1] // 2 :] for b, x in self.by.items()}

    def of(self, sets: np.ndarray, bits: int) -> np.ndarray:
        """Vectors of sets that have this number of groups, or twice as many."""
        own = self.bits[sets] == bits
        out = np.empty((len(sets), 1 << bits), np.int32)
        if own.any():
            out[own] = self.by[bits][self.at[sets[own]]]
        if not own.all():
            out[~own] = self.folded[bits + 1][self.at[sets[~own]]]
        return out

    def linkable(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the bound allows each pair. Sizes that differ by more than a third have no link."""
        low = np.minimum(self.bits[p], self.bits[q])
        ok = np.zeros(len(p), bool)
        near = (4 * self.sizes[p] >= 3 * self.sizes[q]) & (4 * self.sizes[q] >= 3 * self.sizes[p])
        for b in np.unique(low[near]).tolist():
            own = np.flatnonzero(near & (low == b))
            step = max(1, (1 << 22) >> b)
            for lo in range(0, len(own), step):
                i = own[lo : lo + step]
                bound = np.minimum(self.of(p[i], b), self.of(q[i], b)).sum(1)
                ok[i] = allowed(bound, self.sizes[p[i]] + self.sizes[q[i]])
        return ok


class CountTree:
    """R-tree over count vectors, packed in the order of size and a few coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.points, self.sizes = points, sizes
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        n = len(self.order)
        low, high = sizes[self.order], points[self.order]
        self.least, self.upper, self.start = [], [], []
        width = 1
        while True:
            width *= LEAF
            cut = np.arange(0, n, width)
            step = np.arange(0, len(low), LEAF)
            low, high = np.minimum.reduceat(low, step), np.maximum.reduceat(high, step, axis=0)
            self.least.append(low)
            self.upper.append(high)
            self.start.append(np.append(cut, n))
            if len(cut) == 1:
                break


class Union:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
        return i != j


def tree_join(points: np.ndarray, sizes: np.ndarray, names: list[int], union: Union, test: Callable[[int, int], bool] | None = None, skip: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs that the bound allows and test(i, j) accepts and that join two parts of union; the union gets them.

    names: the points' numbers in union. skip: pairs of two of these points are left out.
    """
    tree, out = CountTree(points, sizes), []
    top = len(tree.start) - 1

    def one(level: int, k: int) -> int | None:
        """The root of all members if they are connected."""
        members = tree.order[tree.start[level][k] : tree.start[level][k + 1]]
        root = union.find(names[members[0]])
        return root if all(union.find(names[m]) == root for m in members[1:].tolist()) else None

    def pairs(a: np.ndarray, b: np.ndarray, same: bool) -> None:
        bound = np.minimum(points[a][:, None, :], points[b][None, :, :]).sum(2)
        ok = allowed(bound, sizes[a][:, None] + sizes[b][None, :])
        if skip is not None:
            ok &= ~(skip[a][:, None] & skip[b][None, :])
        for i, j in np.argwhere(np.triu(ok, 1) if same else ok).tolist():
            p, q = int(a[i]), int(b[j])
            if union.find(names[p]) != union.find(names[q]) and (test is None or test(p, q)):
                union.join(names[p], names[q])
                out.append((p, q))

    def cross(level: int, i: int, j: int) -> None:
        bound = np.minimum(tree.upper[level][i], tree.upper[level][j]).sum()
        if not allowed(bound, tree.least[level][i] + tree.least[level][j]):
            return
        r = one(level, i)
        if r is not None and r == one(level, j):
            return
        if level == 0:
            cut = tree.start[0]
            pairs(tree.order[cut[i] : cut[i + 1]], tree.order[cut[j] : cut[j + 1]], False)
            return
        below = len(tree.start[level - 1]) - 1
        for x in range(i * LEAF, min((i + 1) * LEAF, below)):
            for y in range(j * LEAF, min((j + 1) * LEAF, below)):
                cross(level - 1, x, y)

    def within(level: int, k: int) -> None:
        if level == 0:
            own = tree.order[tree.start[0][k] : tree.start[0][k + 1]]
            pairs(own, own, True)
            return
        below = len(tree.start[level - 1]) - 1
        kids = range(k * LEAF, min((k + 1) * LEAF, below))
        for x in kids:
            within(level - 1, x)
        for x in kids:
            for y in kids:
                if x < y:
                    cross(level - 1, x, y)

    within(top, 0)
    return out


def ask_points(x: Sets, rows: np.ndarray, h: np.ndarray, k: np.ndarray, nodes: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Each bucket gets hashes, and the nodes, sizes and points of their sets."""
    order = np.argsort(h)
    h, k = h[order], k[order]
    points = {}
    for b, own in sh.split_sorted(h, buckets):
        sets, at = np.unique(k[own], return_inverse=True)
        size = x.sizes[rows[sets]]
        for i in sets.tolist():
            if i not in points:
                values = x.own(rows[i])
                groups = 1 << int(group_bits(np.array([len(values)]))[0])
                points[i] = np.bincount((values & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.int32)
        flat = np.concatenate([points[i] for i in sets.tolist()])
        wide = 1 if flat.max() < 1 << 8 else 4
        raw = len(at).to_bytes(4, "little") + len(sets).to_bytes(4, "little") + bytes([wide])
        body = h[own].tobytes() + at.astype("<i4").tobytes() + nodes[rows[sets]].astype("<i8").tobytes() + size.astype("<i4").tobytes() + flat.astype(f"<u{wide}").tobytes()
        yield b, raw + sh.compress(body)


def candidate_edges(asked: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (nodes) of a bucket's hashes."""
    hs, ks, nodes, sizes, flat, base = [], [], [], [], [], 0
    for p in asked:
        m, n, wide = int.from_bytes(p[:4], "little"), int.from_bytes(p[4:8], "little"), p[8]
        raw = sh.decompress(p[9:])
        hs.append(np.frombuffer(raw, "<u8", m))
        ks.append(np.frombuffer(raw, "<i4", m, 8 * m).astype(np.int64) + base)
        nodes.append(np.frombuffer(raw, "<i8", n, 12 * m))
        sizes.append(np.frombuffer(raw, "<i4", n, 12 * m + 8 * n).astype(np.int64))
        flat.append(np.frombuffer(raw, f"<u{wide}", -1, 12 * m + 12 * n).astype(np.int32))
        base += n
    h, k = np.concatenate(hs), np.concatenate(ks)
    nodes, sizes = np.concatenate(nodes), np.concatenate(sizes)
    points = Points(sizes, np.concatenate(flat))
    # by size within a hash, as a tree of one leaf has it
    order = np.lexsort((sizes[k], h))
    h, k = h[order], k[order]
    cut = np.append(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])), len(h))
    length = np.diff(cut)
    p, q = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = np.flatnonzero((length > 1) & (length <= LEAF))
    for gap in range(1, LEAF):
        own = small[length[small] > gap]
        if not len(own):
            break
        # pairs of members `gap` apart
        many = length[own] - gap
        i = np.repeat(cut[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        near = 4 * sizes[k[i]] >= 3 * sizes[k[i + gap]]
        p.append(k[i][near])
        q.append(k[i + gap][near])
    p, q = np.concatenate(p), np.concatenate(q)
    key = np.unique(np.minimum(p, q) * np.int64(max(base, 1)) + np.maximum(p, q))
    p, q = key // max(base, 1), key % max(base, 1)
    ok = points.linkable(p, q)
    union, a, b = Union(base), [], []
    for u, v in zip(p[ok].tolist(), q[ok].tolist(), strict=True):
        if union.join(u, v):
            a.append(u)
            b.append(v)
    for g in np.flatnonzero(length > LEAF):
        own = np.unique(k[cut[g] : cut[g + 1]])
        root = union.find(int(own[0]))
        if all(union.find(x) == root for x in own[1:].tolist()):
            continue
        bits = points.bits[own]
        for low in np.unique(bits).tolist():
            # sets of this number of groups among themselves, and with those of twice as many, folded
            two = own[(bits == low) | (bits == low + 1)]
            for i, j in tree_join(points.of(two, low), sizes[two], two.tolist(), union, skip=points.bits[two] == low + 1):
                a.append(int(two[i]))
                b.append(int(two[j]))
    return nodes[np.array(a, np.int64)], nodes[np.array(b, np.int64)]


def verified_links(part: np.ndarray, side: np.ndarray, nodes: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links within each part, as a forest. side: pairs whose sides are both 1 are left out."""
    out = []
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0]))
    for own in np.split(order, cut[1:]):
        # a set can come twice, on both sides
        own = own[np.unique(nodes[own] * 2 + side[own], return_index=True)[1]]
        if len(own) < 2:
            continue
        mine = [sets[i] for i in own]
        sizes = np.array([len(s) for s in mine])
        groups = 1 << int(group_bits(sizes).max())
        points = count_vectors(np.concatenate(mine), np.concatenate([[0], np.cumsum(sizes)]), groups)

        def test(i: int, j: int, mine=mine) -> bool:
            a, b = (mine[i], mine[j]) if len(mine[i]) <= len(mine[j]) else (mine[j], mine[i])
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            return bool(allowed(int((b[at] == a).sum()), len(a) + len(b)))

        both = side[own] == 1
        edges = tree_join(points, sizes, list(range(len(own))), Union(len(own)), test, both if both.any() else None)
        out += [(int(nodes[own[i]]), int(nodes[own[j]])) for i, j in edges]
    return out


def _sets_of(packed: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """(part, side, node, hashes, group) for members (node, part, side, group), by way of their shards."""
    listed = members.groupBy((F.shiftright("node", sh.ROW_BITS)).alias("shard")).agg(F.collect_list(F.struct("node", "part", "side", "group")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                s = next(sh.unpack(one))
                values, first = shingle_sets(s.data, s.offsets, n)
                m = one.column("m")[0].as_py()
                for lo in range(0, len(m), 2000):
                    own = m[lo : lo + 2000]
                    at = [x["node"] & (sh.MOST_ROWS * 2 - 1) for x in own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[c] for x in own], pa.int64()) for c in ("part", "side", "node", "group")] + [pa.array([values[first[r] : first[r + 1]].tobytes() for r in at], pa.binary())],
                        ["part", "side", "node", "group", "hashes"],
                    )

    return packed.join(listed.hint("shuffle_hash"), "shard").mapInArrow(run, "part long, side long, node long, group long, hashes binary")


def _verify(packed: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """Links (a, b) within each (part, group)."""

    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        columns = [table.column(c).to_numpy() for c in ("part", "side", "node")]
        links = verified_links(*columns, sets)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return _sets_of(packed, members, n).groupBy("group").applyInArrow(run, "a long, b long")


def part_links(packed: DataFrame, parts: DataFrame, n: int, chunk: int, groups: int) -> DataFrame:
    """All links, as a forest, within parts (node, part)."""
    size = parts.groupBy("part").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("p"))
    sized = materialize(parts.join(size, "part").select("node", "part", "size", F.col("p.node").alias("pivot")), "parts")
    chunks = F.ceil(F.col("size") / chunk)
    number = F.pmod(F.xxhash64("node", F.lit("chunk")), chunks)
    # small parts share a group; each chunk of a large one is a group
    group = lambda *x: F.when(F.col("size") <= chunk, F.pmod(F.xxhash64("part"), F.lit(groups))).otherwise(F.xxhash64("part", *x)).cast("long")
    large = sized.where(F.col("size") > chunk)
    pivots = large.select("part", "size", F.col("pivot").alias("node")).distinct().withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), (chunks - 1).cast("long"))))
    first = sized.select("node", "part", F.lit(0).cast("long").alias("side"), group(number).alias("group")).unionByName(pivots.select("node", "part", F.lit(0).cast("long").alias("side"), group(F.col("_c")).alias("group")))
    links = materialize(_verify(packed, first, n), "links")
    if large.limit(1).count() == 0:
        return links
    # sets of large parts that aren't in the part's main component, against all its chunks
    own = large.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = own.groupBy("part", "root").agg(F.count("*").alias("n"))
    main = by_root.groupBy("part").agg(F.max(F.struct("n", F.col("root").alias("main"))).alias("x")).select("part", F.col("x.main").alias("main"))
    rest = materialize(own.join(main, "part").where("root <> main").select("node", "part", "size"), "rest")
    if rest.limit(1).count() == 0:
        return links
    blocks = rest.groupBy("part").agg(F.ceil(F.count("*") / chunk).cast("long").alias("blocks"))
    rest = rest.join(blocks, "part").withColumn("_b", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))).withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), (chunks - 1).cast("long"))))
    whole = large.join(blocks, "part").withColumn("_c", number).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    second = whole.select("node", "part", F.lit(1).cast("long").alias("side"), group("_c", "_b").alias("group")).unionByName(rest.select("node", "part", F.lit(0).cast("long").alias("side"), group("_c", "_b").alias("group")))
    return links.unionByName(materialize(_verify(packed, second, n), "links"))


RESULT = "doc_id long, n_shingles long, component_id long"


def join_components(docs: DataFrame, n: int = N, chunk: int = CHUNK) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id.

    component_id is the smallest doc_id reachable by links. A text without
    words (null, empty, blank) has no shingles and only itself. Rows with one
    doc_id are joined by their texts; a null doc_id is larger than all others,
    and a component of null ids only has a null component_id. Other columns
    are ignored; an empty table gives an empty result.
    """
    rows, found = linked_rows(sh.pack(docs), n, chunk)
    ids = rows.where("node >= 0").groupBy("node").agg(F.min("low").alias("low"))
    best = found.join(ids, "node").groupBy("root").agg(F.min("low").alias("best"))
    best = found.join(best, "root").select("node", "best")
    # rows of one node are copies, up to a third of all: each shard asks once for each of its nodes
    shard = F.shiftright("row", sh.ROW_BITS).alias("shard")
    own = rows.where("node >= 0").select(shard, "node").distinct().join(best, "node")
    low = F.coalesce("best", "low")
    return rows.select("*", shard).join(own, ["shard", "node"], "left").select("doc_id", "n_shingles", F.when(low != NO_ID, low).alias("component_id"))


def linked_rows(packed: DataFrame, n: int = N, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Two written tables: (row, doc_id, n_shingles, node, low) of all rows, and (node, root) of all linked nodes.

    row is the packed row's number, node the row that stands for all of its
    set, -1 without shingles, and low the smallest id of that set.
    """
    few, some, many = sh.bucket_count(packed, 0.02), sh.bucket_count(packed, 0.4), sh.bucket_count(packed, 0.4)
    sets = materialize(sh.answer(sh.ask(packed, lambda s: ask_sets(s, n, few)), answer_sets), "sets")
    hot_hashes, times = frequent(sets)
    order = np.argsort(hot_hashes)
    shared = packed.sparkSession.sparkContext.broadcast((hot_hashes[order], times[order]))
    sets = sets.where("shard >= 0")

    def firsts(s: sh.Shard, replies: dict[int, bytes]) -> tuple:
        x = Sets(s, n)
        nodes, _ = representatives(x, replies, few)
        rows = x.head[nodes == x.nodes]
        return x, rows, *first_hashes(x, rows, *shared.value)

    def ask_repeated(s: sh.Shard, replies: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        x, rows, h, k, before = firsts(s, replies)
        yield from ask_room(h, x.sizes[rows[k]], before, s.rows()[rows[k]], some)

    repeated = materialize(sh.answer(sh.ask(packed, ask_repeated, sets), answer_room), "repeated")
    both = sets.unionByName(repeated.withColumn("bucket", (F.col("bucket") + sh.SECOND).cast("int")))

    def ask_pairs(s: sh.Shard, replies: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        x, rows, h, k, _ = firsts(s, replies)
        kept = meetings(k, answers_for(h, replies, some, sh.SECOND))
        yield from ask_points(x, rows, h[kept], k[kept], s.rows(), many)

    def edges(table: pa.Table) -> pa.Table:
        a, b = candidate_edges(table.column("payload").to_pylist())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    candidates = sh.ask(packed, ask_pairs, both).groupBy("bucket").applyInArrow(edges, "a long, b long")
    parts = components(candidates).select("node", F.col("root").alias("part"))
    links = part_links(packed, materialize(parts, "nodes"), n, chunk, many)

    def pairs(s: sh.Shard, replies: dict[int, bytes]) -> pa.RecordBatch:
        x = Sets(s, n)
        nodes, ids = representatives(x, replies, few)
        node, low = np.full(len(s.ids), -1, np.int64), np.where(s.null_ids, NO_ID, s.ids)
        has = x.of >= 0
        node[has], low[has] = nodes[x.of[has]], ids[x.of[has]]
        return pa.RecordBatch.from_arrays([pa.array(s.rows()), s.id_array(), *(pa.array(c, pa.int64()) for c in (x.sizes, node, low))], ["row", "doc_id", "n_shingles", "node", "low"])

    rows = materialize(sh.finish(packed, sets, pairs, "row long, doc_id long, n_shingles long, node long, low long"), "rows")
    return rows, materialize(components(links), "found")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each group of linked documents the row of the smallest doc_id; of several such rows, or of null ids only, one.

    Documents without words have no links and stay. Decisions go to the packed
    documents, so that texts and other columns aren't shuffled.
    """
    packed = sh.pack(docs, whole=True)
    rows, found = linked_rows(packed)
    first = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "row")
    by_node = rows.where("node >= 0").groupBy("node").agg(F.min(first).alias("first"))
    best = by_node.join(found, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    kept = best.select("first.row").unionByName(rows.where("node < 0").select("row"))
    return sh.kept_rows(packed, kept, docs.schema)


def op6_count_vector_join(spark, sf_dir: str) -> DataFrame:
    return join_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), s AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, k, k + 4), ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 3))) AS k FROM d WHERE len(w) > 0)
), n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r
), o AS (
  SELECT a.r AS x, b.r AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL
), e AS (
  SELECT x, y FROM o JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * o >= 75 * (a.n + b.n - o)
), reach AS (
  SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x
), low AS (
  SELECT x AS r, min(doc_id) AS low FROM reach JOIN d ON d.r = y GROUP BY x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN low USING (r)
"""
