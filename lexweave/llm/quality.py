"""Quality classifier: gated attention over passages (multiple-instance learning).

A document is a bag of passages of about PASSAGE_BYTES, cut at a space; the
whole text is used. A passage is encoded by shares of byte classes, word and
line shape, repetition and hashed letter pairs. Each passage is embedded,
h = tanh(W x + b); its attention weight is softmax(w . (tanh(V h) * sigm(U h)))
over the document's passages; the document is scored by a logistic layer on
the weighted sum of h. Only the document's label is known in training, which
runs on the driver over at most TRAIN_DOCS labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lexweave.llm import bytestext as bt

PASSAGE_BYTES = 512
#: Labelled documents that training takes at most, the first in hash order.
TRAIN_DOCS = 3000
PAIRS = 32
BLOCK_BYTES = 4 << 20

_SETS = [
    np.array([65 <= c <= 90 for c in range(256)]),  # upper case
    np.array([97 <= c <= 122 for c in range(256)]),  # lower case
    np.array([48 <= c <= 57 for c in range(256)]),  # digits
    np.array([c >= 128 for c in range(256)]),  # not ASCII
    np.array([c in b".,;:'\"-()" for c in range(256)]),  # usual punctuation
    np.array([c in b"!?" for c in range(256)]),  # raised voice
    np.array([c in b"#*$%&<>|@~^_=+\\/{}[]`" for c in range(256)]),  # symbols
    np.array([c == 10 for c in range(256)]),  # line feeds
    np.array([c in b" \t" for c in range(256)]),
]
DIM = len(_SETS) + 6 + PAIRS


def passages(data: np.ndarray, offsets: np.ndarray, size: int = PASSAGE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of all passages, and the number of passages before each row. An empty text is one empty passage."""
    length = np.diff(offsets)
    count = np.maximum(1, -(-length // size))
    first = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(length)), count)
    k = np.arange(first[-1]) - first[row]
    starts = offsets[row] + (length[row] * k) // count[row]
    # move each inner cut to the next space, if one is near
    if len(data):
        space = np.flatnonzero(~bt.NONSPACE[data])
        space = np.append(space, len(data))
        near = space[np.searchsorted(space, starts)]
        move = (k > 0) & (near < starts + size // 4) & (near < offsets[row + 1])
        starts = np.where(move, near, starts)
    ends = np.append(starts[1:], offsets[-1])
    ends[first[1:] - 1] = offsets[1:]
    return starts, ends, first


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (count, DIM), and the number of passages before each row."""
    starts, ends, first = passages(data, offsets)
    n = len(starts)
    size = ends - starts
    each = np.repeat(np.arange(n), size)
    x = np.zeros((n, DIM), np.float32)
    per = 1.0 / np.maximum(size, 1)
    bounds = np.append(starts, offsets[-1])

    def count(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return c[ends] - c[starts]

    for k, s in enumerate(_SETS):
        x[:, k] = count(s[data]) * per
    k = len(_SETS)
    ws, we, per_row = bt.word_bounds(data, offsets, bt.NONSPACE)
    lo, hi = np.searchsorted(ws, bounds[:-1]), np.searchsorted(ws, ends)
    words = np.maximum(hi - lo, 0)
    per_word = 1.0 / np.maximum(words, 1)
    sums = np.concatenate([[0], np.cumsum(we - ws)])
    x[:, k] = (sums[hi] - sums[lo]) * per_word / 10
    h = bt.span_hash(bt.LOWER[data], ws, we)
    own = np.repeat(np.arange(n), words)
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(words)[:-1]]), words) + np.arange(words.sum())
    key = bt.mix(h[at] ^ (own.astype(np.uint64) * bt.BASE))
    _, back = np.unique(key, return_index=True)
    x[:, k + 1] = np.bincount(own[back], minlength=n) * per_word  # distinct words
    same = np.concatenate([[False], h[1:] == h[:-1]]) if len(h) else np.zeros(0, bool)
    same[per_row[:-1][per_row[:-1] < len(h)]] = False  # a text's first word has none before it
    c = np.concatenate([[0], np.cumsum(same)])
    x[:, k + 2] = (c[hi] - c[lo]) * per_word  # words equal to the one before
    x[:, k + 3] = np.minimum(words, 100) / 100
    x[:, k + 4] = np.log1p(size) / 7
    letter = bt.ALNUM[data[we - 1]] if len(we) else np.zeros(0, bool)
    c = np.concatenate([[0], np.cumsum(~letter)])
    x[:, k + 5] = (c[hi] - c[lo]) * per_word  # words that end in a mark
    if len(data):
        low = bt.LOWER[data].astype(np.uint32)
        pair = ((low[:-1] * 31 + low[1:]) * np.uint32(2654435761) >> 16) % PAIRS
        inside = np.ones(len(data), bool)
        inside[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False  # a text's last byte has none after it
        inside = inside[:-1]
        grid = np.bincount(each[:-1][inside] * PAIRS + pair[inside].astype(np.int64), minlength=n * PAIRS)
        x[:, k + 6 :] = grid.reshape(n, PAIRS) * per[:, None] * 4
    return x, first


class Model:
    """Parameters of the embedding, the gated attention and the output layer."""

    NAMES = ("W", "b", "V", "U", "a", "c", "d")

    def __init__(self, dim: int, hidden: int = 24, gate: int = 12, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(dim, np.float32), np.ones(dim, np.float32)
        self.W, self.b = r.normal(0, dim**-0.5, (dim, hidden)), np.zeros(hidden)
        self.V, self.U = r.normal(0, hidden**-0.5, (hidden, gate)), r.normal(0, hidden**-0.5, (hidden, gate))
        self.a, self.c, self.d = r.normal(0, gate**-0.5, gate), r.normal(0, hidden**-0.5, hidden), np.zeros(1)

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        """x: passages, first: passages before each document, n + 1. Gives the document's probability first."""
        x = (x - self.mean) / self.scale
        count = np.diff(first)
        h = np.tanh(x @ self.W + self.b)
        t, g = np.tanh(h @ self.V), 1 / (1 + np.exp(-(h @ self.U)))
        e = (t * g) @ self.a
        top = np.repeat(np.maximum.reduceat(e, first[:-1]), count)
        w = np.exp(e - top)
        w = w / np.repeat(np.add.reduceat(w, first[:-1]), count)
        z = np.add.reduceat(h * w[:, None], first[:-1], axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ self.c + self.d, -30, 30)))
        return p, x, h, t, g, w, z

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, x, h, t, g, w, z = self.forward(x, first)
        count, n = np.diff(first), len(y)
        s = (p - y) / n
        dz = np.repeat(s[:, None] * self.c, count, axis=0)
        dw = (dz * h).sum(1)
        de = w * (dw - np.repeat(np.add.reduceat(dw * w, first[:-1]), count))
        dt, dg = de[:, None] * self.a * g * (1 - t * t), de[:, None] * self.a * t * g * (1 - g)
        dh = dz * w[:, None] + dt @ self.V.T + dg @ self.U.T
        dpre = dh * (1 - h * h)
        loss = -np.mean(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))
        return loss, {"W": x.T @ dpre, "b": dpre.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": ((t * g) * de[:, None]).sum(0), "c": z.T @ s, "d": np.array([s.sum()])}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 60, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 11) -> Model:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-3
        r, moments, step = np.random.default_rng(seed), {k: [0.0, 0.0] for k in self.NAMES}, 0
        for epoch in range(epochs):
            order = r.permutation(len(bags))
            for lo in range(0, len(order), batch):
                own = order[lo : lo + batch]
                first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])])
                _, grads = self.gradients(np.concatenate([bags[i] for i in own]), first, y[own])
                step += 1
                pace = rate * (1 - epoch / epochs) + rate / 50
                for k in self.NAMES:
                    grad = grads[k] + decay * getattr(self, k)
                    m = moments[k]
                    m[0], m[1] = 0.9 * m[0] + 0.1 * grad, 0.999 * m[1] + 0.001 * grad * grad
                    setattr(self, k, getattr(self, k) - pace * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8))
        return self


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, offsets = bt.utf8(batch.column("text"))
    for lo, hi in bt.cuts(offsets, BLOCK_BYTES):
        yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """Fit on the first `most` labelled documents outside the held-out fold, in hash order of doc_id.

    A document with several labels takes the smallest, a doc_id of several rows
    the text of the least hash; null labels and null ids are left out. Whole
    texts are used. With labels of one kind every score is near that label, with
    none it is 0.5.
    """
    own = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id")
        .limit(most)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in _blocks(whole):
                x, first = encode(data, offsets)
                bags = [x[a:z].astype("<f4").tobytes() for a, z in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(bags, pa.binary())], ["doc_id", "quality", "bag"])

    # own has at most `most` rows of two numbers
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(own.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))), "doc_id")
    # one row for each of the `most` ids
    picked = picked.groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("t"))).alias("text"))
    rows = sorted(picked.mapInArrow(run, "doc_id long, quality int, bag binary").collect(), key=lambda r: r["doc_id"])
    model = Model(DIM)
    y = np.array([r["quality"] for r in rows], float)
    if len(rows) and 0 < y.sum() < len(y):
        model.fit([np.frombuffer(r["bag"], "<f4").reshape(-1, DIM) for r in rows], y)
    else:
        model.c[:] = 0
        model.d[:] = 0.0 if not len(rows) else 4.0 if y.all() else -4.0
    return model


def score_expr(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """docs with a column of scores, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in _blocks(whole):
                x, first = encode(data, offsets)
                p = shared.value.forward(x, first)[0]
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(p, pa.float64())], [f.name for f in kept] + [out])

    return docs.select(*[f.name for f in kept]).mapInArrow(run, StructType([*kept, StructField(out, DoubleType())]))


THRESHOLD = 0.3


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted.

    Null and empty texts are one empty passage and get its score. Only the
    text enters the score. A null id is held out, as the empty text's checksum
    0 is divisible by 5. Other columns are ignored.
    """
    rows = score_expr(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels))
    return rows.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose predicted label is 1, with all their columns."""
    score = next(x for k in range(len(docs.columns) + 1) if (x := f"_score{k}") not in docs.columns)
    return score_expr(docs, train(docs, labels), score).where(F.col(score) >= THRESHOLD).drop(score)


def op7_attention_mil(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
