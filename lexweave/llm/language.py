"""Language identification by nearest centroid.

A text's vector counts its 1- to 3-byte grams over lower-cased bytes, words
bounded by single spaces and marks and digits left out, hashed to DIM places, weighted by log(1 + count) times inverse
document frequency and scaled to length 1. Each language has up to CENTROIDS
centroids from spherical k-means over a bounded sample of its documents. The
language of the centroid with the largest cosine wins. A text whose distance
from it exceeds what all but a share REJECT of the language's own sample have
is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm import bytestext as bt
from lexweave.storage import materialize

DIM = 2048
CENTROIDS = 3
#: Documents of each language that training takes at most: one for each of so many hash slots.
TRAIN_DOCS = 1000
REJECT = 0.001
#: Of sampled ids (about 40 bytes each).
BROADCAST_ROWS = 200_000
BLOCK_BYTES = 2 << 20
UNKNOWN = "und"

#: Letters and bytes above ASCII stay, lower-cased; all else is a space.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_LETTER = regex.compile(r"\p{L}")


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, DIM) counts of hashed grams."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    b = _FOLD[data]
    # runs of spaces become one
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 0x20) | (b[:-1] != 0x20) | (row[1:] != row[:-1])
    b, row = b[keep].astype(np.uint32), row[keep]
    out = np.zeros(n * DIM, np.int64)
    h = np.zeros(len(b), np.uint32)
    for k in range(3):
        m = len(b) - k
        if m <= 0:
            break
        h = h[:m] * np.uint32(257) + b[k:] + np.uint32(1)
        own = row[:m] == row[k:]
        place = ((h * np.uint32(2654435761)) >> np.uint32(16)) % DIM
        out += np.bincount(row[:m][own] * DIM + place[own], minlength=n * DIM)
    return out.reshape(n, DIM)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


@dataclass
class Centroids:
    idf: np.ndarray
    names: list[str]  # by centroid
    points: np.ndarray
    far: np.ndarray  # by centroid: the largest distance that isn't rejected

    @classmethod
    def of(cls, idf: np.ndarray, by_lang: dict[str, tuple[np.ndarray, np.ndarray]]) -> Centroids:
        """by_lang: what `cluster` gives for each language."""
        names = [lang for lang in sorted(by_lang) for _ in by_lang[lang][1]]
        return cls(idf, names, np.concatenate([by_lang[x][0] for x in sorted(by_lang)]), np.concatenate([by_lang[x][1] for x in sorted(by_lang)]))

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row and the cosine."""
        cos = unit(np.log1p(counts) * self.idf) @ self.points.T
        best = np.argmax(cos, axis=1)
        return best, np.clip(cos[np.arange(len(best)), best], 0, 1)


def inverse_frequency(n: int, having: np.ndarray) -> np.ndarray:
    """Weights of grams that `having` of n sampled documents have."""
    return np.log((1 + n) / (1 + having)) + 0.1


def cluster(counts: np.ndarray, idf: np.ndarray, k: int = CENTROIDS, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of one language's documents by spherical k-means, and the largest distance from each that isn't rejected."""
    own = unit(np.log1p(counts) * idf)
    # the first is the mean's nearest, each further one the farthest from those before
    c = [own[np.argmax(own @ unit(own.mean(0)))]]
    while len(c) < min(k, len(own)):
        c.append(own[np.argmin(np.max(own @ np.array(c).T, axis=1))])
    c = np.array(c)
    for _ in range(rounds):
        near = np.argmax(own @ c.T, axis=1)
        c = np.array([unit(own[near == i].sum(0)) if (near == i).any() else c[i] for i in range(len(c))])
    near = np.argmax(own @ c.T, axis=1)
    d = 1 - np.max(own @ c.T, axis=1)
    return c, np.array([np.quantile(d[near == i], 1 - REJECT) if (near == i).any() else 0.0 for i in range(len(c))])


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, offsets = bt.utf8(batch.column("text"))
    for lo, hi in bt.cuts(offsets, BLOCK_BYTES):
        for a in range(lo, hi, 1000):  # rows of DIM counts
            z = min(hi, a + 1000)
            yield batch.slice(a, z - a), data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]


def train(docs: DataFrame, most: int = TRAIN_DOCS) -> Centroids | None:
    """Fit on at most `most` documents of each language outside the held-out fold; None if there are none.

    Document frequencies are summed up in the cluster, and each language is
    clustered by a task of its own: the driver gets centroids only. Of rows of
    one id and language the one of the least counts is taken.
    """
    # one document of each language and slot, the one of the least hash: an aggregate that is summed up before the shuffle
    h = F.xxhash64("doc_id", F.lit("lang"))
    picked = (
        docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
        .where(~held_out())
        .select("lang", F.col("doc_id").cast("long").alias("doc_id"), h.alias("h"))
        .groupBy("lang", F.pmod("h", F.lit(most)).alias("slot"))
        .agg(F.min(F.struct("h", "doc_id")).alias("m"))
        .select("lang", "m.doc_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in _blocks(whole):
                c = gram_counts(data, offsets).astype("<u4")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array([r.tobytes() for r in c], pa.binary())], ["doc_id", "lang", "counts"])

    texts = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    picked = materialize(picked, "langsample")
    # `most` rows a language: with an odd number of languages the sample is joined by shuffle
    picked = F.broadcast(picked) if picked.count() <= BROADCAST_ROWS else picked
    rows = texts.join(picked, ["doc_id", "lang"], "left_semi").mapInArrow(run, "doc_id long, lang string, counts binary")
    rows = materialize(rows.groupBy("lang", "doc_id").agg(F.min("counts").alias("counts")), "langcounts")

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, own = 0, np.zeros(DIM, np.int64)
        for batch in batches:
            for c in batch.column("counts").to_pylist():
                n, own = n + 1, own + (np.frombuffer(c, "<u4") > 0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, DIM), pa.int32()), pa.array([n, *own.tolist()], pa.int64())], ["gram", "n"])

    # DIM + 1 sums
    sums = {r["gram"]: r["n"] for r in rows.select("counts").mapInArrow(having, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    if not sums.get(-1):
        return None
    idf = inverse_frequency(sums[-1], np.array([sums[k] for k in range(DIM)]))

    def fit(table: pa.Table) -> pa.Table:
        # by id, so that ties fall alike each time
        table = table.sort_by("doc_id")
        c, far = cluster(np.array([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]), idf)
        return pa.table({"lang": table.column("lang")[:1], "points": pa.array([c.astype("<f8").tobytes()], pa.binary()), "far": pa.array([far.astype("<f8").tobytes()], pa.binary())})

    # at most `most` rows a language; CENTROIDS vectors of each come back
    found = rows.groupBy("lang").applyInArrow(fit, "lang string, points binary, far binary").collect()
    return Centroids.of(idf, {r["lang"]: (np.frombuffer(r["points"], "<f8").reshape(-1, DIM), np.frombuffer(r["far"], "<f8")) for r in found})


def identify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score, rejected.

    `und`, score 0 and rejected, if the text is null or has no letter, or if
    nothing was learned. score is the cosine. Only the text enters. Other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for batch, data, offsets in _blocks(whole):
                texts = batch.column("text").to_pylist()
                seen = np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)
                if m is None:
                    lang, score, rejected = [UNKNOWN] * len(batch), np.zeros(len(batch)), np.ones(len(batch), bool)
                else:
                    best, cos = m.nearest(gram_counts(data, offsets))
                    lang = [m.names[b] if s else UNKNOWN for b, s in zip(best, seen, strict=True)]
                    score = np.where(seen, cos, 0.0)
                    rejected = ~seen | (1 - cos > m.far[best] + 1e-9)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op8_nearest_centroid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, train(docs))
