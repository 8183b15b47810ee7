"""Documents packed into shards, and questions that shards ask of hash buckets.

Packing writes runs of whole documents as one row each, the texts on end and
compressed, to the shared folder: later stages read that table instead of the
source, with fixed shard numbers. A question is one binary for each shard and
bucket (say, sorted hashes), an answer one binary back (say, a bit for each
hash). Between them a bucket's task sees what all shards sent it. Only packed
hashes and bits move, and a shard sends each distinct value once, so that hot
values are summed up before the shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm import bytestext as bt
from lexweave.storage import note_written, shared_dir

SHARD_BYTES = 4 << 20
BUCKET_BYTES = 2 << 20
#: A shard's number is its task's number and its own in it; a row's is the shard's and its place.
ROW_BITS = 20
MOST_ROWS = 1 << (ROW_BITS - 1)
PACKED = "shard long, n long, size long, ids binary, null_ids binary, offsets binary, text binary"
_CODEC = "zstd"


@dataclass
class Shard:
    shard: int
    ids: np.ndarray
    null_ids: np.ndarray
    offsets: np.ndarray
    data: np.ndarray
    extra: bytes | None = None

    def rows(self) -> np.ndarray:
        return (np.int64(self.shard) << ROW_BITS) + np.arange(len(self.ids))

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.null_ids)


def compress(x: bytes | np.ndarray) -> bytes:
    raw = x.tobytes() if isinstance(x, np.ndarray) else x
    return len(raw).to_bytes(8, "little") + pa.Codec(_CODEC, compression_level=3).compress(raw, asbytes=True)


def decompress(x: bytes) -> bytes:
    return pa.Codec(_CODEC).decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True)


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def pack(docs: DataFrame, whole: bool = False, extra: Callable[[np.ndarray, np.ndarray], bytes] | None = None) -> DataFrame:
    """The written table of shards of docs (doc_id, text); null texts are empty.

    whole: all columns but the text, and which texts are null, go along in a
    column `rest`, for `kept_rows`. extra: what is computed once of a shard's
    bytes and offsets and kept with it.
    """
    others = [c for c in docs.columns if c != "text"] if whole else []
    carried = [F.col(c).alias(f"_r{k}") for k, c in enumerate(others)] + [F.isnull("text").alias("_null")] if whole else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, size = TaskContext.get().partitionId() << ROW_BITS, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal base, held, size
            ids = pa.concat_arrays([x[0] for x in held])
            data = np.concatenate([x[1] for x in held])
            steps = np.concatenate([np.diff(x[2]) for x in held])
            offsets = np.concatenate([[0], np.cumsum(steps)]).astype("<i8")
            rest = [[compress(_stream(pa.Table.from_batches([x[3] for x in held])))]] if whole else []
            rest += [[compress(extra(data, offsets))]] if extra else []
            row = [[base], [len(ids)], [len(data)], [compress(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))], [compress(ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))], [compress(offsets)], [compress(data)], *rest]
            base, held, size = base + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int64()] * 3 + [pa.binary()] * (4 + len(rest)), strict=True)], ["shard", "n", "size", "ids", "null_ids", "offsets", "text"] + ["rest"] * whole + ["extra"] * bool(extra))

        for batch in batches:
            data, offsets = bt.utf8(batch.column("text"))
            ids = batch.column("doc_id")
            for lo, hi in ((a, min(hi, a + MOST_ROWS // 2)) for lo, hi in bt.cuts(offsets, SHARD_BYTES // 4) for a in range(lo, hi, MOST_ROWS // 2)):
                held.append((ids.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]].copy(), offsets[lo : hi + 1] - offsets[lo], batch.slice(lo, hi - lo).select(range(2, batch.num_columns))))
                size += int(offsets[hi] - offsets[lo])
                if size >= SHARD_BYTES * 3 // 4 or sum(len(x[0]) for x in held) >= MOST_ROWS:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried).mapInArrow(run, PACKED + ", rest binary" * whole + ", extra binary" * bool(extra))
    return _bucketed(rows)


def _bucketed(rows: DataFrame) -> DataFrame:
    """Shards in a written table that is hashed by shard: joins with answers leave the texts where they are."""
    spark, name = rows.sparkSession, f"lexweave_shards_{uuid.uuid4().hex}"
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/{name}"
    note_written(path, name)
    writer = rows.write.format("parquet").option("path", path).option("compression", "uncompressed")
    writer.bucketBy(buckets, "shard").saveAsTable(name)
    return spark.table(name)


def unpack(batch: pa.RecordBatch) -> Iterator[Shard]:
    for i in range(len(batch)):
        get = lambda name, kind: np.frombuffer(decompress(batch.column(name)[i].as_py()), kind)  # noqa: B023, E731
        yield Shard(batch.column("shard")[i].as_py(), get("ids", "<i8"), get("null_ids", np.uint8).astype(bool), get("offsets", "<i8"), get("text", np.uint8), decompress(batch.column("extra")[i].as_py()) if "extra" in batch.schema.names else None)


def bucket_count(shards: DataFrame, share: float) -> int:
    """Buckets for questions of about `share` of the texts' bytes: a power of two."""
    size = shards.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    least = 2 * int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = 1
    while n < max(least, share * size / BUCKET_BYTES):
        n *= 2
    return n


def _single(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(len(batch)):
        yield batch.slice(i, 1)


def ask(shards: DataFrame, emit: Callable[..., Iterator[tuple[int, bytes]]], answers: DataFrame | None = None) -> DataFrame:
    """(bucket, shard, payload) of all shards; emit(shard, answers so far by bucket)."""
    shards = shards.drop("rest")
    joined, last = (shards, False) if answers is None else (with_answers(shards, answers), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in _single(batch):
                s = next(unpack(one))
                rows = list(emit(s, _by_bucket(one)) if last else emit(s))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([s.shard] * len(rows), pa.int64()), pa.array([p for _, p in rows], pa.binary())], ["bucket", "shard", "payload"])

    return joined.mapInArrow(run, "bucket int, shard long, payload binary")


def answer(asked: DataFrame, resolve: Callable[[int, list[tuple[int, bytes]]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(shard, bucket, reply): resolve(bucket, [(shard, payload)]) for each bucket; an empty reply isn't sent."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        own = sorted(zip(table.column("shard").to_pylist(), table.column("payload").to_pylist(), strict=True))
        rows = [(s, r) for s, r in resolve(bucket, own) if r]
        return pa.table({"shard": pa.array([s for s, _ in rows], pa.int64()), "bucket": pa.array([bucket] * len(rows), pa.int32()), "reply": pa.array([r for _, r in rows], pa.binary())})

    return asked.groupBy("bucket").applyInArrow(run, "shard long, bucket int, reply binary")


def with_answers(shards: DataFrame, answers: DataFrame) -> DataFrame:
    """Shards with their replies, as lists of buckets and replies. A shard's replies are a small part of its size."""
    own = answers.groupBy("shard").agg(F.collect_list(F.struct("bucket", "reply")).alias("replies"))
    own = own.select("shard", F.col("replies.bucket").alias("buckets"), F.col("replies.reply").alias("replies"))
    return shards.join(own.hint("shuffle_hash"), "shard", "left")


def _by_bucket(one: pa.RecordBatch) -> dict[int, bytes]:
    buckets, replies = one.column("buckets")[0].as_py(), one.column("replies")[0].as_py()
    return dict(zip(buckets or [], replies or [], strict=True))


def finish(shards: DataFrame, answers: DataFrame, apply: Callable[[Shard, dict[int, bytes]], pa.RecordBatch], schema: str) -> DataFrame:
    """Rows that apply(shard, replies by bucket) makes of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in _single(batch):
                yield apply(next(unpack(one)), _by_bucket(one))

    return with_answers(shards.drop("rest"), answers).mapInArrow(run, schema)


def kept_rows(shards: DataFrame, rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The packed documents (see `pack`, whole) of the given row numbers, with the columns of schema; their texts aren't shuffled."""
    others = [f.name for f in schema.fields if f.name != "text"]
    own = rows.groupBy(F.shiftright("row", ROW_BITS).alias("shard")).agg(F.collect_list(F.col("row").bitwiseAND((1 << ROW_BITS) - 1).cast("int")).alias("keep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in _single(batch):
                s = next(unpack(one))
                rest = pa.ipc.open_stream(decompress(one.column("rest")[0].as_py())).read_all().combine_chunks()
                null = rest.column("_null").combine_chunks()
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s.ids), [None, pa.py_buffer(s.offsets), pa.py_buffer(s.data)])
                at = pa.array(np.sort(np.array(one.column("keep")[0].as_py(), np.int64)))
                text = pc.if_else(null, pa.scalar(None, pa.large_binary()), text).take(at).view(pa.large_utf8()).cast(pa.string())
                columns = {c: rest.column(f"_r{k}").combine_chunks().take(at) for k, c in enumerate(others)} | {"text": text}
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], [f.name for f in schema.fields])

    return shards.join(own.hint("shuffle_hash"), "shard").mapInArrow(run, schema)


def split_sorted(values: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Sorted 64-bit hashes by bucket, their leading bits."""
    if not len(values):
        return
    shift = np.uint64(64 - max(1, (buckets - 1).bit_length()))
    own = (values >> shift).astype(np.int64)
    cut = np.flatnonzero(np.diff(own, prepend=-1))
    for a, b in zip(cut, np.append(cut[1:], len(own)), strict=True):
        yield int(own[a]), slice(int(a), int(b))


#: Bytes of a hash beyond the bucket's bits that a shard sends to learn whether it repeats.
HASH_BYTES = 5


def spare_bits(buckets: int) -> np.uint64:
    """Trailing bits of a hash that aren't sent: its bucket tells the leading ones. From 2^24 buckets on all bits are known."""
    return np.uint64(max(0, 64 - 8 * HASH_BYTES - (buckets - 1).bit_length()))


#: Numbers of buckets stay below; a second question's buckets and replies have numbers from here.
SECOND = 1 << 30


def hash_question(keys: np.ndarray, both: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Sorted distinct hashes by bucket, five bytes each; both: known to stand in two documents."""
    drop = spare_bits(buckets)
    for b, own in split_sorted(keys, buckets):
        low = (keys[own] >> drop).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
        yield b, len(low).to_bytes(4, "little") + np.packbits(both[own]).tobytes() + low.tobytes()


def repeated_answer(_: int, asked: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """A bit for each hash, whether two documents or more have it; a chance agreement of five bytes counts too."""
    keys, both = [], []
    for _, p in asked:
        n = int.from_bytes(p[:4], "little")
        both.append(np.unpackbits(np.frombuffer(p, np.uint8, -(-n // 8), 4), count=n).astype(bool))
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :HASH_BYTES] = np.frombuffer(p, np.uint8, n * HASH_BYTES, 4 + -(-n // 8)).reshape(n, HASH_BYTES)
        keys.append(wide.view("<u8")[:, 0])
    every = np.concatenate(keys)
    every.sort()
    again = np.unique(every[1:][every[1:] == every[:-1]])
    for (shard, _), k, two in zip(asked, keys, both, strict=True):
        bits = two | (again[np.minimum(np.searchsorted(again, k), len(again) - 1)] == k if len(again) else False)
        yield shard, np.packbits(bits).tobytes() if bits.any() else b""


def repeated_bits(keys: np.ndarray, replies: dict[int, bytes], buckets: int, offset: int = 0) -> np.ndarray:
    """The answer for sorted distinct hashes; offset: of the replies' bucket numbers."""
    again = np.zeros(len(keys), bool)
    for b, own in split_sorted(keys, buckets):
        if b + offset in replies:
            again[own] = np.unpackbits(np.frombuffer(replies[b + offset], np.uint8), count=own.stop - own.start).astype(bool)
    return again
