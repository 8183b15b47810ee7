"""Text columns as byte arrays: word bounds and hashes for whole Arrow batches.

Texts stay UTF-8 bytes; every separator of the two word classes is an ASCII
byte, so that bytes decide word bounds exactly. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z, so upper case is in the class.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: `[^\x20\x09-\x0D]+`
NONSPACE = np.ones(256, bool)
NONSPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Lower-cases A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows on end, and n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def cuts(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words before each row (n + 1)."""
    m = kind[data]
    first = m.copy()
    first[1:] &= ~m[:-1]
    last = m.copy()
    last[:-1] &= ~m[1:]
    at = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[at] = m[at]
    at = at[at > 0]
    last[at - 1] = m[at - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


#: Masks of the first 0 to 8 bytes of a little-endian word.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian number, zeros after the end; a view, to be indexed."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each span, the same wherever they stand; another seed is another function.

    Every eight bytes are spread together with their number in the span before
    they are added up, so that no arithmetic relation of the bytes carries over
    to the sums, whatever a span's length.
    """
    size = (ends - starts).astype(np.int64)
    at = np.asarray(starts, np.int64)
    if not len(at):
        return np.zeros(0, U)
    start = U((seed + 1) * int(BASE) & 0xFFFFFFFFFFFFFFFF)
    words = words_at(data)
    h = mix((words[at] & _FIRST[np.minimum(size, 8)]) ^ start)
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) // 8  # eight-byte words after the first
        first = np.cumsum(more) - more
        inner = np.arange(first[-1] + more[-1]) - np.repeat(first, more) + 1
        place = np.repeat(at[long], more) + 8 * inner
        left = np.minimum(np.repeat(at[long] + size[long], more) - place, 8)
        part = mix((words[place] & _FIRST[left]) ^ mix(inner.astype(U) * BASE + start))
        h[long] += np.add.reduceat(part, first)
    return mix(h + size.astype(U) * BASE)


def chain_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive hashes."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, U)
    for i in range(k):
        out = out * BASE + h[i : i + n]
    return mix(out)
