"""Shared helpers of the training-data operators: scratch tables and text arithmetic.

Texts are handled as UTF-8 bytes in numpy arrays, a few megabytes at a time, so
the memory of a task does not depend on how many documents its partition holds
(one document is the smallest unit that is ever held whole).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from blotter.session import scratch_path

#: Bytes of text that one numpy step works on.
CHUNK_BYTES = 1 << 20

U64 = np.uint64
_ODD_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_ODD_BASE, -1, 1 << 64)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table under ``spark.checkpoint.dir`` and return the reread table.

    This cuts the lineage on storage that every executor shares, so a lost
    executor costs the tasks it was running and nothing before them.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession, wanted: int = 0) -> int:
    """Partition count of an explicit shuffle: the session's, or ``wanted`` if more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(wanted))


# ----------------------------------------------------------------- text bytes

def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL becomes the empty text."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, off, data = arr.buffers()
    offs = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1] if off else np.zeros(len(arr) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw, offs


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of about ``limit`` bytes each; a longer text stands alone."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept between calls."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, b in enumerate((_ODD_BASE, _BASE_INVERSE)):
            p = np.full(size, b, U64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-multiply-shift), elementwise."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def prefix_sums(b: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Running polynomial sums of the bytes (or their weights): hash of b[s:e] is (S[e]-S[s]) * base**-s."""
    pw, _ = powers(len(b) + 1)
    s = np.zeros(len(b) + 1, U64)
    np.cumsum((b.astype(U64) + U64(1) if weight is None else weight[b]) * pw[:len(b)], out=s[1:])
    return s


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end)."""
    _, inv = powers(len(sums))
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Word separators: space and the five controls from tab to carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def lower(b: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; every other byte is left alone."""
    return _LOWER[b]


def words(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts b[offs[i]:offs[i+1]].

    Returns word starts, word ends and, per text, the index of its first word
    (one more entry closes the last text). ``offs[0]`` is 0.
    """
    n = len(b)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    solid = ~_SPACE[b]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offs[(offs > 0) & (offs < n)]
    first[inner] = solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every lower-cased word, index of each text's first word)."""
    starts, ends, at = words(b, offs)
    if not len(starts):
        return np.zeros(0, U64), at
    return span_hash(prefix_sums(lower(b)), starts, ends), at


def shingle_sets(b: np.ndarray, offs: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes per text.

    A text of fewer than ``size`` words has its whole word sequence as its one
    shingle; a text without words has none.
    """
    with np.errstate(over="ignore"):
        wh, at = word_hashes(b, offs)
        n = len(wh)
        sh = np.zeros(max(n - size + 1, 0), U64)
        if len(sh):
            c = U64(1)
            for j in range(size):
                sh += wh[j:n - size + 1 + j] * c
                c = c * U64(0xC2B2AE3D27D4EB4F) + U64(2)
                c |= U64(1)
            sh = mix(sh)
        out = []
        for lo, hi in zip(at[:-1], at[1:]):
            k = hi - lo
            if k >= size:
                out.append(np.unique(sh[lo:hi - size + 1]))
            elif k:
                h = U64(k)
                for x in wh[lo:hi]:
                    h = mix(np.array([h * U64(0x9FB21C651E98DF25) + x], U64))[0]
                out.append(np.array([h], U64))
            else:
                out.append(np.zeros(0, U64))
    return out


# -------------------------------------------------------- sorted keys as bytes

def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as deltas of the fewest whole bytes that hold them all."""
    if not len(keys):
        return b""
    d = np.diff(keys, prepend=U64(0))
    first, d = d[:1], d[1:]
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    body = np.ascontiguousarray(d).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + first.tobytes() + body.tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    """Inverse of :func:`pack_sorted`."""
    if not packed:
        return np.zeros(0, U64)
    width = packed[0]
    first = np.frombuffer(packed, U64, 1, 1)
    body = np.frombuffer(packed, np.uint8, -1, 9).reshape(-1, width)
    wide = np.zeros((len(body) + 1, 8), np.uint8)
    wide[1:, :width] = body
    d = wide.view(U64).ravel()
    d[0] = first[0]
    return np.cumsum(d, dtype=U64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest unsigned type, which the first byte names."""
    top = int(counts.max()) if len(counts) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpack_counts(packed: bytes) -> np.ndarray:
    """Inverse of :func:`pack_counts`."""
    return np.frombuffer(packed, f"<u{packed[0]}", -1, 1).astype(np.int64)
