r"""Training-order materialisation: packed sequences in a keyed pseudo-random order, in fixed-stride shards.

Every sequence gets a dense index (its task's first index plus its place in the
task), and a keyed Feistel network over the smallest even number of bits that
holds all indices maps it to a slot; a value at or above the number of sequences
is mapped again (cycle-walking), so the map is a permutation of the slots. No
sort of random numbers and no state: any slot can be computed, and inverted,
from the key and the number of sequences.

Slots are cut into ranges of ``stride``; each range is one shard, written by
one task as one Parquet file of ``stride`` rows (the last may be shorter) in
slot order, every row the same number of bytes. Slot s is row s % stride of
shard s // stride, so a reader can resume at any slot. Writing goes through
Spark's committer, so a lost task leaves nothing behind.

Defined results: what :func:`llm.packing.sequences` says of NULL and empty
texts and repeated rows; an empty table writes no shard.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import scratch_path
from llm.common import U64, mix, shuffle_parts, stored
from llm.packing import sequences

#: Key of the order, sequences of a shard, and rounds of the network.
KEY, STRIDE, ROUNDS = 0x0123456789ABCDEF, 4096, 6


def round_keys(key: int) -> np.ndarray:
    """One 64-bit key a round."""
    with np.errstate(over="ignore"):
        return mix(U64(key) + np.arange(1, ROUNDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def feistel(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    """One pass of the balanced network over 2 * half bits."""
    low = U64((1 << half) - 1)
    left, right = x >> U64(half), x & low
    for k in keys:
        left, right = right, left ^ (mix(right ^ k) & low)
    return (left << U64(half)) | right


def unfeistel(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    """Inverse of :func:`feistel`."""
    low = U64((1 << half) - 1)
    left, right = x >> U64(half), x & low
    for k in keys[::-1]:
        left, right = right ^ (mix(left ^ k) & low), left
    return (left << U64(half)) | right


def walked(x: np.ndarray, n: int, key: int, step=feistel) -> np.ndarray:
    """Permutation of 0..n-1 by cycle-walking (``step=unfeistel`` inverts it)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    keys = round_keys(key)
    with np.errstate(over="ignore"):
        out = step(np.asarray(x, U64), half, keys)
        beyond = np.flatnonzero(out >= U64(n))
        while len(beyond):
            out[beyond] = step(out[beyond], half, keys)
            beyond = beyond[out[beyond] >= U64(n)]
    return out


def in_order(rows: DataFrame, key: int = KEY, stride: int = STRIDE) -> DataFrame:
    """Adds slot, shard and row to stored sequences (part, number, ...).

    The driver sees one count per task that packed, to place the tasks' indices.
    """
    counts = sorted(rows.groupBy("part").count().collect())
    n = sum(r["count"] for r in counts)
    at = np.concatenate([[0], np.cumsum([r["count"] for r in counts])])
    first = {r.part: int(a) for r, a in zip(counts, at)}

    def place(part: pa.Array, number: pa.Array) -> pa.Array:
        index = np.array([first[p] for p in part.to_pylist()], np.int64) + number.to_numpy()
        return pa.array(walked(index, n, key).astype(np.int64))

    slot = F.arrow_udf(place, "long")(F.col("part"), F.col("number"))
    return rows.withColumn("slot", slot).withColumns({"shard": F.floor(F.col("slot") / stride), "row": F.col("slot") % stride})


def materialise(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", key: int = KEY, stride: int = STRIDE) -> DataFrame:
    """Writes the shards under ``path``; returns the written rows without their ids.

    Rows: slot, shard, row, n_tokens, ids_crc32, doc_ids.
    """
    spark = df.sparkSession
    packed = stored(sequences(df, id_col, text_col), "sequences", "zstd")
    rows = in_order(packed, key, stride).select("shard", "row", "slot", "n_tokens", "ids_crc32", "doc_ids", "ids")
    shards = rows.repartition(shuffle_parts(spark), "shard").sortWithinPartitions("shard", "row")
    shards.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    return written.select("slot", "shard", "row", "n_tokens", "ids_crc32", "doc_ids")


def read_slots(spark: SparkSession, path: str, first: int, count: int, stride: int = STRIDE) -> Iterator[np.ndarray]:
    """Token ids of ``count`` sequences from slot ``first`` on, a shard at a time."""
    slot, last = first, first + count
    while slot < last:
        end = min(last, (slot // stride + 1) * stride)
        part = spark.read.parquet(path).where((F.col("shard") == slot // stride) & F.col("slot").between(slot, end - 1))
        for r in part.orderBy("slot").select("ids", "n_tokens").toLocalIterator():
            yield np.frombuffer(bytes(r.ids), "<u2")[:r.n_tokens]
        slot = end


def shard_path(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{scratch_path(spark, 'llm')}/shards-{uuid.uuid4().hex}"

