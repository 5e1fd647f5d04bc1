"""Questions from blocks of documents to shards of a key space, and the answers.

A statistic over all documents (a count, a first occurrence) is often needed
back where the text is. Rows per key would move a key's name and its owner over
and over; instead a block of documents sends each shard its sorted distinct keys
as one packed array, the shard merges the arrays of all blocks, and returns one
value per key in the same order. Blocks and shards grow in number with the
input, not in size, so memory does not depend on it, and a key that is in every
document appears once per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import U64, pack_sorted, unpack_sorted


def text_total(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return df.select(F.sum(F.octet_length(text))).first()[0] or 0


def count_of(total: int, each: int) -> int:
    """How many parts of about ``each`` hold ``total``; at least one."""
    return max(1, ceil(total / each))


def by_hash(blocks: int, *cols: str) -> Column:
    """Block number from the hash of some columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(blocks)).cast("int")


def asked(keys: np.ndarray, shards: int, bits: int = 64) -> Iterator[tuple[int, int, int]]:
    """(shard, lo, hi) for the shards that sorted keys of ``bits`` (32 to 64) bits fall into; shards are key ranges."""
    if not len(keys):
        return
    shard = ((keys >> U64(bits - 32)) * U64(shards)) >> U64(32)
    cut = np.flatnonzero(shard[1:] != shard[:-1]) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
        yield int(shard[lo]), lo, hi


def merged(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all keys of several packed arrays, array number of each, order that sorts them; stable)."""
    parts = [unpack_sorted(p) for p in packed]
    keys = np.concatenate(parts) if parts else np.zeros(0, U64)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return keys, owner, np.argsort(keys, kind="stable")


def runs(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal values in sorted ``keys``."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


__all__ = ["asked", "by_hash", "count_of", "merged", "pack_sorted", "runs", "text_total"]
