r"""Removal of repeated byte strings, by a difference-cover suffix method.

A byte goes when a string of ``WINDOW`` bytes that covers it also starts
earlier (in a smaller id, or earlier in the same document). Only prefixes of
that length matter, so suffixes need names, not a full order:

1. Sample: positions whose offset modulo ``PERIOD`` is in a difference cover.
   For any two positions some shift below the period puts both on sampled ones
   (the cover is a perfect difference set, so a fifth of all positions).
   Sampled suffixes get a name for their first ``WINDOW - PERIOD + 1`` bytes.
2. Names are sorted in shards; equal neighbours are repeated names. Two windows
   that are equal have, at that shift, equal names inside them, so a window
   without a repeated name is unique. Unrepeated text, most of it, ends here.
3. The windows that are left are named from their whole prefix (the recursion
   on names: a longer name at the remaining suffixes only) and merged by name;
   comparing neighbours in name order and id order finds the first occurrence.
4. Every other occurrence marks its bytes; documents are cut.

The classical form, with triples (period 3), ranks and full recursion, moves
two thirds of all suffixes several times over, tens of times the input; the
larger cover and the bounded prefix are the same algorithm at the length asked
for. Names of windows and of whole texts are hashes of the bytes, a key and a
second word (sampled names are shorter, as they only admit candidates). Names of
texts have 128 bits. Of n windows in question some two different ones share a
name of B bits with a probability of about n * n / 2**(B + 1); B is the least
for which this is under 2**-30 if every byte of the table started one (128 bits
beyond 2**49 bytes). Sorted keys travel in Elias-Fano form.

Blocks are ranges of ids, so "earlier" is a smaller block, or earlier inside
one; a block asks with its distinct names and gets one bit for each. Texts are
shuffled once, each compressed by itself, and read three times from there. Whole
copies are found by a name for the text and take no further part.

Defined results: NULL counts as empty, and texts under ``WINDOW`` bytes are
never cut; rows that repeat an id and text are one document with one result;
different texts under one id stand in a fixed order (of their hashes); NULL ids
come after all others, as one document; an empty table gives an empty result;
a text of any length is cut whole, as the smallest part of a block. Ids are
integers. Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import asked, count_of, runs, text_total
from llm.common import U64, chunks, mix, prefix_sums, shuffle_parts, span_hash, text_bytes

#: Bytes of a repeated string.
WINDOW = 100
#: Period of the difference cover and its offsets (every difference once).
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Text of a block, and text per shard of the name space.
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 16 << 20
#: The probability that any two windows share a name is 2**-SAFE_BITS at most; second words have some bytes at least.
SAFE_BITS, LEAST_SECOND = 30, 4
#: Kinds of questions: sampled names, whole texts, windows.
SAMPLE, WHOLE, FULL = 1, 2, 3
#: Leading bits of a sampled name that are looked up before the search among the repeated ones (at most 32).
FILTER_BITS = 22

#: What each byte counts in a name's second word.
_WEIGHT = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def name_size(total: int) -> tuple[int, int]:
    """Bits of the key and bytes of the second word of a window's name, in a table of ``total`` bytes of text."""
    all_bits = min(128, max(80, 2 * total.bit_length() + SAFE_BITS - 1))
    second = max(LEAST_SECOND, -(-(all_bits - 64) // 8))
    return all_bits - 8 * second, second


def pack_fano(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as first key, low bits as they are and high bits in unary (Elias-Fano)."""
    n = len(keys)
    if not n:
        return b""
    d = keys - keys[0]
    low_bits = max(0, (int(d[-1]) // n).bit_length() - 1)
    whole, rest = divmod(low_bits, 8)
    high = (d >> U64(low_bits)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(high[-1]) + 1, np.uint8)
    unary[high] = 1
    parts = d.view(np.uint8).reshape(-1, 8)
    tail = np.unpackbits(parts[:, whole:whole + 1], axis=1)[:, 8 - rest:] if rest else np.zeros(0, np.uint8)
    head = np.array([n, keys[0], low_bits], U64).tobytes()
    return head + parts[:, :whole].tobytes() + np.packbits(tail).tobytes() + np.packbits(unary).tobytes()


def unpack_fano(packed: bytes) -> np.ndarray:
    """Inverse of :func:`pack_fano`."""
    if not packed:
        return np.zeros(0, U64)
    n, first, low_bits = (int(x) for x in np.frombuffer(packed, U64, 3))
    whole, rest = divmod(low_bits, 8)
    at = 24 + n * whole
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :whole] = np.frombuffer(packed, np.uint8, n * whole, 24).reshape(n, whole)
    many = -(-n * rest // 8)
    if rest:
        tail = np.unpackbits(np.frombuffer(packed, np.uint8, many, at))[:n * rest].reshape(n, rest)
        wide[:, whole] = np.packbits(tail, axis=1)[:, 0] >> (8 - rest)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, -1, at + many))) - np.arange(n)
    return (wide.view(U64).ravel() | (high.astype(U64) << U64(low_bits))) + U64(first)


def narrowed(words: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each word."""
    return np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widened(packed: bytes, n: int) -> np.ndarray:
    """Inverse of :func:`narrowed` for ``n`` words."""
    wide = np.zeros((n, 8), np.uint8)
    if n:
        body = np.frombuffer(packed, np.uint8).reshape(n, -1)
        wide[:, :body.shape[1]] = body
    return wide.view(U64).ravel()


def counted(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct names and how often each occurs."""
    names = np.sort(names)
    start = runs(names) if len(names) else np.zeros(0, np.int64)
    return names[start], np.diff(np.append(start, len(names)))


def order_of(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts (2, n) names (key, second word), equal ones in any order; starts of the runs of equal ones in it."""
    order = np.argsort(names[0])
    some = names[:, order]
    if ((some[0, 1:] == some[0, :-1]) & (some[1, 1:] != some[1, :-1])).any():  # one key, different names
        order = np.lexsort(names[::-1])
        some = names[:, order]
    new = np.ones(len(order), bool)
    new[1:] = (some[:, 1:] != some[:, :-1]).any(axis=0)
    return order, np.flatnonzero(new)


def distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (2, n) names, where each comes first, and which of them every name is."""
    order, start = order_of(names)
    back = np.empty(len(order), np.int64)
    back[order] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(order))))
    return names[:, order[start]], np.minimum.reduceat(order, start) if len(order) else order, back


def sampled_places(at: np.ndarray, reach: int) -> np.ndarray:
    """Positions in the cover, counted within each of the texts between offsets ``at``, with ``reach`` bytes of their text from there on."""
    size = np.diff(at)
    many = -(-size // PERIOD)
    period = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    place = period[:, None] * PERIOD + np.array(COVER)
    return (np.repeat(at[:-1], many)[:, None] + place)[place <= np.repeat(size - reach, many)[:, None]]


class Block:
    """The documents of a block in (id, text) order, without copies of one another."""

    def __init__(self, table: pa.Table, window: int, bits: int, size: tuple[int, int]):
        self.window, self.bits, self.reach = window, bits, window - PERIOD + 1
        self.less = U64(64 - size[0]), U64(64 - 8 * size[1])
        whole = zstandard.ZstdDecompressor()
        texts = [whole.decompress(x) for x in table.column("packed").to_pylist()]
        raw, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        del texts
        ids = table.column("id")
        none = np.asarray(ids.is_null())
        number = ids.fill_null(0).to_numpy()
        digest = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(offs[:-1], offs[1:])]
        order = sorted(range(len(digest)), key=lambda i: (none[i], number[i], digest[i]))
        self.raw, self.offs, self.rows = raw, offs, len(digest)
        #: per row: the place of the first row with its text, and whether that one has the same id
        first: dict[bytes, int] = {}
        self.head = np.array([0] * self.rows)
        for i in order:
            self.head[i] = first.setdefault(digest[i], i)
        self.same = np.array([none[i] == none[j] and number[i] == number[j] for i, j in enumerate(self.head)], bool)
        self.size = np.diff(offs)
        self.docs = [i for i in order if self.head[i] == i and self.size[i] >= window]
        self.whole = np.array([[int.from_bytes(digest[i][k:k + 8], "little") for i in self.docs] for k in (0, 8)], U64)

    def parts(self) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Documents a chunk at a time: (rows, offsets, bytes)."""
        ends = np.concatenate([[0], np.cumsum(self.size[self.docs])]) if self.docs else np.zeros(1, np.int64)
        for lo, hi in chunks(ends):
            some = self.docs[lo:hi]
            yield some, ends[lo:hi + 1] - ends[lo], np.concatenate([self.raw[self.offs[i]:self.offs[i + 1]] for i in some])

    def sampled(self) -> np.ndarray:
        """Sampled names of all documents, shortened to ``bits``. Each chunk's positions and names stay in ``marks``."""
        self.marks: list[tuple[np.ndarray, np.ndarray]] = []
        for _, at, b in self.parts():
            s = sampled_places(at, self.reach)
            self.marks.append((s, span_hash(prefix_sums(b), s, s + self.reach) >> U64(64 - self.bits)))
        return np.concatenate([name for _, name in self.marks]) if self.marks else np.zeros(0, U64)

    def candidates(self, docs: list[int], repeated: np.ndarray) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """Per chunk the windows of ``docs`` that hold a repeated sampled name (after ``sampled``): (rows, offsets, starts, (2, n) names)."""
        if not len(repeated):
            return
        asks = np.zeros(self.rows, bool)
        asks[docs] = True
        less = U64(self.bits - FILTER_BITS)
        near = np.zeros(1 << FILTER_BITS, bool)
        near[repeated >> less] = True
        for (some, at, b), (s, name) in zip(self.parts(), self.marks):
            maybe = np.flatnonzero(near[name >> less])
            name = name[maybe]
            u = np.searchsorted(repeated, name)
            u[u == len(repeated)] = 0
            hit = s[maybe[repeated[u] == name]]
            owner = np.searchsorted(at, hit, side="right") - 1
            ours = asks[some][owner]
            hit, owner = hit[ours], owner[ours]
            if not len(hit):
                continue
            n = at[-1]
            step = np.zeros(n + 1, np.int32)
            np.add.at(step, np.maximum(at[owner], hit - PERIOD + 1), 1)
            step[hit + 1] -= 1
            inside = np.cumsum(step[:-1], dtype=np.int32) > 0
            for a in at[1:]:
                inside[a - self.window + 1:a] = False
            p = np.flatnonzero(inside)
            names = [span_hash(prefix_sums(b, w), p, p + self.window) >> less for w, less in zip((None, _WEIGHT), self.less)]
            yield some, at, p, np.stack(names)


_QUESTION = "kind int, shard int, block int, keys binary, seconds binary"
_ANSWER = "kind int, shard int, block int, bits binary"


def questions(block: int, keys: dict[int, tuple[np.ndarray, np.ndarray | None, int]], shards: int, size: tuple[int, int]) -> pa.Table:
    """Question rows of sorted distinct names by kind: their keys, second words (or none) and the bits of a key.

    Second words of windows take ``size[1]`` bytes, those of texts eight.
    """
    rows = [(kind, shard, block, pack_fano(k[lo:hi]), b"" if more is None else narrowed(more[lo:hi], size[1] if kind == FULL else 8))
            for kind, (k, more, bits) in keys.items() for shard, lo, hi in asked(k, shards, bits)]
    cols = list(zip(*rows)) or [()] * 5
    types = {"kind": pa.int32(), "shard": pa.int32(), "block": pa.int32(), "keys": pa.binary(), "seconds": pa.binary()}
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(cols, types.items())})


def answered(table: pa.Table, kind: int, n: int) -> np.ndarray:
    """The bits of one kind for the block's n sorted keys."""
    table = table.sort_by("shard")
    of_kind = np.flatnonzero(table.column("kind").to_numpy() == kind)
    packed = table.column("bits").to_pylist()
    # each row's first four bytes tell how many bits it has
    parts = [np.unpackbits(np.frombuffer(packed[i], np.uint8, -1, 4))[:int.from_bytes(packed[i][:4], "little")] for i in of_kind]
    bits = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    if len(bits) != n:
        raise ValueError(f"{len(bits)} answers for {n} names")
    return bits


def answer(table: pa.Table) -> pa.Table:
    """A shard's answers: names in several blocks (samples), or in an earlier block (texts, windows)."""
    kind = table.column("kind")[0].as_py()
    table = table.sort_by("block")
    parts = [unpack_fano(x) for x in table.column("keys").to_pylist()]
    keys, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    if kind == SAMPLE:
        order = np.argsort(keys)
        start = runs(keys[order])
        n = np.diff(np.append(start, len(keys)))
        bit = np.empty(len(keys), bool)
        bit[order] = np.repeat(n > 1, n)
    else:  # by key and second word; rows are in block order, so the first of a run's places is the earliest
        order, start = order_of(np.stack([keys, widened(b"".join(table.column("seconds").to_pylist()), len(keys))]))
        bit = np.ones(len(keys), bool)
        bit[np.minimum.reduceat(order, start)] = False
    cut = np.flatnonzero(np.diff(owner)) + 1
    bits = [len(x).to_bytes(4, "little") + np.packbits(x).tobytes() for x in np.split(bit, cut)]
    return pa.table({"kind": table.column("kind"), "shard": table.column("shard"), "block": table.column("block"), "bits": pa.array(bits, pa.binary())})


def first_questions(window: int, bits: int, size: tuple[int, int], shards: int) -> Callable:
    """Block function of the first round: sampled names and whole texts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        b = Block(table, window, bits, size)
        return questions(key[0].as_py(), {SAMPLE: (counted(b.sampled())[0], None, bits), WHOLE: (*distinct(b.whole)[0], 64)}, shards, size)

    return run


def left_over(b: Block, told: pa.Table) -> tuple[list[int], np.ndarray]:
    """After the first round: the documents that are not copies, and the repeated sampled names."""
    names, n = counted(b.sampled())
    repeated = names[answered(told, SAMPLE, len(names)) | (n > 1)]
    texts, _, back = distinct(b.whole)
    copy = answered(told, WHOLE, texts.shape[1])[back] if texts.size else np.zeros(0, bool)
    return [d for d, c in zip(b.docs, copy) if not c], repeated


def second_questions(window: int, bits: int, size: tuple[int, int], shards: int) -> Callable:
    """Block function of the second round: names of the windows in question."""

    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return questions(0, {}, shards, size)
        b = Block(table, window, bits, size)
        found = [name for _, _, _, name in b.candidates(*left_over(b, told))]
        return questions(key[0].as_py(), {FULL: (*distinct(np.concatenate(found, axis=1))[0], size[0])} if found else {}, shards, size)

    return run


def cutter(window: int, bits: int, size: tuple[int, int], with_text: bool) -> Callable:
    """Block function of the end: documents and all answers in, the cut documents out."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        b = Block(table, window, bits, size)
        docs, repeated = left_over(b, told)
        own = set(docs)
        removed, spans = np.zeros(b.rows, np.int64), np.zeros(b.rows, np.int64)
        kept: list[bytes | None] = [None] * b.rows
        parts = list(b.candidates(docs, repeated))
        names = np.concatenate([p[3] for p in parts], axis=1) if parts else np.zeros((2, 0), U64)
        _, first, back = distinct(names)
        again = answered(told, FULL, len(first))[back] | (first[back] != np.arange(len(back))) if len(back) else np.zeros(0, bool)
        at_name = 0
        for some, at, p, _ in parts:
            hit = p[again[at_name:at_name + len(p)]]
            at_name += len(p)
            step = np.zeros(at[-1] + 1, np.int32)
            step[hit] += 1
            step[hit + window] -= 1
            gone = np.cumsum(step[:-1]) > 0
            for i, lo, hi in zip(some, at[:-1], at[1:]):
                g = gone[lo:hi]
                removed[i] = g.sum()
                if removed[i]:
                    spans[i] = int(g[0]) + int((g[1:] & ~g[:-1]).sum())
                    kept[i] = b.raw[b.offs[i]:b.offs[i + 1]][~g].tobytes()
        for i in range(b.rows):
            j = b.head[i]
            if b.size[i] >= window and (j not in own or not b.same[i]):  # a copy of an earlier document
                removed[i], spans[i], kept[i] = b.size[i], 1, b""
            elif j != i:
                removed[i], spans[i], kept[i] = removed[j], spans[j], kept[j]
        kept = [b.raw[b.offs[i]:b.offs[i + 1]].tobytes() if k is None else k for i, k in enumerate(kept)]
        out = {"id": table.column("id"), "n_bytes": pa.array(b.size, pa.int64()), "n_removed": pa.array(removed), "n_spans": pa.array(spans),
               "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])}
        return pa.table(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))

    return run


def id_blocks(ids: DataFrame, blocks: int) -> np.ndarray:
    """Smallest id of each of about ``blocks`` ranges with as many rows (a number per block)."""
    spread = ids.where("id is not null").repartitionByRange(blocks, "id")
    low = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.min("id").alias("low"))
    return np.array(sorted(r.low for r in low.select("low").collect()), np.int64)


def placing(low: np.ndarray) -> Callable:
    """Task function: (id, text) in, (block, id, compressed text) out. ``low`` has the smallest id of each block; NULL ids are the last block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids = batch.column(0)
            found = np.searchsorted(low, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
            block = np.where(ids.is_null().to_numpy(zero_copy_only=False), len(low) + 1, found)
            raw, offs = text_bytes(batch.column(1))
            packed = [small.compress(raw[a:b]) for a, b in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), ids, pa.array(packed, pa.binary())], ["block", "id", "packed"])

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = False,
                   block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, the kept bytes."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = text_total(docs)
    blocks, shards = count_of(total, block_bytes), count_of(total, shard_bytes)
    bits, size = min(64, max(32, total.bit_length() + 10)), name_size(total)
    low = id_blocks(docs.select("id"), blocks)

    spread = lambda rows: rows.repartition(shuffle_parts(df.sparkSession, 2 * shards), "kind", "shard").groupBy("kind", "shard")
    placed = docs.mapInArrow(placing(low), "block int, id long, packed binary").repartition(shuffle_parts(df.sparkSession, blocks), "block")
    at_home = placed.groupBy("block")
    first = at_home.applyInArrow(first_questions(window, bits, size, shards), _QUESTION)
    told = spread(first).applyInArrow(lambda t: answer(t), _ANSWER)
    second = at_home.cogroup(told.groupBy("block")).applyInArrow(second_questions(window, bits, size, shards), _QUESTION)
    more = spread(second).applyInArrow(lambda t: answer(t), _ANSWER)
    out = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    cut = at_home.cogroup(told.unionByName(more).groupBy("block")).applyInArrow(cutter(window, bits, size, with_text), out)
    return cut.withColumnRenamed("id", id_col)
