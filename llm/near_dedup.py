r"""Near duplicates by an LSH forest over MinHash signatures.

A document's set holds its distinct five-word shingles (words lower-cased A-Z,
split at ASCII white space; a shorter text is one shingle). Documents whose
sets have Jaccard similarity of 0.75 or more are linked; a component is what
links reach.

1. Documents with the same set are one class; its smallest id stands for it.
   Everything below works on classes, so copies cost one row each.
2. The forest: ``TREES`` orders, each sorting all classes by its own sequence of
   minima. Sorting is a range partitioning on the whole key (minima, sketch,
   id), so no prefix, however common, has to fit one task. Candidates are the
   neighbours in an order whose longest common prefix is at least ``DEPTH``
   minima. Where a prefix region is small, all its pairs lie within the
   neighbour window and ``DEPTH`` decides alone; where it is dense, the order
   itself puts the rows with the longest common prefix side by side, so the
   depth that counts grows with the density of the region. A sketch carried in
   the rows discards pairs far below the limit.
3. Candidates are confirmed on the full sets, recomputed from the texts.
   Candidate clusters are split into chunks of bounded size and a pair goes to
   the cell of its two chunks, so a text travels once per cell that needs it
   and no cell grows with its cluster.
4. Clusters larger than the window are sorted once more, with a wide window
   between what is not yet linked and a longer sketch, and confirmed likewise.
   This only saves work in the next step.
5. Dense regions (a prefix of ``DEPTH`` minima with more classes than a row and
   its window) are completed exactly. All their classes, clustered or not, meet
   in a prefix-filter join: with the shingles of every set in one order, rare
   ones first, a pair at the limit has its first common shingle early in both
   sets, and what follows it must suffice for the limit. Shingles whose classes
   are all linked already need no pairs; frequent ones are split into cells.
   Shingles are counted over all these classes: blocks of texts ask the shards
   of the shingles' hashes. Any order would give all pairs; the counts only
   decide how many are looked at, and a shingle of one class makes none.
6. Confirmed links give components by contraction.

With similarity at the limit a pair shares the region of no order with a
probability of (1 - 0.75**2)**32, less than one in a hundred thousand million.
The sketch of a sparse region misses such a pair with less than one in a million.

Defined results: NULL and empty texts, and texts without words, have no
shingles and are linked with nothing; a row with a NULL id takes the component
of its class, NULL when the class has no id, and is kept only then; rows that
repeat an id are one document; of equal sets the smallest id stands for all; a
text of any length is compared whole; an empty table gives an empty result. Only
the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import asked, by_hash, count_of, merged, runs, text_total
from llm.common import CHUNK_BYTES, U64, chunks, mix, pack_counts, pack_sorted, shingle_sets, shuffle_parts, stored, text_bytes, unpack_counts
from llm.graph import components, joined

#: Shingle words; similarity limit in percent.
WORDS, PERCENT = 5, 75
#: Minima that make keys, orders, minima of an order's key, least common prefix.
MINIMA, TREES, KEY, DEPTH = 64, 32, 12, 2
#: Neighbours on each side, minima of a signature and least agreeing sketch positions: of all classes, then of dense
#: clusters. A pair at the limit agrees in 48 of 64 positions (standard deviation 3.5; under 30 about once in some
#: millions), or in 192 of 256 (6.9).
FIRST, WIDE = (2, 64, 30), (24, 256, 171)
#: A chunk of a candidate cluster: documents and shingles at most (on average).
CHUNK_DOCS, CHUNK_SHINGLES = 128, 400_000
#: Completion: text of a block, and text per shard of the counts; classes of a shingle from which it is split, pairs made at a time.
BLOCK_BYTES, SHARD_BYTES = 4 << 20, 16 << 20
SPLIT_ROWS, PAIRS = 2_000, 1 << 20

_MULTIPLY = mix(np.arange(1, WIDE[1] + 1, dtype=U64)) | U64(1)
_XOR = mix(np.arange(1001, 1001 + WIDE[1], dtype=U64))


def tree_positions() -> np.ndarray:
    """Which minima form each order's key: first pairs are disjoint, the rest is spread."""
    rng = np.random.default_rng(20)
    first = rng.permutation(MINIMA)[:TREES * DEPTH].reshape(TREES, DEPTH)
    rest = [rng.permutation(np.setdiff1d(np.arange(MINIMA), f))[:KEY - DEPTH] for f in first]
    return np.concatenate([first, np.array(rest)], axis=1)


def minima(sets: list[np.ndarray], many: int) -> np.ndarray:
    """(len(sets), many) uint32 minima of non-empty sets."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.empty((len(sets), many), np.uint32)
    for k in range(many):
        out[:, k] = np.minimum.reduceat((values ^ _XOR[k]) * _MULTIPLY[k], starts) >> U64(32)
    return out


def signer(size: int, many: int) -> Callable:
    """Task function: (id, text) in; id, n_shingles, two set hashes and the minima out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_bytes(batch.column(1))
            for lo, hi in chunks(offs):
                sets = shingle_sets(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], size)
                n = np.array([len(s) for s in sets])
                h1 = [int(mix(s).sum(dtype=U64).astype(np.int64)) for s in sets]
                h2 = [int(mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64).astype(np.int64)) for s in sets]
                full = np.flatnonzero(n)
                sig: list[bytes | None] = [None] * len(sets)
                if len(full):
                    rows = minima([sets[i] for i in full], many).astype(">u4")
                    for i, r in zip(full, rows):
                        sig[i] = r.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                                                  pa.array(h2, pa.int64()), pa.array(sig, pa.binary())], ["id", "n", "h1", "h2", "sig"])

    return run


def planted(many: int) -> Callable:
    """Task function: classes in, a row per order and class out: key, sketch, id, root.

    The key is the order's number, its first ``DEPTH`` minima whole and sixteen
    bits of each further one, as bytes that sort like the sequence.
    """
    positions = tree_positions()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(n, many)
            low = (sig & 15).astype(np.uint8)
            sketch = (low[:, 0::2] << 4) | low[:, 1::2]
            marks = pa.array([r.tobytes() for r in sketch], pa.binary())
            for t, p in enumerate(positions):
                head = np.ascontiguousarray(sig[:, p[:DEPTH]]).view(np.uint8).reshape(n, -1)
                tail = np.ascontiguousarray((sig[:, p[DEPTH:]] & 0xFFFF).astype(">u2")).view(np.uint8).reshape(n, -1)
                keys = np.concatenate([np.full((n, 1), t, np.uint8), head, tail], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary()), marks, batch.column(0), batch.column(2)],
                                                 ["key", "sketch", "id", "root"])

    return run


_REGION = 1 + 4 * DEPTH
_ONES = np.array([int(x >> 4 == 0) + int(x & 15 == 0) for x in range(256)], np.uint8)
_FOREST = "a long, b long, border int, place int, key binary, sketch binary, id long, root long"
_ROW = ["key", "sketch", "id", "root"]


def region_starts(key: np.ndarray) -> np.ndarray:
    """For sorted keys, the number of the first row of each row's region."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]).any(axis=1)
    return np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))


def crowded(table: pa.Table, window: int) -> np.ndarray:
    """Ids of sorted rows that lie in a region of more than ``window + 1`` rows."""
    n = table.num_rows
    key = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint8).reshape(n, -1)[:, :_REGION]
    far = np.flatnonzero(region_starts(key)[window + 1:] <= np.arange(max(0, n - window - 1)))
    return np.unique(table.column("id").to_numpy()[np.unique(far[:, None] + np.arange(window + 2))])


def neighbours(table: pa.Table, window: int, agree: int) -> np.ndarray:
    """Pairs of sorted rows up to ``window`` apart in one region, of different roots, whose sketches agree: (2, n) ids."""
    n = table.num_rows
    ids, root = table.column("id").to_numpy(), table.column("root").to_numpy()
    key = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint8).reshape(n, -1)[:, :_REGION]
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(n, -1)
    first = region_starts(key)
    found = [np.zeros((2, 0), np.int64)]
    for d in range(1, min(window, n - 1) + 1):
        i = np.flatnonzero((first[d:] <= np.arange(n - d)) & (root[d:] != root[:-d]))
        i = i[_ONES[sketch[i] ^ sketch[i + d]].sum(axis=1) >= agree]
        x, y = ids[i], ids[i + d]
        found.append(np.stack([np.minimum(x, y), np.maximum(x, y)])[:, x != y])
    return np.concatenate(found, axis=1)


def forest(window: int, agree: int) -> Callable:
    """Task function: candidates and crowded ids (``a`` without ``b``) of one sorted partition, and its first and last rows for the borders.

    Batches are joined with the last rows before them, so memory is a batch,
    whatever the partition holds.
    """

    def border(rows: pa.Table, which: int, place: int) -> pa.RecordBatch:
        n = rows.num_rows
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, pa.array(np.full(n, which, np.int32)), pa.array(np.arange(place, place + n, dtype=np.int32)),
                                           *(rows.column(c).combine_chunks() for c in _ROW)], ["a", "b", "border", "place", *_ROW])

    def pairs(found: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(found.shape[1], t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1]), *none], ["a", "b", "border", "place", *_ROW])

    def alone(ids: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(ids), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(ids), *none], ["a", "b", "border", "place", *_ROW])

    reach = window + 1  # a region is crowded when two rows this far apart are in it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get().partitionId()
        held: pa.Table | None = None
        begun = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).select(_ROW)
            if begun < reach:
                head = table.slice(0, reach - begun)
                yield border(head, me - 1, reach + begun)
                begun += head.num_rows
            if held is not None:
                table = pa.concat_tables([held, table])
            yield pairs(neighbours(table, window, agree))
            yield alone(crowded(table, window))
            held = table.slice(max(0, table.num_rows - reach))
        if held is not None:
            yield border(held, me, 0)

    return run


def across(window: int, agree: int) -> Callable:
    """Border function: candidates and crowded ids between the last rows of a partition and the first of the next."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        found, ids = neighbours(table, window, agree), crowded(table, window)
        a, b = pa.array(np.concatenate([found[0], ids]), pa.int64()), pa.array(found[1], pa.int64())
        return pa.table({"a": a, "b": pa.concat_arrays([b, pa.nulls(len(ids), pa.int64())])})

    return run


def confirmer(size: int, percent: int) -> Callable:
    """Cell function: texts and candidate pairs in, pairs that reach the limit out."""

    def run(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        raw, offs = text_bytes(texts.column("text"))
        ids = texts.column("id").to_pylist()
        sets: dict[int, np.ndarray] = {}
        for lo, hi in chunks(offs, CHUNK_BYTES):
            sets.update(zip(ids[lo:hi], shingle_sets(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], size)))
        out = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                out.append((a, b))
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return run


def candidates(classes: DataFrame, window: int, many: int, agree: int) -> tuple[DataFrame, DataFrame]:
    """Stored distinct candidate pairs (a < b) of class rows (id, sig, root), and the ids in crowded regions.

    Ends of one root are no pair.
    """
    rows = classes.mapInArrow(planted(many), "key binary, sketch binary, id long, root long")
    # a border joins two partitions, so none may be smaller than the window: eight times that on average
    n = max(1, min(shuffle_parts(classes.sparkSession), TREES * classes.count() // (8 * (window + 1))))
    order = ["key", "sketch", "id"]
    raw = stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(forest(window, agree), _FOREST), "forest")
    inside = raw.where("a is not null").select("a", "b")
    between = raw.where("border is not null").groupBy("border").applyInArrow(across(window, agree), "a long, b long")
    found = stored(inside.unionByName(between).distinct(), "candidates")
    return found.where("b is not null"), found.where("b is null").select(F.col("a").alias("id"))


def confirmed(pairs: DataFrame, clusters: DataFrame, texts: DataFrame, sizes: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Stored pairs that reach the limit on their full sets.

    ``clusters`` is (node, root) with the ends of every pair under one root,
    ``texts`` (id, text), ``sizes`` (id, n): the shingles of each class.
    """
    weigh = clusters.join(sizes.select(F.col("id").alias("node"), "n"), "node", "left")
    heavy = weigh.groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("docs") / CHUNK_DOCS, F.col("shingles") / CHUNK_SHINGLES, F.lit(1.0)))
    heavy = stored(heavy.select("root", parts.alias("parts")), "clusters")
    nodes = stored(clusters.join(heavy, "root").select("node", "root", "parts"), "cluster-nodes")
    chunk = lambda c: F.pmod(F.xxhash64(c), "parts")
    cells = pairs.join(nodes, pairs.a == nodes.node)
    cells = stored(cells.select("a", "b", F.struct("root", F.least(chunk("a"), chunk("b")).alias("x"), F.greatest(chunk("a"), chunk("b")).alias("y")).alias("cell")), "cells")
    needed = cells.select(F.col("a").alias("id"), "cell").unionByName(cells.select(F.col("b").alias("id"), "cell")).distinct()
    at = texts.join(stored(needed, "needed").hint("merge"), "id").select("cell", "id", "text")
    return stored(at.groupBy("cell").cogroup(cells.groupBy("cell")).applyInArrow(confirmer(size, percent), "a long, b long"), "links")


def text_sets(texts: pa.ChunkedArray, size: int) -> list[np.ndarray]:
    """The shingle set of every text."""
    raw, offs = text_bytes(texts)
    return [s for lo, hi in chunks(offs) for s in shingle_sets(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], size)]


def counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of some sets, and how many sets have each."""
    every = np.sort(np.concatenate(sets))
    start = runs(every) if len(every) else np.zeros(0, np.int64)
    return every[start], np.diff(np.append(start, len(every)))


_COUNTS = "shard int, block int, keys binary, counts binary"
_TOTALS = "shard int, block int, counts binary"


def asker(size: int, shards: int) -> Callable:
    """Block function: texts in, the block's shingles and their counts in it out, a row per shard."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shingles, n = counted(text_sets(table.column("text"), size))
        rows = [(shard, key[0].as_py(), pack_sorted(shingles[lo:hi]), pack_counts(n[lo:hi])) for shard, lo, hi in asked(shingles, shards)]
        cols = list(zip(*rows)) or [()] * 4
        return pa.table({n: pa.array(c, kind) for n, c, kind in zip(("shard", "block", "keys", "counts"), cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))})

    return run


def totals(rows: pa.Table) -> pa.Table:
    """Shard function: per block, the counts over all blocks of the shingles it has."""
    keys, _, order = merged(rows.column("keys").to_pylist())
    parts = [unpack_counts(c) for c in rows.column("counts").to_pylist()]
    start = runs(keys[order])
    total = np.add.reduceat(np.concatenate(parts)[order], start)
    back = np.empty(len(keys), np.int64)
    back[order] = np.repeat(total, np.diff(np.append(start, len(keys))))
    cut = np.cumsum([len(p) for p in parts])[:-1]
    return pa.table({"shard": rows.column("shard"), "block": rows.column("block"), "counts": pa.array([pack_counts(x) for x in np.split(back, cut)], pa.binary())})


_PREFIX = "shingle long, hot boolean, id long, n long, rest long, root long"


def prefixes(size: int, percent: int) -> Callable:
    """Block function: (id, text, root) and the totals in, the shingles out that can be the first one a pair at the limit shares.

    Shingles stand in the order of their counts, then of their hashes. ``rest``
    counts those from this one on. A shingle that no other class has is left out.
    """

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        sets = text_sets(table.column("text"), size) if table.num_rows else [np.zeros(0, U64)]
        shingles, _ = counted(sets)
        seen = np.concatenate([np.zeros(0, np.int64), *(unpack_counts(c) for c in told.sort_by("shard").column("counts").to_pylist())])
        if len(seen) != len(shingles):
            raise ValueError(f"{len(seen)} counts for {len(shingles)} shingles")
        out = []
        for i, found in enumerate(sets):
            n = len(found)
            count = seen[np.searchsorted(shingles, found)]
            order = np.lexsort((found, count))
            rest = n - np.arange(n)
            use = (100 * rest >= percent * n) & (count[order] > 1)
            order, rest = order[use], rest[use]
            out.append((found[order].view(np.int64), count[order] >= SPLIT_ROWS, np.full(len(order), i), np.full(len(order), n), rest))
        shingle, hot, row, n, rest = (np.concatenate(c) for c in zip(*out))
        return pa.table({"shingle": shingle, "hot": hot, "id": table.column("id").take(pa.array(row)), "n": n, "rest": rest, "root": table.column("root").take(pa.array(row))})

    return run


_CELL = ["shingle", "x", "y"]


def met(table: pa.Table, percent: int) -> Iterator[np.ndarray]:
    """Pairs (2, n) of ids in one cell, of different roots, that can still reach the limit; rows are sorted by cell and n.

    A set of n shingles with ``rest`` of them left shares at most that many, so
    its partner has at most ``rest * (100 + percent) / percent - n``.
    """
    cell = np.stack([table.column(c).to_numpy() for c in _CELL])
    new = np.ones(cell.shape[1], bool)
    new[1:] = (cell[:, 1:] != cell[:, :-1]).any(axis=0)
    start = np.flatnonzero(new)
    roots = table.column("root").to_numpy()
    open_ = np.minimum.reduceat(roots, start) < np.maximum.reduceat(roots, start)
    run = np.cumsum(new) - 1
    at = np.flatnonzero(open_[run])
    ids, n, rest = (table.column(c).to_numpy()[at] for c in ("id", "n", "rest"))
    roots, run = roots[at], run[at]
    most = rest * (100 + percent) // percent - n
    place = (run << 40) + n
    small = np.flatnonzero(most >= n)  # the smaller set of a pair
    lo = np.searchsorted(place, place[small], side="left")
    hi = np.searchsorted(place, (run[small] << 40) + most[small], side="right")
    ends = np.cumsum(hi - lo)
    i = 0
    while i < len(small):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, side="right")))
        many = (hi - lo)[i:j]
        y = np.repeat(small[i:j], many)
        x = np.repeat(lo[i:j] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        fits = (roots[x] != roots[y]) & (most[x] >= n[y]) & (ids[x] != ids[y])
        x, y = ids[x[fits]], ids[y[fits]]
        yield np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
        i = j


def meet(percent: int) -> Callable:
    """Task function: prefix rows sorted by cell and n in, pairs out. A cell is held until its last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for a, b in met(table, percent) if table.num_rows else ():
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            cell = np.stack([table.column(c).to_numpy() for c in _CELL])
            last = int(np.argmax((cell == cell[:, -1:]).all(axis=0)))  # where the last cell of the batch begins
            if held and last == 0 and all(held[-1].column(c)[-1] == table.column(c)[0] for c in _CELL):
                held.append(table)
                continue
            yield from out(pa.concat_tables([*held, table.slice(0, last)]))
            held = [table.slice(last)]
        if held:
            yield from out(pa.concat_tables(held))

    return run


def completion(texts: DataFrame, roots: DataFrame, size: int = WORDS, percent: int = PERCENT,
               block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stored pairs (a < b) of different roots, all that reach the limit among them, of the classes ``texts`` (id, text).

    ``roots`` (node, root) is what is linked.
    """
    total = text_total(texts)
    blocks, shards = count_of(total, block_bytes), count_of(total, shard_bytes)
    parts = shuffle_parts(texts.sparkSession, blocks)
    named = texts.join(roots.select(F.col("node").alias("id"), "root").hint("merge"), "id", "left").select("id", "text", F.coalesce("root", "id").alias("root"))
    placed = named.withColumn("block", by_hash(blocks, "id")).repartition(parts, "block").groupBy("block")
    told = placed.applyInArrow(asker(size, shards), _COUNTS).groupBy("shard").applyInArrow(lambda t: totals(t), _TOTALS)
    rows = stored(placed.cogroup(told.groupBy("block")).applyInArrow(prefixes(size, percent), _PREFIX), "prefixes")
    cold = rows.where("not hot").select("shingle", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "id", "n", "rest", "root")
    smaller = F.col("rest") * (100 + percent) >= 2 * percent * F.col("n")
    hot = rows.where("hot").groupBy("shingle").agg(F.count(F.lit(1)).alias("rows"), F.max(smaller).alias("use"), F.min("root").alias("low"), F.max("root").alias("high"))
    hot = stored(hot.where("use and low < high").select("shingle", F.ceil(F.col("rows") / SPLIT_ROWS).alias("parts")), "frequent")
    own = F.pmod(F.xxhash64("id"), "parts")
    split = rows.where("hot").join(hot, "shingle").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    split = split.select("shingle", F.least(own, "other").alias("x"), F.greatest(own, "other").alias("y"), "id", "n", "rest", "root")
    cells = cold.unionByName(split).repartition(shuffle_parts(texts.sparkSession), *_CELL).sortWithinPartitions(*_CELL, "n")
    return stored(cells.mapInArrow(meet(percent), "a long, b long").distinct(), "candidates")


_SIGNED = "id long, n long, h1 long, h2 long, sig binary"


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept. Ids are integers."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(docs.mapInArrow(signer(size, FIRST[1]), _SIGNED), "signatures")
    key = ["h1", "h2", "n"]
    heads = stored(signed.where("n > 0").groupBy(*key).agg(F.min("id").alias("head")), "classes")
    # sets of one or two shingles reach the limit only with themselves
    lead = signed.where("n > 2").join(heads.select(F.col("head").alias("id")).distinct(), "id", "left_semi")
    lead = stored(lead.groupBy("id").agg(F.max_by("sig", "n").alias("sig"), F.max("n").alias("n")), "heads")
    sizes = lead.select("id", "n")
    pairs, crowd = candidates(lead.select("id", "sig", F.col("id").alias("root")), *FIRST)
    clusters = components(pairs)
    # a merge join at every size: the list of ids grows with the input, so it is not broadcast
    needed = clusters.select(F.col("node").alias("id")).unionByName(crowd).distinct()
    texts = stored(docs.join(needed.hint("merge"), "id", "left_semi"), "texts")
    links = confirmed(pairs, clusters, texts, sizes, size, percent)

    # clusters larger than the window: neighbours farther off, across what is linked so far
    dense = clusters.join(clusters.groupBy("root").count().where(F.col("count") > FIRST[0] + 1), "root", "left_semi")
    reached = components(links)
    linked = reached.select(F.col("node").alias("id"), F.col("root"))
    wide = texts.join(dense.select(F.col("node").alias("id")), "id", "left_semi").mapInArrow(signer(size, WIDE[1]), _SIGNED)
    wide = wide.groupBy("id").agg(F.max_by("sig", "n").alias("sig")).join(linked, "id", "left")
    wide = stored(wide.select("id", "sig", F.coalesce("root", "id").alias("root")), "dense")
    tried = stored(candidates(wide, *WIDE)[0].join(pairs, ["a", "b"], "left_anti"), "candidates")
    reached = joined(reached, confirmed(tried, components(tried), texts, sizes, size, percent))

    # dense regions: every pair that is left
    left = completion(texts.join(crowd.hint("merge"), "id", "left_semi"), reached, size, percent)
    left = stored(left.join(pairs.unionByName(tried), ["a", "b"], "left_anti"), "candidates")
    reached = joined(reached, confirmed(left, components(left), texts, sizes, size, percent))
    named = heads.join(reached.select(F.col("node").alias("head"), "root"), "head", "left")
    named = stored(named.select(*key, F.coalesce("root", "head").alias("component_id")), "components")
    found = signed.select("id", *key).join(named, key, "left")
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                        F.col("id").eqNullSafe(own).alias("kept"))
