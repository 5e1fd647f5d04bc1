r"""Benchmark decontamination by the q-gram lemma and banded alignment.

A document is contaminated by a benchmark item when some ``SEGMENT`` bytes of
the item, from any start, occur in it within an edit budget. Texts are compared
as bytes with A-Z lower-cased and white-space runs as one space. A shorter item
counts as a whole, and a segment of m bytes may differ by
k = m * ``EDIT_PERCENT`` / 100 edits.

Within k edits a segment keeps at least m - Q + 1 - k * Q of its q-grams, and
they lie on diagonals (position in the document minus position in the item) at
most 2k + 1 apart. Shared q-grams are gathered per (document, item, diagonal
band); bands are twice that wide and overlap by half, so some band holds a whole
match. Every start whose segment holds as many q-grams of a band as the bound
asks is verified by aligning the segment with the band's region.

The benchmark is read in blocks of about ``BLOCK_BYTES`` (distinct items are
spread by hash), each a column over the documents in the same stage; documents
never move. At most ``PASS_BLOCKS`` blocks pass through the driver and the
workers together. A larger benchmark takes one pass over the documents for every
``PASS_BLOCKS`` blocks: a pass writes what it finds by text digest, and the
findings of all passes are joined to the documents, so memory does not depend on
the benchmark's size.

Defined results: NULL and empty texts match nothing; items that are NULL or
shorter than ``Q`` bytes once folded match nothing; equal items are reported
each under its own id; repeated rows are judged alike; an empty benchmark leaves
every document clean; a text or item of any length is compared whole. Only the
id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import U64, chunks, lower, stored, text_bytes

#: Gram length, segment length and edits allowed in percent of the segment.
Q, SEGMENT, EDIT_PERCENT = 12, 96, 5
#: Benchmark text of a block, and blocks held together by the driver and a worker.
BLOCK_BYTES, PASS_BLOCKS = 4 << 20, 8
_FILTER_BITS = 22
#: Starts in an item that are aligned together.
_TOGETHER = 64
#: Shared q-grams that are sorted at a time (of one text at least).
_HITS = 1 << 18


def folded(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts lower-cased with white-space runs as one space; their new offsets."""
    t = lower(b)
    t = np.where((t == 32) | ((t >= 9) & (t <= 13)), np.uint8(32), t)
    keep = np.ones(len(t), bool)
    keep[1:] = (t[1:] != 32) | (t[:-1] != 32)
    keep[offs[:-1][offs[:-1] < len(t)]] = True
    moved = np.concatenate([[0], np.cumsum(keep)])
    return t[keep], moved[offs]


def fold_text(text: str) -> bytes:
    """One text, folded."""
    b = np.frombuffer((text or "").encode(), np.uint8)
    return folded(b, np.array([0, len(b)]))[0].tobytes()


def qgrams(t: np.ndarray) -> np.ndarray:
    """64-bit code of the ``Q`` (9 to 16) bytes at every position."""
    if len(t) < Q:
        return np.zeros(0, U64)
    x = t.astype(U64)
    x = x[:-1] | (x[1:] << U64(8))
    x = x[:-2] | (x[2:] << U64(16))
    x = x[:-4] | (x[4:] << U64(32))
    n = len(t) - Q + 1
    with np.errstate(over="ignore"):
        return x[:n] * U64(0x9E3779B97F4A7C15) + (x[Q - 8:Q - 8 + n] ^ (x[Q - 8:Q - 8 + n] >> U64(29))) * U64(0xBF58476D1CE4E5B9)


def budget(m: int) -> int:
    """Edits allowed in a segment of m bytes, such that the lemma still demands a q-gram."""
    return max(0, min(m * EDIT_PERCENT // 100, (m - Q) // Q))


class Index:
    """Q-gram index of some benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        kept = [(item, t) for item, t in ((item, fold_text(text).strip(b" ")) for item, text in items) if len(t) >= Q]
        self.ids, self.texts = [item for item, _ in kept], [np.frombuffer(t, np.uint8) for _, t in kept]
        #: per item: its bytes, those of a segment, the edits allowed and the q-grams that must be left
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.size = np.minimum(self.length, SEGMENT)
        self.edits = np.array([budget(m) for m in self.size.tolist()], np.int64)
        self.bound = self.size - Q + 1 - self.edits * Q
        grams = [qgrams(t) for t in self.texts]
        codes = np.concatenate(grams) if grams else np.zeros(0, U64)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.first, self.count = np.unique(codes[order], return_index=True, return_counts=True)
        self.owner, self.place = owner[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.slot(self.codes)] = True

    def grid(self) -> list[tuple[int, bytes]]:
        """(item, segment) at every half segment and at the items' ends."""
        starts = [[0] if n <= SEGMENT else [*range(0, n - SEGMENT, SEGMENT // 2), n - SEGMENT] for n in self.length.tolist()]
        return [(i, t[s:s + SEGMENT].tobytes()) for i, t, some in zip(self.ids, self.texts, starts) for s in some]

    @property
    def items(self) -> list[int]:
        return [i for i, _ in self.grid()]

    @property
    def segments(self) -> list[bytes]:
        return [x for _, x in self.grid()]

    @staticmethod
    def slot(codes: np.ndarray) -> np.ndarray:
        return ((codes ^ (codes >> U64(31))) * U64(0xD6E8FEB86659FD93)) >> U64(64 - _FILTER_BITS)

    def matches(self, t: np.ndarray, offs: np.ndarray) -> dict[int, dict[int, int]]:
        """Per text number, the items found and the fewest edits of a segment of theirs."""
        found: dict[int, dict[int, int]] = {}
        if not len(self.codes):
            return found
        codes = qgrams(t)
        at = np.flatnonzero(self.filter[self.slot(codes)])
        u = np.searchsorted(self.codes, codes[at])
        u[u == len(self.codes)] = 0
        hit = self.codes[u] == codes[at]
        at, u = at[hit], u[hit]
        doc = np.searchsorted(offs, at, side="right") - 1
        whole = at + Q <= offs[doc + 1]
        at, u, doc = at[whole], u[whole], doc[whole]
        # whole texts, as many as bound their shared q-grams
        ends = np.cumsum(self.count[u])
        i = 0
        while i < len(at):
            j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _HITS, side="right"))
            j = int(np.searchsorted(doc, doc[min(j, len(at) - 1)])) if j < len(at) else j
            j = j if j > i else int(np.searchsorted(doc, doc[i], side="right"))
            found |= self.verified(t, offs, at[i:j], u[i:j], doc[i:j])
            i = j
        return found

    def verified(self, t: np.ndarray, offs: np.ndarray, at: np.ndarray, u: np.ndarray, doc: np.ndarray) -> dict[int, dict[int, int]]:
        """:meth:`matches` of the texts ``doc`` (ascending) that hold the codes ``u`` at ``at``."""
        found: dict[int, dict[int, int]] = {}
        n = self.count[u]
        member = np.repeat(self.first[u], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner, place, doc = self.owner[member], self.place[member], np.repeat(doc, n)
        band = (np.repeat(at, n) - place) // (2 * self.edits[owner] + 1)
        key = np.stack([np.concatenate([doc, doc]), np.concatenate([owner, owner]), np.concatenate([band, band - 1]), np.concatenate([place, place])])
        key = key[:, np.lexsort(key[::-1])]
        new = np.ones(key.shape[1], bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        key = key[:, new]
        new = np.ones(key.shape[1], bool)
        new[1:] = (key[:3, 1:] != key[:3, :-1]).any(axis=0)
        group = np.cumsum(new) - 1
        # as many q-grams as the bound from this one on, near enough for one segment
        owner, place = key[1], key[3]
        last = np.arange(len(group)) + self.bound[owner] - 1
        far = np.minimum(last, len(group) - 1)
        span = self.size[owner] - Q
        full = np.flatnonzero((far == last) & (group[far] == group) & (place[far] - place <= span))
        low = np.maximum(0, place[far[full]] - span[full])
        high = np.minimum(place[full], (self.length - self.size)[owner[full]])
        cut = np.flatnonzero(np.diff(group[full], prepend=-1))
        for i, j in zip(cut, np.append(cut[1:], len(full))):
            d, o, b = key[:3, full[i]].tolist()
            item, seen = self.ids[o], found.setdefault(d, {})
            if seen.get(item) == 0:
                continue
            k, m = int(self.edits[o]), int(self.size[o])
            w = 2 * k + 1
            starts = np.unique(np.concatenate([np.arange(x, y + 1) for x, y in zip(low[i:j], high[i:j])]))
            segments = np.lib.stride_tricks.sliding_window_view(self.texts[o], m)
            best = k + 1
            while len(starts) and best:
                some = starts[starts < starts[0] + _TOGETHER]
                starts = starts[len(some):]
                lo = int(some[0]) + b * w - k
                region = t[max(offs[d], lo):max(offs[d], min(offs[d + 1], int(some[-1]) + b * w + 2 * w + k + m))]
                best = min(best, nearest(segments[some], region, k))
            if best <= k:
                seen[item] = min(best, seen.get(item, best))
        return {d: x for d, x in found.items() if x}


def nearest(segments: np.ndarray, region: np.ndarray, limit: int) -> int:
    """Fewest edits that turn one of the segments (rows) into some part of the region; limit + 1 when more."""
    whole = region.tobytes()
    if any(s.tobytes() in whole for s in segments):
        return 0
    steps = np.arange(len(region) + 1, dtype=np.int32)
    row = np.zeros((len(segments), len(region) + 1), np.int32)
    for i in range(segments.shape[1]):
        nxt = row + 1
        np.minimum(nxt[:, 1:], row[:, :-1] + (region != segments[:, i:i + 1]), out=nxt[:, 1:])
        nxt[:, 0] = i + 1
        row = np.minimum.accumulate(nxt - steps, axis=1) + steps
        open_ = row.min(axis=1) <= limit
        if not open_.all():
            row, segments = row[open_], segments[open_]
            if not len(row):
                return limit + 1
    return int(row.min())


def aligned(segment: bytes, region: np.ndarray, limit: int) -> int:
    """Fewest edits that turn the segment into some part of the region; limit + 1 when more."""
    return nearest(np.frombuffer(segment, np.uint8)[None], region, limit)


def matches_of(items: list[tuple[int, str]], text: Column) -> Column:
    """What a text holds of these items: a struct items (ids, ascending) and edits (fewest)."""
    built: list[Index] = []  # one index a worker task

    def match(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(Index(items))
        raw, offs = text_bytes(texts)
        found: list[list[int]] = [[] for _ in range(len(texts))]
        edits: list[int | None] = [None] * len(texts)
        for lo, hi in chunks(offs):
            t, at = folded(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            for d, seen in built[0].matches(t, at).items():
                found[lo + d], edits[lo + d] = sorted(seen), min(seen.values())
        return pa.StructArray.from_arrays([pa.array(found, pa.list_(pa.int64())), pa.array(edits, pa.int64())], ["items", "edits"])

    return F.arrow_udf(match, "items array<long>, edits long")(text.cast("string"))


def item_blocks(benchmark: DataFrame, item_col: str, item_text: str, block_bytes: int) -> tuple[int, Callable[[int], list[tuple[int, str]]]]:
    """(number of blocks, reader of one block): the benchmark's distinct items, about ``block_bytes`` of text a block."""
    known = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("text is not null and item is not null").distinct()
    size = known.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = ceil(size / block_bytes * 1.5)

    def block(b: int) -> list[tuple[int, str]]:
        return [(r.item, r.text) for r in known.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()]  # one block

    return blocks, block


def united(items: list[Column], edits: list[Column]) -> Column:
    """One struct items (ids, ascending) and edits (fewest, NULL without) from several."""
    found = F.array_sort(F.array_distinct(F.concat(F.array().cast("array<long>"), *items)))
    return F.struct(found.alias("items"), F.array_min(F.array(F.lit(None).cast("long"), *edits)).alias("edits"))


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str, out: str, item_col: str = "item_id", item_text: str = "text",
                 block_bytes: int = BLOCK_BYTES, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """``docs`` with the struct ``out``: the benchmark's items in the text (ids, ascending) and the fewest edits (NULL without)."""
    blocks, block = item_blocks(benchmark, item_col, item_text, block_bytes)
    text = F.col(text_col).cast("string")

    def found(some: Iterable[int]) -> Column:
        parts = [matches_of(block(b), text) for b in some]
        return united([p["items"] for p in parts], [p["edits"] for p in parts])

    if blocks <= pass_blocks:
        return docs.withColumn(out, found(range(blocks)))
    digest = F.sha2(text, 256)
    passes = [stored(docs.select(digest.alias("digest"), found(range(b, min(b + pass_blocks, blocks))).alias("found"))
                     .where(F.size("found.items") > 0).dropDuplicates(["digest"]), f"matches-{b}") for b in range(0, blocks, pass_blocks)]
    every = reduce(DataFrame.unionAll, passes).groupBy(F.col("digest").alias("__digest")).agg(
        F.flatten(F.collect_list("found.items")).alias("__items"), F.min("found.edits").alias("__edits"))
    joined = docs.withColumn("__text_digest", digest).join(every, F.col("__text_digest") == F.col("__digest"), "left")
    items = F.coalesce("__items", F.array().cast("array<long>"))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), united([items], [F.col("__edits")]).alias(out))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """One row per document: id, contaminated, n_items, items (ids found), edits (fewest, NULL when clean)."""
    narrow = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    found = with_matches(narrow, benchmark, "__text", "__found", item_col, item_text, block_bytes, pass_blocks)
    return found.select(id_col, (F.size("__found.items") > 0).alias("contaminated"), F.size("__found.items").cast("long").alias("n_items"), "__found.items", "__found.edits")
