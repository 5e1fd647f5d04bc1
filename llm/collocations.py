r"""Phrase collocations mined with weighted acyclic automata.

The counts of all phrases form one automaton: a state is a phrase, its weight
the phrase's count, its arcs the next words. It is built one length at a time,
and only from states that can still reach the least count:

* A shard is some megabytes of one language's text. Its words are coded, and
  the sorted phrases of the current length give the shard's count transducer:
  arcs (for words the word; else the state of the phrase without its last word
  and that without its first) in order, each with a weight.
* The transducers are cut at prefix ranges: words at even slices of their hash,
  longer phrases at quantiles of all shards' arcs, so a range holds a bounded
  number of arcs however uneven the prefixes are. Each range unites its pieces
  and sums the weights. Arcs that reach the least count become states, numbered
  without gaps.
* Each shard gets the new states of its own arcs back and rewrites its text as
  the states that begin at each word. A phrase is only counted where both its
  parts are states, which loses nothing: a part is at least as frequent.

A state knows its parent (all but the last word) and its suffix state (all but
the first). Composing the two links looks up the count of every first part and
every rest of a phrase, with joins between consecutive lengths.

A-Z are lower-cased; texts are cut at ``[.,;:!?\x0A-\x0D]`` into pieces and
those into words ``[^\x20\x09]+``. Words are
compared as strings and states are numbers, so counts are exact; scores are computed in 38-digit decimals and are
exact while a count times 1000 stays below 10^19 and n below 10^18.

Defined results: a NULL text is empty and a NULL lang is ``und``; texts without
words add nothing; very long texts are cut between pieces, so a task holds one
piece at least and a shard otherwise; repeated rows count as often as they
occur; ties in the ranking are settled by the phrase's bytes; an empty table,
or one in which nothing is frequent, gives an empty result. Only the text and
lang columns are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.blocks import count_of, merged, runs
from llm.common import U64, lower, pack_counts, pack_sorted, prefix_sums, shuffle_parts, span_hash, stored, text_bytes, unpack_counts, unpack_sorted

#: Longest phrase, least count, phrases reported per language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Text of a shard, arcs of a prefix range (words: a quarter), arcs between two that are sampled for the borders.
SHARD_BYTES, RANGE_ARCS, EVERY = 6 << 20, 1 << 20, 1 << 10
UNKNOWN = "und"

_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_KIND = np.zeros(256, np.uint8)  # 0 word, 1 blank, 2 end of a piece
_KIND[[9, 32]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2


# --------------------------------------------------------------------- streams

def squeezed(stream: np.ndarray) -> bytes:
    """A stream of states (-1: none) as compressed byte planes."""
    a = (stream + 1).astype("<u8")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    """Inverse of :func:`squeezed`."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :data[0]] = planes.T
    return wide.view("<u8").ravel().astype(np.int64) - 1


def thinned(stream: np.ndarray) -> np.ndarray:
    """Only states with a state beside them, and one -1 between two runs of them."""
    on = stream >= 0
    beside = np.zeros(len(on), bool)
    beside[1:] |= on[:-1]
    beside[:-1] |= on[1:]
    a = np.where(on & beside, stream, -1)
    keep = a >= 0
    keep[1:] |= a[:-1] >= 0
    return a[keep]


def hashed(words: pa.Array) -> np.ndarray:
    """Hash of each word's bytes, which only deals words to ranges."""
    raw, offs = text_bytes(words)
    raw, offs = raw[offs[0]:offs[-1]], offs - offs[0]
    with np.errstate(over="ignore"):
        return span_hash(prefix_sums(raw), offs[:-1], offs[1:])


def coded(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """(distinct words by hash, their numbers in text order with -1 between pieces)."""
    b = lower(np.frombuffer(text, np.uint8))
    kind = _KIND[b]
    solid = kind == 0
    edge = np.diff(solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    del edge
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(b[solid])]).dictionary_encode()
    del solid, offsets, ends
    words = found.dictionary.cast(pa.large_string())
    order = np.argsort(hashed(words), kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    ended = np.flatnonzero(kind == 2)
    piece = np.searchsorted(ended, starts)
    return words.take(pa.array(order)), np.insert(number[found.indices.to_numpy(zero_copy_only=False)], np.flatnonzero(piece[1:] != piece[:-1]) + 1, -1)


def cuts(text: bytes, limit: int) -> Iterator[bytes]:
    """A text in parts of about ``limit`` bytes, cut between pieces."""
    while len(text) > limit and (m := _BREAK.search(text, limit)):
        yield text[:m.start()]
        text = text[m.end():]
    yield text


def sharder(limit: int) -> Callable:
    """Task function: (lang, text) rows in, shards out."""

    def shard(lang: str, parts: list[bytes]) -> pa.RecordBatch:
        words, stream = coded(b"\n".join(parts))
        counts = np.bincount(stream[stream >= 0], minlength=len(words))
        one = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.ListArray.from_arrays(one, words.cast(pa.string())), pa.ListArray.from_arrays(one, pa.array(counts, pa.int64())),
             pa.array([int(counts.sum())], pa.int64()), pa.array([squeezed(stream)], pa.binary())], ["lang", "words", "counts", "tokens", "stream"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            raw, offs = text_bytes(batch.column(1))
            for lang, lo, hi in zip(batch.column(0).to_pylist(), offs[:-1], offs[1:]):
                for part in cuts(raw[lo:hi].tobytes(), limit):
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part) + 1
                    # whatever the number of languages, a task holds little more than two shards
                    while size[lang] > limit or sum(size.values()) > 2 * limit:
                        full = max(size, key=lambda k: size[k])
                        size.pop(full)
                        yield shard(full, held.pop(full))
                        size.setdefault(lang, 0)
                        held.setdefault(lang, [])
        for lang, parts in held.items():
            if parts:
                yield shard(lang, parts)

    return run


# ----------------------------------------------------------- states and lengths

def offset(rows: DataFrame, sizes: DataFrame, part: str) -> DataFrame:
    """``rows`` with ``before``, the summed sizes of the earlier parts (a row a part, so one window holds them)."""
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(sizes.select(part, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")), part)


def arcs(stream: np.ndarray, states: int) -> np.ndarray:
    """Arc at each place of the stream where two states follow each other, as one number; -1 elsewhere."""
    a, b = stream[:-1], stream[1:]
    return np.where((a >= 0) & (b >= 0), a * states + b, -1)


def transducer(states: int) -> Callable:
    """Task function: the sorted arcs of each shard with their weights, and a sample of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, stream in zip(batch.column(0), batch.column(1)):
                a = arcs(unsqueezed(stream.as_py()), states)
                keys, weights = np.unique(a[a >= 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()], pa.int64()), pa.array([pack_sorted(keys.astype(U64))], pa.binary()), pa.array([pack_counts(weights)], pa.binary()),
                     pa.array([len(keys)], pa.int64()), pa.array([keys[::EVERY].tolist()], pa.list_(pa.int64()))], ["shard", "keys", "weights", "arcs", "sample"])

    return run


def ranges(borders: np.ndarray) -> Callable:
    """Task function: each shard's transducer cut at the borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, k, w in zip(*(batch.column(c) for c in range(3))):
                keys, weights = unpack_sorted(k.as_py()), unpack_counts(w.as_py())
                cut = [0, *np.searchsorted(keys, borders).tolist(), len(keys)]
                rows = [(r, shard.as_py(), pack_sorted(keys[lo:hi]), pack_counts(weights[lo:hi])) for r, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])) if hi > lo]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                                     ["range", "shard", "keys", "weights"])

    return run


def union(least: int) -> Callable:
    """Group function of a range: its pieces united, weights summed.

    One row per piece tells its shard the new state of each arc (a number from
    0 in the range, -1 for none); the row without a shard holds the states.
    """

    def run(rows: pa.Table) -> pa.Table:
        keys, _, order = merged(rows.column("keys").to_pylist())
        parts = [unpack_counts(w) for w in rows.column("weights").to_pylist()]
        keys, weights = keys[order], np.concatenate(parts)[order]
        start = runs(keys)
        total = np.add.reduceat(weights, start)
        kept = total >= least
        number = np.where(kept, np.cumsum(kept) - 1, -1)
        back = np.empty(len(keys), np.int64)
        back[order] = np.repeat(number, np.diff(np.append(start, len(keys))))
        answers = [squeezed(x) for x in np.split(back, np.cumsum([len(p) for p in parts])[:-1])]
        size = int(kept.sum())
        return pa.table({"range": pa.array([rows.column("range")[0].as_py()] * (len(parts) + 1), pa.int64()),
                         "shard": pa.array([*rows.column("shard").to_pylist(), None], pa.int64()),
                         "states": pa.array([*answers, pack_sorted(keys[start][kept])], pa.binary()),
                         "weights": pa.array([None] * len(parts) + [pack_counts(total[kept])], pa.binary()),
                         "size": pa.array([size] * (len(parts) + 1), pa.int64())})

    return run


_UNITED = "range long, shard long, states binary, weights binary, size long"
_WORDS_UNITED = "range long, shard long, states binary, langs array<string>, words array<string>, counts array<long>, size long"


def word_ranges(count: int) -> Callable:
    """Task function: each shard's words cut at even slices of their hash."""
    borders = np.array([(k << 64) // count for k in range(1, count)], U64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, counts = batch.column(2)[i].values, batch.column(3)[i].values
                if words is None or not len(words):
                    continue
                cut = [0, *np.searchsorted(hashed(words), borders).tolist(), len(words)]
                spans = [(r, lo, hi) for r, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])) if hi > lo]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _, _ in spans], pa.int64()), batch.column(0)[i:i + 1].take(pa.array([0] * len(spans))),
                     batch.column(1)[i:i + 1].take(pa.array([0] * len(spans))),
                     pa.array([words[lo:hi] for _, lo, hi in spans], pa.list_(words.type)), pa.array([counts[lo:hi] for _, lo, hi in spans], pa.list_(pa.int64()))],
                    ["range", "shard", "lang", "words", "counts"])

    return run


def word_union(least: int) -> Callable:
    """Group function of a range of words; rows as :func:`union` gives them, the states as words."""

    def run(rows: pa.Table) -> pa.Table:
        lists = rows.column("words").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy()
        words = lists.flatten()
        langs = rows.column("lang").combine_chunks().take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        # a word has no tab, so the pair can be told from its joined form
        joined = pc.binary_join_element_wise(langs.cast(pa.large_string()), words.cast(pa.large_string()), pa.scalar("\t", pa.large_string())).dictionary_encode()
        owner = joined.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(owner, kind="stable")
        start = runs(owner[order])
        total = np.add.reduceat(rows.column("counts").combine_chunks().flatten().to_numpy()[order], start)
        kept = total >= least
        number = np.where(kept, np.cumsum(kept) - 1, -1)[owner]
        answers = [squeezed(x) for x in np.split(number, np.cumsum(sizes)[:-1])]
        one = pa.array(order[start][kept])
        n, size = len(sizes) + 1, int(kept.sum())
        return pa.table({"range": pa.array([rows.column("range")[0].as_py()] * n, pa.int64()),
                         "shard": pa.array([*rows.column("shard").to_pylist(), None], pa.int64()),
                         "states": pa.array([*answers, None], pa.binary()),
                         "langs": pa.array([None] * (n - 1) + [langs.take(one).to_pylist()], pa.list_(pa.string())),
                         "words": pa.array([None] * (n - 1) + [words.take(one).to_pylist()], pa.list_(pa.string())),
                         "counts": pa.array([None] * (n - 1) + [total[kept].tolist()], pa.list_(pa.int64())),
                         "size": pa.array([size] * n, pa.int64())})

    return run


def listed(states: int) -> Callable:
    """Task function: the states of a range as rows state, parent, suffix, f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, k, w in zip(*(batch.column(c).to_pylist() for c in range(3))):
                keys = unpack_sorted(k).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(before + np.arange(len(keys))), pa.array(keys // states), pa.array(keys % states), pa.array(unpack_counts(w))],
                                                 ["state", "parent", "suffix", "f"])

    return run


def renamed(answers: pa.Table) -> np.ndarray:
    """The new state of each of a shard's arcs in order, from the answers of the ranges."""
    answers = answers.sort_by("range")
    parts = [np.where((x := unsqueezed(s)) >= 0, x + n, -1) for s, n in zip(answers.column("states").to_pylist(), answers.column("before").to_pylist())]
    return np.concatenate([*parts, np.full(1, -1)])


def first_streams(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Cogroup function of a shard: its words as states (a place without a word, -1, takes the last entry)."""
    out = renamed(answers)[unsqueezed(rows.column("stream")[0].as_py())]
    return pa.table({"shard": rows.column("shard")[:1], "stream": pa.array([squeezed(thinned(out))], pa.binary())})


def next_streams(states: int) -> Callable:
    """Cogroup function of a shard: its stream as the states one word longer."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        a = arcs(unsqueezed(rows.column("stream")[0].as_py()), states)
        on = a >= 0
        _, at = np.unique(a[on], return_inverse=True)
        out = np.full(len(a), -1, np.int64)
        out[on] = renamed(answers)[at]
        return pa.table({"shard": rows.column("shard")[:1], "stream": pa.array([squeezed(thinned(out))], pa.binary())})

    return run


def phrase_states(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                  shard_bytes: int = SHARD_BYTES, range_arcs: int = RANGE_ARCS) -> tuple[list[DataFrame], DataFrame]:
    """(the automaton by phrase length, words per language).

    A length's table has a row per state: state, parent, suffix (NULL for
    words), lang, words, f, heads and tails: the counts of the first 1, 2, ...
    words and of what is left of the phrase behind them.
    """
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = rows.mapInArrow(sharder(shard_bytes), "lang string, words array<string>, counts array<long>, tokens long, stream binary")
    shards = stored(made.withColumn("shard", F.monotonically_increasing_id()), "phrase-shards", "zstd")
    totals = shards.groupBy("lang").agg(F.sum("tokens").alias("n"))

    count = count_of(shards.agg(F.sum(F.size("words"))).first()[0] or 0, range_arcs // 4)
    pieces = shards.select("shard", "lang", "words", "counts").mapInArrow(word_ranges(count), "range long, shard long, lang string, words array<string>, counts array<long>")
    pieces = pieces.repartition(shuffle_parts(spark, count), "range")
    united = stored(pieces.groupBy("range").applyInArrow(word_union(least), _WORDS_UNITED), "phrase-words")
    united = offset(united, united.where("shard is null").select("range", "size"), "range")
    none = F.lit(None).cast("long")
    empty = F.array().cast("array<bigint>")
    words = united.where("shard is null").select("before", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("pos", "w"))
    level = words.select((F.col("before") + F.col("pos")).alias("state"), none.alias("parent"), none.alias("suffix"), F.col("w.langs").alias("lang"),
                         F.array("w.words").alias("words"), F.col("w.counts").alias("f"), empty.alias("heads"), empty.alias("tails"))
    level = stored(level, "phrase-level-1")
    automaton = [level]
    states = level.count()
    answers = united.where("shard is not null").select(F.col("shard").alias("owner"), "range", "states", "before")
    streams = shards.select("shard", "stream").groupBy("shard").cogroup(answers.groupBy("owner")).applyInArrow(first_streams, "shard long, stream binary")
    streams = stored(streams, "phrase-streams-1")

    for length in range(2, longest + 1):
        if not states:
            break
        own = stored(streams.mapInArrow(transducer(states), "shard long, keys binary, weights binary, arcs long, sample array<long>"), f"phrase-arcs-{length}")
        count = count_of(own.agg(F.sum("arcs")).first()[0] or 0, range_arcs)
        borders = np.zeros(0, U64)
        if count > 1:
            shares = F.array(*[F.lit(k / count) for k in range(1, count)])
            sampled = own.select(F.explode("sample").alias("key")).agg(F.percentile_approx("key", shares, 20 * max(count, 500)))
            borders = np.unique(np.array(sampled.first()[0], np.int64)).astype(U64)
        pieces = own.select("shard", "keys", "weights").mapInArrow(ranges(borders), "range long, shard long, keys binary, weights binary")
        pieces = pieces.repartition(shuffle_parts(spark, count), "range")
        united = stored(pieces.groupBy("range").applyInArrow(union(least), _UNITED), f"phrase-union-{length}")
        united = offset(united, united.where("shard is null").select("range", "size"), "range")
        found = stored(united.where("shard is null").select("before", "states", "weights").mapInArrow(listed(states), "state long, parent long, suffix long, f long"),
                       f"phrase-states-{length}")
        parent = level.select(F.col("state").alias("parent"), "lang", F.col("words").alias("w"), F.col("f").alias("pf"), F.col("heads").alias("h"))
        suffix = level.select(F.col("state").alias("suffix"), F.element_at("words", -1).alias("last"), F.col("f").alias("sf"), F.col("tails").alias("t"))
        level = found.join(parent, "parent").join(suffix, "suffix").select(
            "state", "parent", "suffix", "lang", F.array_append("w", F.col("last")).alias("words"), "f",
            F.array_append("h", F.col("pf")).alias("heads"), F.array_prepend("t", F.col("sf")).alias("tails"))
        level = stored(level, f"phrase-level-{length}")
        automaton.append(level)
        if length < longest:
            answers = united.where("shard is not null").select(F.col("shard").alias("owner"), "range", "states", "before")
            streams = streams.groupBy("shard").cogroup(answers.groupBy("owner")).applyInArrow(next_streams(states), "shard long, stream binary")
            streams = stored(streams, f"phrase-streams-{length}")
        states = level.count()
    return automaton, totals


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 shard_bytes: int = SHARD_BYTES, range_arcs: int = RANGE_ARCS) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its lowest-scoring
    cut, ``n`` the language's words; score is floor(1000 a n / (l r)). A phrase
    inside a longer one that is as frequent is left out.
    """
    automaton, totals = phrase_states(df, text_col, lang_col, least, longest, shard_bytes, range_arcs)
    candidates = None
    for k, level in enumerate(automaton[1:], 1):
        if k + 1 < len(automaton):
            longer = automaton[k + 1]
            # in a longer phrase that is as frequent, so is every phrase between the two: one word more decides
            within = longer.select(F.col("parent").alias("state"), F.col("f").alias("in")).unionByName(longer.select(F.col("suffix").alias("state"), F.col("f").alias("in")))
            within = within.groupBy("state").agg(F.max("in").alias("in"))
            level = level.join(within, "state", "left").where(F.col("in").isNull() | (F.col("in") < F.col("f")))
        level = level.select("lang", F.concat_ws(" ", "words").alias("phrase"), F.col("f").alias("a"), "heads", "tails")
        candidates = level if candidates is None else candidates.unionByName(level)
    if candidates is None:
        return df.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    cut = F.expr("""array_min(transform(sequence(1, size(heads)), k -> struct(
        (cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0))) div (cast(heads[k - 1] as decimal(19,0)) * cast(tails[k - 1] as decimal(18,0))) as score,
        k as k, heads[k - 1] as l, tails[k - 1] as r)))""")
    scored = candidates.join(totals, "lang").withColumn("cut", cut).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each part of a language first, so no task ranks a whole language
    some = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = scored.withColumn("some", some).where(F.col("some") <= top).drop("some").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
