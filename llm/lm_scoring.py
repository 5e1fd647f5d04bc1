r"""Scoring with a weighted backoff automaton of smoothed n-grams.

States are the histories seen in training (up to ``ORDER - 1`` tokens). A state
has an arc for each token seen after it and a failure arc to the state of the
shorter history; the empty state has an arc for every token. With counts c,

    p(w | h) = (c(h w) + M p(w | shorter h)) / (c(h) + M),
    p(w)     = (c(w) + 1) / (N + V + 1),

so a seen token costs its arc's log p(w | h), and an unseen one the failure
arc's log M / (c(h) + M) plus whatever the shorter history gives. The
probabilities of known tokens and one unknown token sum to one. The log10
probabilities of a text's tokens add up: each text is walked once from left to
right, from the state of the text start, following failure arcs until the token
has an arc, and carrying the state on. The state after a token depends on the
last ``ORDER - 1`` tokens only, so a long text is walked in stretches of
``STRETCH`` tokens side by side, each entered through the tokens before it.

The automaton grows with the corpus and is never held whole. Documents form
blocks of bounded size; each block asks the shards of the n-gram space for the
training counts of its own n-grams (telling its own training counts at the same
time), and builds from them the part of the automaton its texts can reach. Texts
move once, and n-grams as packed arrays.

Tokens are words (A-Z lower-cased, split at ASCII white space) and one end per
text. Texts whose crc32(id as text) mod 7 is 2 are never learned from.

Defined results: NULL and empty texts are one end token; a NULL id is learned
from and not held out; repeated rows count as often as they occur and score
alike; without training texts every token is unknown (N = V = 0); an empty
table gives an empty result. Only the id and text columns are read. A text of
any length is scored whole; it is the smallest part of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import asked, by_hash, count_of, merged, runs, text_total
from llm.common import U64, chunks, mix, pack_counts, pack_sorted, shuffle_parts, text_bytes, unpack_counts, word_hashes

#: Longest n-gram, and the weight M of the shorter history's estimate.
ORDER, WEIGHT = 2, 100.0
#: Text of a block, and text per shard of the n-gram space.
BLOCK_BYTES, SHARD_BYTES = 12 << 20, 24 << 20
#: Tokens walked in one go; longer texts are walked in several stretches.
STRETCH = 512
END, START = U64(0x1B873593CC9E2D51), U64(0x52DCE729DA442695)


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, each closed by END; index of each text's first token)."""
    parts, sizes = [], []
    with np.errstate(over="ignore"):
        for lo, hi in chunks(offs):
            wh, at = word_hashes(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            n = np.diff(at)
            t = np.empty(len(wh) + len(n), U64)
            last = np.cumsum(n + 1) - 1
            word = np.ones(len(t), bool)
            word[last] = False
            t[word], t[last] = wh, END
            parts.append(t)
            sizes.append(n + 1)
    if not parts:
        return np.zeros(0, U64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def grams(t: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram of length ``order`` that ends at each token; START stands before a text."""
    if order == 1:
        return t
    n = len(t)
    since = np.arange(n) - np.repeat(first[:-1], np.diff(first))
    h = t * U64(0x9E3779B97F4A7C15)
    for j in range(1, order):
        back = np.full(n, START, U64)
        back[j:] = t[:-j] if j < n else t[:0]
        back[since < j] = START
        h = mix(h + U64(j)) + back * U64(0xC2B2AE3D27D4EB4F)
    return mix(h + U64(order))


def kinds(t: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """The hashes asked for, by n-gram length; the starts count as tokens of length 1."""
    return [np.concatenate([t, np.full(len(first) - 1, START, U64)]), *(grams(t, first, k) for k in range(2, order + 1))]


def asker(order: int, shards: int) -> Callable:
    """Block function: texts in, n-gram arrays with the block's own training counts out."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        t, first = tokens(*text_bytes(table.column("text")))
        train = table.column("train").to_numpy()
        own = np.repeat(train, np.diff(first))
        rows: list[tuple] = []
        for k, h in enumerate(kinds(t, first, order), 1):
            flag = np.concatenate([own, train]) if k == 1 else own
            at = np.argsort(h, kind="stable")
            h = h[at]
            start = runs(h)
            seen = np.add.reduceat(flag[at].astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
            h = h[start]
            rows += [(shard, k, key[0].as_py(), pack_sorted(h[lo:hi]), pack_counts(seen[lo:hi])) for shard, lo, hi in asked(h, shards)]
        cols = list(zip(*rows)) or [()] * 5
        return pa.table({n: pa.array(c, kind) for n, c, kind in zip(("shard", "kind", "block", "keys", "counts"), cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))})

    return run


_ASKED = "shard int, kind int, block int, keys binary, counts binary"


def added(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Training counts of a shard's keys: (total of each entry, keys, total per key, entries per row)."""
    keys, _, order = merged(rows.column("keys").to_pylist())
    parts = [unpack_counts(c) for c in rows.column("counts").to_pylist()]
    counts = np.concatenate(parts)[order]
    keys = keys[order]
    start = runs(keys)
    total = np.add.reduceat(counts, start)
    back = np.empty(len(keys), np.int64)
    back[order] = np.repeat(total, np.diff(np.append(start, len(keys))))
    return back, keys[start], total, [len(p) for p in parts]


def answer(rows: pa.Table) -> pa.Table:
    """Per block, the training counts of the keys it asked for."""
    back, _, _, sizes = added(rows)
    cut = np.cumsum(sizes)[:-1]
    return pa.table({"block": rows.column("block"), "kind": rows.column("kind"), "shard": rows.column("shard"),
                     "counts": pa.array([pack_counts(x) for x in np.split(back, cut)], pa.binary())})


def vocabulary(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Distinct tokens of each batch of training texts with their counts, by shard."""
    for b in batches:
        t, _ = tokens(*text_bytes(b.column(0)))
        h, n = np.unique(t, return_counts=True)
        rows = [(shard, 1, 0, pack_sorted(h[lo:hi]), pack_counts(n[lo:hi])) for shard, lo, hi in asked(h, shards)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                             ["shard", "kind", "block", "keys", "counts"])


def sizes(rows: pa.Table) -> pa.Table:
    """Tokens and distinct tokens of a shard."""
    _, keys, total, _ = added(rows)
    return pa.table({"tokens": pa.array([int(total.sum())], pa.int64()), "types": pa.array([len(keys)], pa.int64())})


class Automaton:
    """The part of the backoff automaton that a block's texts can reach.

    State 0 is the empty history; ``fail`` and ``fail_cost`` are the failure arcs.
    Arcs of the other states are sorted by ``state * tokens + token``; the empty
    state's arcs are arrays over the tokens. Costs are log10 probabilities.
    ``seen(k, hashes)`` gives the training counts of n-grams of length k.
    """

    def __init__(self, t: np.ndarray, first: np.ndarray, seen: Callable, order: int, weight: float, n: int, v: int) -> None:
        names, self.token = np.unique(t, return_inverse=True)
        self.tokens = len(names)
        count = seen(1, names)
        p = (count + 1) / (n + v + 1)
        self.known, self.empty_cost = count > 0, np.log10(p)
        self.empty_next = np.zeros(len(names), np.int64)
        begin = np.zeros(len(t), bool)
        begin[first[:-1]] = True
        starts = int(seen(1, np.array([START]))[0])
        fail, held = [np.zeros(1, np.int64)], [np.zeros(1)]
        states, self.start = 1, 0
        gram, lower = self.token, p              # of each token: its n-gram of the length below, and that arc's p
        state_of, start_of = np.zeros(len(t), np.int64), 0      # the state after it, and that of the text start, one length below
        arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(2, order + 1):
            # histories of k - 1 tokens become states
            used = count > 0
            number = np.where(used, states + np.cumsum(used) - 1, 0)
            at = np.zeros(len(count), np.int64)
            at[gram] = np.arange(len(gram))      # a place where each n-gram ends
            fail += [state_of[at[used]], np.array([start_of])]
            held += [count[used], np.array([starts])]
            states += int(used.sum()) + 1
            if k == 2:
                self.empty_next = number
            else:
                src, tok, p_arc, where = arcs[-1][:4]
                arcs[-1] = (src, tok, p_arc, number[where])
            state_of, start_of = number[gram], states - 1
            # n-grams of k tokens become arcs of those states
            hashes, place, longer = np.unique(grams(t, first, k), return_index=True, return_inverse=True)
            more = seen(k, hashes)
            kept = np.flatnonzero(more > 0)
            here = place[kept]
            source = np.where(begin[here], start_of, state_of[here - 1])
            history = np.where(begin[here], starts, count[gram[here - 1]])
            prob = np.zeros(len(hashes))
            prob[kept] = (more[kept] + weight * lower[gram[here]]) / (history + weight)
            arcs.append((source, self.token[here], np.log10(prob[kept]), kept))
            self.start, last = start_of, state_of
            gram, count, lower = longer, more, prob
            if k == order:                       # the longest n-grams lead to the state of their last tokens
                arcs[-1] = (*arcs[-1][:3], last[here])
        self.fail = np.concatenate(fail)
        self.fail_cost = np.log10(weight / (np.concatenate(held) + weight))
        key = np.concatenate([a[0] * self.tokens + a[1] for a in arcs]) if arcs else np.zeros(0, np.int64)
        by_key = np.argsort(key)
        self.arc = np.append(key[by_key], -1)    # one entry that no key equals
        self.arc_cost = np.append(np.concatenate([a[2] for a in arcs])[by_key] if arcs else np.zeros(0), 0.0)
        self.arc_next = np.append(np.concatenate([a[3] for a in arcs])[by_key] if arcs else np.zeros(0, np.int64), 0)

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, costs) of reading one token in each state, through failure arcs where need be."""
        cost, after = np.zeros(len(state)), np.empty(len(state), np.int64)
        open_, state = np.arange(len(state)), state.copy()
        while len(open_):
            s, w = state[open_], token[open_]
            at = np.searchsorted(self.arc[:-1], s * self.tokens + w)
            hit = (self.arc[at] == s * self.tokens + w) & (s > 0)
            end = s == 0
            cost[open_] += np.where(hit, self.arc_cost[at], np.where(end, self.empty_cost[w], self.fail_cost[s]))
            after[open_] = np.where(hit, self.arc_next[at], self.empty_next[w])
            state[open_] = self.fail[s]
            open_ = open_[~(hit | end)]
        return after, cost

    def walk(self, first: np.ndarray, order: int, stretch: int) -> np.ndarray:
        """Cost of each text (tokens first[i] to first[i + 1]), read from left to right."""
        stretch = max(stretch, order)
        size = np.diff(first)
        pieces = -(-size // stretch)
        text = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        lo = first[:-1][text] + nth * stretch
        length = np.minimum(first[1:][text] - lo, stretch)
        state = np.where(nth == 0, self.start, 0)
        inner = np.flatnonzero(nth > 0)
        for back in range(order - 1, 0, -1):     # the tokens before a stretch lead to its state
            state[inner], _ = self.step(state[inner], self.token[lo[inner] - back])
        longest = np.argsort(-length, kind="stable")
        state, lo, length, text = state[longest], lo[longest], length[longest], text[longest]
        total = np.zeros(len(text))
        for j in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -j, side="left"))
            state[:live], cost = self.step(state[:live], self.token[lo[:live] + j])
            total[:live] += cost
        return np.bincount(text, total, len(size))


def scorer(order: int, weight: float, n: int, v: int, id_type: pa.DataType, stretch: int) -> Callable:
    """Block function: texts and the answered counts in, scores out."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        t, first = tokens(*text_bytes(table.column("text")))
        answers = answers.sort_by([("kind", "ascending"), ("shard", "ascending")])
        of_kind = answers.column("kind").to_numpy()
        packed = answers.column("counts").to_pylist()
        known: list[tuple[np.ndarray, np.ndarray]] = []
        for k, h in enumerate(kinds(t, first, order), 1):
            known.append((np.unique(h), np.concatenate([unpack_counts(packed[i]) for i in np.flatnonzero(of_kind == k)])))

        def seen(k: int, h: np.ndarray) -> np.ndarray:
            return known[k - 1][1][np.searchsorted(known[k - 1][0], h)]

        made = Automaton(t, first, seen, order, weight, n, v)
        docs, begin = table.num_rows, first[:-1]
        summed = lambda x: np.add.reduceat(x, begin)
        return pa.table({"id": table.column("id").cast(id_type), "held_out": pa.array(~table.column("train").to_numpy()), "n_tokens": pa.array(np.diff(first)),
                         "n_known": pa.array(summed(made.known[made.token].astype(np.int64))), "train_tokens": pa.array(np.full(docs, n, np.int64)),
                         "base_score": pa.array(summed(made.empty_cost[made.token])), "score": pa.array(made.walk(first, order, stretch))})

    return run


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, weight: float = WEIGHT,
              block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, stretch: int = STRETCH) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    from pyspark.sql.pandas.types import to_arrow_type
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), (~held).alias("train"))
    total = text_total(docs)
    blocks, shards = count_of(total, block_bytes), count_of(total, shard_bytes)
    seen = docs.where("train").select("text").mapInArrow(lambda it: vocabulary(it, shards), _ASKED)
    seen = seen.groupBy("shard").applyInArrow(lambda t: sizes(t), "tokens long, types long")
    n, v = seen.select(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()

    parts = shuffle_parts(df.sparkSession, blocks)
    placed = docs.withColumn("block", by_hash(blocks, "id", "text")).repartition(parts, "block")
    questions = placed.groupBy("block").applyInArrow(asker(order, shards), _ASKED)
    answers = questions.groupBy("shard", "kind").applyInArrow(lambda t: answer(t), "block int, kind int, shard int, counts binary")
    kind = docs.schema["id"].dataType
    out = f"id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scorer(order, weight, n, v, to_arrow_type(kind), stretch), out)
    return scored.withColumnRenamed("id", id_col)
