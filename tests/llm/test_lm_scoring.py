import math
import zlib
from collections import Counter

import numpy as np
import pytest

from llm.lm_scoring import START, Automaton, grams, lm_scores
from tests.llm.conftest import odd_rows, words


def brute(rows, order, weight):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base, score) by walking every text."""
    texts = [(d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, [*words(t), "</s>"]) for d, t in rows]
    counts, history = Counter(), Counter()
    for _, held, t in texts:
        if not held:
            padded = ["<s>"] * (order - 1) + t
            for i in range(order - 1, len(padded)):
                for k in range(1, order + 1):
                    counts[tuple(padded[i - k + 1:i + 1])] += 1
                    history[tuple(padded[i - k + 1:i])] += 1
    unigrams = {g: c for g, c in counts.items() if len(g) == 1}
    n, v = sum(unigrams.values()), len(unigrams)
    out = []
    for d, held, t in texts:
        padded = ["<s>"] * (order - 1) + t
        base = score = 0.0
        for i in range(order - 1, len(padded)):
            p = (counts[(padded[i],)] + 1) / (n + v + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                p = (counts[tuple(padded[i - k + 1:i + 1])] + weight * p) / (history[tuple(padded[i - k + 1:i])] + weight)
            score += math.log10(p)
        out.append((d, held, len(t), sum(counts[(w,)] > 0 for w in t), n, base, score))
    return out


@pytest.mark.parametrize("order,block,stretch", [(1, 4000, 5), (2, 4000, 512), (3, 1 << 20, 7), (4, 1 << 20, 1)])
def test_odd_rows(odd, order, block, stretch):
    got = lm_scores(odd, order=order, weight=7.0, block_bytes=block, shard_bytes=3000, stretch=stretch).collect()
    key = lambda r: (repr(r[0]), r[2], round(r[6], 6))
    want = sorted(brute(odd_rows(), order, 7.0), key=key)
    got = sorted(map(tuple, got), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_probabilities_sum_to_one():
    """The smoothed estimate over all known tokens and one unknown is a distribution."""
    c, n, v, weight = Counter("abacabad"), 8, 4, 3.0
    pairs, before = Counter(zip("abacaba", "bacabad")), Counter("abacaba")
    for h in "abc":
        total = sum((pairs[(h, w)] + weight * (c[w] + 1) / (n + v + 1)) / (before[h] + weight) for w in "abcdz")
        assert abs(total - 1) < 1e-12


def test_nothing_to_learn_from(spark, none):
    assert lm_scores(none).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()[0]
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_states_arcs_and_failure_arcs():
    """Texts ``a b END`` and ``a c END`` learned, ``b a b`` met: each arc and failure arc by hand."""
    a, b, c, end = np.arange(1, 5, dtype=np.uint64)
    t = np.array([a, b, end, a, c, end, b, a, b], np.uint64)
    first = np.array([0, 3, 6, 9])
    seen_of = {}
    with np.errstate(over="ignore"):
        for k in (1, 2, 3):
            h = grams(t, first, k)
            for i in range(9):
                seen_of.setdefault((k, int(h[i])), 0)
                seen_of[k, int(h[i])] += i < 6
        seen_of[1, int(START)] = 2
        made = Automaton(t, first, lambda k, h: np.array([seen_of[k, int(x)] for x in h]), 3, 1.0, 6, 4)
    assert len(made.fail) == 1 + 4 + 1 + 5 + 1      # empty; tokens; start; pairs seen; start of two places
    state, token = np.array([made.start]), lambda i: made.token[[i]]
    after, cost = made.step(state, token(0))        # a at the start of a text: an arc
    p_a, p_b = 3 / 11, 2 / 11
    p_start_a = (2 + p_a) / 3
    assert np.isclose(cost[0], math.log10((2 + p_start_a) / 3))
    _, cost = made.step(after, token(1))            # b after (start, a): an arc
    p_ab = (1 + p_b) / 3
    assert np.isclose(cost[0], math.log10((1 + p_ab) / 3))
    _, cost = made.step(state, token(1))            # b at the start of a text: two failure arcs, then the empty state
    assert np.isclose(cost[0], math.log10(1 / 3) * 2 + math.log10(p_b))
