import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from llm.decontamination import EDIT_PERCENT, SEGMENT, Index, aligned, budget, decontaminate, fold_text
from tests.llm.conftest import odd_rows, prose


def fold(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")).encode()


def fewest(segment, text):
    """Fewest edits between the segment and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(segment, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=20), st.binary(max_size=40), st.integers(0, 5))
def test_alignment_is_exact(segment, text, limit):
    import numpy as np
    assert aligned(segment, np.frombuffer(text, np.uint8), limit) == min(fewest(segment, text), limit + 1)


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + "q" + text[i:], text[:i] + "q" + text[i + 1:]])
    return text


def test_matches_equal_brute_force():
    import numpy as np
    rng = random.Random(4)
    items = [(k, prose(rng, n)) for k, n in enumerate([40, 20, 12, 60, 3, 1])] + [(6, ""), (7, None)]
    index = Index([(k, t) for k, t in items if t])
    texts = [prose(rng, 40)] + [prose(rng, 10) + " " + edited(rng, t, e) + " " + prose(rng, 10) for k, t in items[:5] for e in (0, 1, 3, 6, 12)] + ["", items[0][1][:60]]
    folded = [fold(t) for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(f) for f in folded])])
    got = index.matches(np.frombuffer(b"".join(folded), np.uint8), offs)
    for d, f in enumerate(folded):
        want = {}
        for item, seg in zip(index.items, index.segments):
            e = fewest(seg, f)
            if e <= budget(len(seg)):
                want[item] = min(e, want.get(item, e))
        assert {k: e for k, e in got.get(d, {}).items()}.keys() == want.keys(), d
        assert all(got[d][k] == e for k, e in want.items() if e == 0)


def test_fold_and_segments():
    assert fold_text("A\t\n b É") == "a b É".encode()
    index = Index([(1, "x" * 50 + "y" * 100)])
    assert [len(s) for s in index.segments] == [SEGMENT] * 3 and budget(SEGMENT) == SEGMENT * EDIT_PERCENT // 100


def test_odd_rows(spark, odd):
    text = dict((d, t) for d, t in odd_rows() if d is not None)
    bench = spark.createDataFrame([(1, text[1], "x"), (2, None, "x"), (3, "", "x"), (4, "short", "x"), (None, text[1], "x"), (5, text[1].lower(), "x"),
                                   (6, text[107][200_000:200_300], "x")], "item_id long, text string, items string")
    got = decontaminate(odd, bench).collect()
    assert len(got) == len(odd_rows())
    hit = {1, 2, 3, 4, 5, 6, None}
    for r in got:
        if r.doc_id in (107, 108):
            assert r["items"] == [6] and r.contaminated
        elif r.doc_id in hit - {None}:
            assert r["items"] == [1, 5] and r.n_items == 2
        elif r.doc_id is not None:
            assert not r.contaminated and r["items"] == [] and r.edits is None


def test_passes_over_a_large_benchmark_equal_one(spark, odd):
    """A benchmark of many blocks, taken a block or two a pass; items repeat and share texts."""
    text = dict((d, t) for d, t in odd_rows() if d is not None)
    rng = random.Random(12)
    quotes = [(n, text[n % 6 + 1][:300]) for n in range(8)] + [(20, text[107][1000:1400]), (20, text[107][1000:1400]), (21, text[107][-500:])]
    bench = spark.createDataFrame(quotes + [(100 + n, prose(rng, 60)) for n in range(40)], "item_id long, text string")
    key = lambda r: (repr(r.doc_id), tuple(r["items"]))
    whole = sorted(decontaminate(odd, bench).collect(), key=key)
    assert any(len(r["items"]) > 1 for r in whole)
    for block, together in [(2000, 2), (6000, 1)]:
        assert sorted(decontaminate(odd, bench, block_bytes=block, pass_blocks=together).collect(), key=key) == whole


def test_empty(spark, odd, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(odd, bench).where("contaminated").count() == 0
    assert decontaminate(none, spark.createDataFrame([(1, "x" * 200)], "item_id long, text string")).count() == 0


def test_quotes_from_any_start_are_found():
    """Against brute force over all starts in the item; a quote of SEGMENT bytes or more is never clean."""
    import numpy as np
    rng = random.Random(9)
    item = "".join(rng.choice("abcdefghij klm") for _ in range(400))[:233].strip().replace("  ", "xx")
    index = Index([(1, item)])
    quotes = [(s, m) for m in (SEGMENT, 100, 110, 115, 120, 134) for s in range(0, len(item) - m + 1, 7)] + [(20, 115)]
    texts = ["9" * 50 + item[s:s + m] + "8" * 50 for s, m in quotes]
    short = ["9" * 50 + item[s:s + m] + "8" * 50 for m in (70, 90) for s in (0, 30, 100)]
    few = ["9" * 50 + edited(rng, item[s:s + m], e) + "8" * 50 for m in (96, 105, 130) for s in (5, 30, 70) for e in (1, 2, 4, 6, 9)]
    folded = [fold(x) for x in texts + short + few]
    offs = np.concatenate([[0], np.cumsum([len(f) for f in folded])])
    got = index.matches(np.frombuffer(b"".join(folded), np.uint8), offs)
    assert all(got.get(d) == {1: 0} for d in range(len(texts)))
    whole = fold(item)
    for d in range(len(texts), len(folded)):
        e = min(fewest(whole[s:s + SEGMENT], folded[d]) for s in range(0, len(whole) - SEGMENT + 1))
        assert got.get(d, {}) == ({1: e} if e <= budget(SEGMENT) else {}), d
