import random
import re
import unicodedata

import pytest

import corpus_pipeline as cp
from llm.decontamination import SEGMENT, Q, budget
from llm.packing import pack
from tests.llm.conftest import DOCS, odd_rows, prose
from tests.llm.test_decontamination import fewest, fold
from tests.llm.test_near_dedup import shingles


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(folder, rows, items): the odd documents, benchmark leaks and near copies, as a table folder."""
    rng = random.Random(12)
    items = [(k, prose(rng, 30)) for k in range(4)]
    rows = [(i, t) for i, t in odd_rows() if len(t or "") < 100_000]
    rows += [(720 + k, t) for k, t in enumerate(["²", "½ ¾ ①②", "Ⅷ", "\u0301 1"])]
    rows += [(700 + k, prose(rng, 30) + " " + t + " " + prose(rng, 30)) for k, t in items[:2]]
    base = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, ["en", "de", None][k % 3], "s", *["x"] * 5, k, "y", "z") for k, (i, t) in enumerate(rows)], DOCS).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, rows, items


def brute(rows, items):
    """What the four filters keep, one after the other: the kept (id, text) pairs."""
    rows = [(i, t) for i, t in rows if any(unicodedata.category(c)[0] == "L" for c in t or "")]
    least = {}
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if key not in least or (i is not None and (least[key][0] is None or i < least[key][0])):
            least[key] = (i, t)
    rows = list(least.values())
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    sets = [shingles(t) for _, t in rows]
    up = {k: k for k in order}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for n, a in enumerate(order):
        for b in order[:n]:
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                if x != y:
                    first = min(x, y, key=order.index)
                    up[x if first == y else y] = first
    rows = [rows[k] for k in order if root(k) == k]
    whole = [fold(t).strip() for _, t in items]
    segments = {w[s:s + SEGMENT] for w in whole for s in range(max(1, len(w) - SEGMENT + 1)) if len(w) >= Q}
    return [(i, t) for i, t in rows if not any(within(s, fold(t), budget(len(s))) for s in segments)]


def within(segment, text, k):
    """Whether a part of the text is at most k edits from the segment: one of k + 1 parts of it is then untouched."""
    at = [len(segment) * j // (k + 1) for j in range(k + 2)]
    return any(segment[a:b] in text for a, b in zip(at[:-1], at[1:])) and fewest(segment, text) <= k


def test_stages_equal_brute_force(spark, corpus):
    base, rows, items = corpus
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, base), f"test-{name}")
        assert docs.columns == columns
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    spaced = lambda x: sorted((repr(i), re.sub(r"[\x20\x09-\x0D]+", " ", t)) for i, t in x)
    assert spaced(kept) == spaced(brute(rows, items))
    pieces = cp.STAGES[-1][1](spark, docs, base)
    assert pieces.groupBy("doc_id").sum("length").count() == len({i for i, _ in kept})


def test_run_and_empty(spark, corpus, tmp_path):
    base, rows, _ = corpus
    out = cp.run(spark, base)
    assert out.columns == pack(spark.read.parquet(f"{base}/documents.parquet")).columns and out.count() > 0
    empty = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert cp.run(spark, empty).count() == 0


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "a b c", "x", "y")], "doc_id long, text string, row_key string, Row_Mark string")
    assert cp.free_name(df, "row_key") == "row_key_" and cp.free_name(df, "row_mark") == "row_mark_"
    assert cp.drop_exact(spark, df, "").columns == df.columns
    assert [name for name, _ in cp.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
