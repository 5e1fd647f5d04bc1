import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np

from llm.language_id import BUCKETS, codebook, language_id
from llm.toxicity import fit_ordinal, toxicity
from tests.conftest import SMALL
from tests.llm.conftest import odd_rows, prose


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 9, 20, 40):
        code = codebook(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert len({tuple(r) for r in code}) == n and min(gaps) >= (1 if n == 2 else 2 if n < 5 else code.shape[1] // 2)


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_rows(odd, none):
    got = language_id(odd).collect()
    assert len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    for d, t in odd_rows():
        if d is not None:
            none_told = not any(unicodedata.category(c)[0] == "L" for c in t or "")
            assert (by[d].lang_pred == "und") == none_told
    assert language_id(none).count() == 0


def test_only_letters_tell(spark):
    """Numbers of other scripts and kinds, accents and signs are no letters; a letter of any script is one."""
    signs = ["²", "½ ¾ ①②", "Ⅷ", "٣", "_", "\u0301", "€ 🙂", "—"]
    letters = ["漢", "ª", "ʰ 1", "ß", "1a"]
    rows = [(k, "abc def", ["en", "de"][k % 2]) for k in range(20)] + [(100 + k, t, None) for k, t in enumerate(signs + letters)]
    got = {r.doc_id: r.lang_pred for r in language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[100 + k] == "und" for k in range(len(signs) + len(letters))] == [True] * len(signs) + [False] * len(letters)


def test_decoding_equals_brute_force(spark):
    """Counts, classifiers and decoding of a small corpus done n-gram by n-gram."""
    rng = random.Random(2)
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["straße", "über", "haus"], "cc": ["niño", "año", "casa"]}
    rows = [(k, " ".join(rng.choice(words[g] + (["casa", "haus"] if k % 5 == 0 else [])) for _ in range(rng.randint(1, 8))) + rng.choice(["", "!", " 42"]), g)
            for k, g in ((k, rng.choice("abc") * 2) for k in range(150))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    totals = {g: Counter() for g in words}
    for k, t, g in rows:
        if zlib.crc32(str(k).encode()) % 3 != 1:
            totals[g].update(plain_grams(t))
    langs = sorted(totals)
    code = codebook(3)
    p = np.array([[(totals[g][b] + 0.5) / (sum(totals[g].values()) + 0.5 * BUCKETS) for b in range(BUCKETS)] for g in langs])
    weights = np.stack([np.log(p[code[:, j] > 0].mean(axis=0)) - np.log(p[code[:, j] < 0].mean(axis=0)) for j in range(code.shape[1])], 1)
    trust = np.array([max(min(p[i] @ weights[:, j] * code[i, j] for i in range(3)), 1e-3) for j in range(code.shape[1])])
    trust /= trust.sum()
    got = {r.doc_id: r for r in language_id(df).collect()}
    for k, t, _ in rows:
        c = plain_grams(t)
        margins = np.array([sum(n * weights[b, j] for b, n in c.items()) for j in range(code.shape[1])]) / np.sqrt(sum(c.values()))
        loss = [sum(trust[j] * np.log1p(np.exp(-code[i, j] * margins[j])) for j in range(code.shape[1])) for i in range(3)]
        near = sorted(loss)
        if near[1] - near[0] > 1e-4:
            assert got[k].lang_pred == langs[int(np.argmin(loss))]
        assert abs(got[k].score - 1 / sum(np.exp(-(x - near[0]) * len(trust)) for x in loss)) < 1e-3


def plain_grams(text):
    """Buckets of the byte n-grams of one text, by a loop over its bytes."""
    folded = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    t = re.sub(b" +", b" ", b" " + folded + b" ")
    return Counter((((int.from_bytes(t[i:i + n], "big") + (n << 24)) * 0x9E3779B1 & 0xFFFFFFFF) >> 18)
                   for n in (1, 2, 3) for i in range(len(t) - n + 1) if t[i:i + n] != b" ")


def test_one_language_and_no_language(spark):
    one = spark.createDataFrame([(0, "a b", "xx"), (2, "1", "xx"), (1, "c", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language_id(one).collect()} == {0: "xx", 1: "xx", 2: "und"}
    untold = one.selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {r.lang_pred for r in language_id(untold).collect()} == {"und"}


def test_thresholds_stay_in_order_and_weights_are_shared():
    y = np.array([0, 0, 0, 0, 1, 1, 2, 2])
    indptr = np.array([0, 0, 0, 0, 1, 2, 3, 5, 7])
    cols = np.array([1, 0, 0, 0, 0, 0, 0])
    w, t = fit_ordinal(indptr, cols, np.array([1.0, 1.0]), y)
    assert len(t) == 2 and t[0] < t[1] and w[0] > w[1]


def test_toxic_words_are_learned(spark):
    rng = random.Random(8)
    bad = ["vile", "nasty", "rotten", "scornful"]
    rows, truth = [], {}
    for d in range(400):
        w = prose(rng, rng.randint(20, 80)).split(" ")
        truth[d] = d % 5 == 0
        if truth[d]:
            for _ in range(rng.randint(2, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", ",", "s"]))
        rows.append((d, " ".join(w)))
    labels = [(d, int(truth[d])) for d in range(300)] + [(0, 0), (None, 1), (7, None), (9999, 1)]
    got = {r.doc_id: r for r in toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = range(300, 400)
    assert sum(got[d].toxic == truth[d] for d in held) >= 97
    assert all(0 <= got[d].severity <= 2 and got[d].grade in (0, 1, 2) and got[d].toxic == (got[d].p_toxic >= 0.3) for d in got)
    assert np.mean([got[d].severity for d in held if truth[d]]) > 1 > np.mean([got[d].severity for d in held if not truth[d]])


def test_toxicity_of_odd_rows_and_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (2, 1), (107, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity(odd, labels).count() == len(odd_rows())
    for some in (labels.where("toxic = 0"), labels.where("doc_id = -1")):
        assert {(r.severity, r.toxic) for r in toxicity(odd, some).collect()} == {(0.0, False)}
    assert toxicity(none, labels).count() == 0


def test_labels_of_absent_documents_are_not_used(spark):
    """They neither fill the sample nor shift the thresholds."""
    rng = random.Random(8)
    rows = [(d, prose(rng, 30) + " vile nasty" * (d % 4 == 0)) for d in range(200)]
    labels = [(d, int(d % 4 == 0)) for d in range(150)]
    absent = [(10_000 + d, int(d % 50 != 0)) for d in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, got = ({r.doc_id: r for r in toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int"), train_limit=100).collect()} for x in (labels, labels + absent))
    assert got == want and {d for d in got if got[d].toxic} == set(range(0, 200, 4))
