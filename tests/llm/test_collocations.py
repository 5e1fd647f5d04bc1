import collections
import random
import re

import numpy as np
import pytest

from llm.collocations import coded, collocations, cuts, squeezed, thinned, unsqueezed
from llm.queries import ORACLE
from tests.llm.conftest import LOWER


def brute(rows, least, top=2000, longest=5):
    """The report counted phrase by phrase."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        gone = {g[i:j] for g, a in found.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g) and 100 * a >= 100 * c[g[i:j]]}
        rows = []
        for g in found.keys() - gone:
            a = found[g]
            score, _, l, r = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            rows.append((lang, " ".join(g), a, l, r, n[lang], score))
        rows.sort(key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(x[0], k, *x[1:]) for k, x in enumerate(rows[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    """Skewed words with repeated phrases, nested ones, overlaps, NULLs and odd white space."""
    rng = random.Random(3)
    words = ["the", "The", "of", "né", "漢字", "a\xa0b", "x-y", "🙂", "\u0085", "q", "r", "s"]
    out = []
    for k in range(300):
        w = [words[min(int(rng.expovariate(0.4)), len(words) - 1)] + rng.choice(["", "", "", ".", ",", "\n", "\r", "\x0b"]) for _ in range(rng.randint(0, 40))]
        out.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(w)))
    out += [("en", "new york city hall"), ("en", "New  York\tCity hall")] * 12 + [("fr", "ha ha ha ha ha ha ha ha")] * 5
    return out + [("en", None), (None, None), ("de", ""), ("de", " \t "), ("it", "..."), ("one", "single")]


def test_equals_brute_force(spark, rows):
    df = spark.createDataFrame([(k, t, g, "x", "y", 1) for k, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, state string, shard string, f int").repartition(5)
    for least, top, shard, arcs in ((10, 2000, 1 << 24, 1 << 21), (2, 2000, 300, 40), (3, 4, 4000, 7), (1, 30, 2000, 500)):
        got = sorted(tuple(r) for r in collocations(df, least=least, top=top, shard_bytes=shard, range_arcs=arcs).collect())
        assert got == brute(rows, least, top)


def test_long_text_and_nothing_frequent(spark, none):
    text = "alpha beta gamma; " * 30_000
    df = spark.createDataFrame([("en", text), ("en", "word " * 50_000)], "lang string, text string")
    got = sorted(tuple(r) for r in collocations(df, shard_bytes=10_000).collect())
    assert got == brute([("en", text), ("en", "word " * 50_000)], 100)
    few = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert collocations(few).count() == 0 and collocations(none).count() == 0
    assert collocations(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    big = spark.range(1).select(F.lit(10 ** 15).alias("a"), F.lit(10 ** 17).alias("n"), F.lit(10 ** 15).alias("l"), F.lit(10 ** 15 + 7).alias("r"))
    got = big.select(F.expr("(cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))")).first()[0]
    assert got == 1000 * 10 ** 15 * 10 ** 17 // (10 ** 15 * (10 ** 15 + 7))


def test_streams_and_pieces():
    rng = np.random.default_rng(1)
    for top in (0, 1, 300, 1 << 40):
        a = rng.integers(-1, top + 1, 1000)
        assert (unsqueezed(squeezed(a)) == a).all()
    assert len(unsqueezed(squeezed(np.zeros(0, np.int64)))) == 0
    assert thinned(np.array([-1, 3, -1, 4, 5, -1, -1, 6, 7])).tolist() == [4, 5, -1, 6, 7] and len(thinned(np.zeros(0, np.int64))) == 0
    words, stream = coded(b"A b, a  b\nb")
    names = words.to_pylist()
    assert sorted(names) == ["a", "b"] and [names[i] if i >= 0 else "" for i in stream] == ["a", "b", "", "a", "b", "", "b"]
    assert list(cuts(b"aaaa bb.cc dd,ee", 5)) == [b"aaaa bb", b"cc dd", b"ee"] and list(cuts(b"abcdefgh", 3)) == [b"abcdefgh"]


def test_sql(spark, duck, rows, tmp_path):
    df = spark.createDataFrame([(g, (t or "") * 40) for g, t in rows], "lang string, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    duck.execute(f"CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(duck.execute(ORACLE["op13_collocations"]).fetchall()) == sorted(tuple(r) for r in collocations(df).collect()) != []
