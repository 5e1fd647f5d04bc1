import re

import pytest
from pyspark.sql import types as T

from llm.url_filter import RULES, url_filter

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("id", T.StringType()),
                       T.StructField("u", T.StringType()), T.StructField("label", T.StringType()), T.StructField("features", T.StringType())])


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    best = None
    for text, verdict in RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


URLS = ["https://www.example.com/en/1", "http://example.com/en/x?a=1", "https://EXAMPLE.com/En/", "https://example.com", "https://a.net/es/1", "https://a.net/fr/2",
        "https://a.net/de/3", "https://notexample.com/en/", "xcom/", None, "", "://", "https://x.org/en/?q=://y.com/", "ftp://www.example.com/en/#f", "https://m.www.example.com/en/p",
        "https://b.net/fr/2", "https://É.com/é", "https://com/", "https://a.net/fr", "https://a.net/es/1", "x" * 50_000, "https://long.org/" + "a/" * 20_000, "https://sp ace.org/a\nb?c\nd#e"]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(i, u, "x", "y", "z", "w") for i, u in enumerate(URLS)], SCHEMA)
    got = {r.page_id: r for r in url_filter(df).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = parts(u)
        found = rule(host, path)
        assert (got[i].host, got[i].path) == (host, path), u
        assert got[i].rule == (found[0] if found else None), u
        assert got[i].verdict == found[1] if found else got[i].verdict in ("allow", "block")


def test_trees_learn_a_lexical_difference(spark):
    """URLs that no rule fits, lexically like the blocked ones, are blocked."""
    bad = [f"https://h{i}.net/es/{i}{i}{i}{i}?a=1&b=2&c=3&d={i}" for i in range(200)]
    good = [f"http://site{i}.com/en/page" for i in range(200)]
    asked = [f"https://k{i}.org/es/{i}{i}{i}{i}?a=1&b=2&c=3&d={i}" for i in range(50)] + [f"http://other{i}.org/en/page" for i in range(50)]
    df = spark.createDataFrame([(i, u, "", "", "", "") for i, u in enumerate(bad + good + asked)], SCHEMA)
    got = {r.page_id: r.verdict for r in url_filter(df).collect()}
    right = sum(got[400 + i] == ("block" if i < 50 else "allow") for i in range(100))
    assert right >= 90


@pytest.mark.parametrize("urls", [[], ["https://a.org/x"], ["https://a.com/x", "https://a.org/x"]])
def test_nothing_to_learn(spark, urls):
    df = spark.createDataFrame([(i, u, "", "", "", "") for i, u in enumerate(urls)], SCHEMA)
    assert [r.verdict for r in url_filter(df).collect()] == ["allow"] * len(urls)


def test_repeated_urls_do_not_fill_the_sample(spark):
    """With many rows of one labelled URL, or many more URLs of one verdict, the trees still see both verdicts."""
    bad = [f"https://h{i}.net/es/{i}{i}{i}{i}?a=1&b=2&c=3&d={i}" for i in range(60)]
    good = [f"http://site{i}.com/en/page" for i in range(60)]
    for more in (good[:1] * 3000, [x for u in bad + good for x in [u] * 100], [f"http://more{i}.com/en/page" for i in range(2000)]):
        df = spark.createDataFrame([(i, u, "", "", "", "") for i, u in enumerate(bad + good + more)], SCHEMA)
        score = {r.page_id: r.block_score for r in url_filter(df, train_limit=100).collect()}
        assert min(score[i] for i in range(60)) >= 0.5 > max(score[60 + i] for i in range(60))
