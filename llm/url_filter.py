r"""URL verdicts: host/path rules first, gradient-boosted trees for the rest.

A rule ``host/path`` fits its host and all subdomains when the URL's path starts
with the rule's path; the longest fitting rule decides. URLs that no rule fits
are judged by gradient-boosted trees over lexical features (length, depth, digit
ratio, entropy, parameter counts and suffix statistics), trained on the URLs
that the rules label. Everything is DataFrame functions and JVM-side trees.

Suffix statistics are smoothed block rates of the last host label and of the
first path segment. They are counted over all labelled URLs, grouped by value,
and joined back; the rate a labelled URL sees excludes its own label, so the
trees cannot read the answer from it.

Defined results: a URL that is NULL or has no ``://`` has empty host and path
and no rule; repeated rows are judged alike; when the labelled URLs hold fewer
than two verdicts the trees have nothing to learn and the rest gets the verdict
that was seen (``allow`` when none was); a probability of
exactly one half blocks; a URL of any length is
judged whole; an empty table gives an empty result. Only the id and URL columns
are read, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored

#: Rules of the registered query, as (host/path, verdict).
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]
#: Most distinct labelled URLs that the trees are fitted on; of each verdict the smallest by URL hash, at least half
#: of these (or all, if fewer) and as many as the other verdict leaves free.
TRAIN_LIMIT = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "hyphens",
            "entropy", "n_params", "query_length", "is_https", "has_fragment", "tld_rate", "segment_rate"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host after the first ``://`` and the path after it."""
    cut = F.locate("://", url)
    rest = F.when(cut > 0, F.substr(url, cut + 3))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    after = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(after, F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; NULLs when none fits.

    The rules are a short curated list (a parameter, not a table), so they are
    one expression over each row; the work is rows times rules.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, judged in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, judged).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy (bits) of the characters of ``text``."""
    n = F.length(text)
    def share(c: Column) -> Column:
        return (n - F.length(F.replace(text, c, F.lit("")))) / n
    parts = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(F.length(c) > 0, -share(c) * F.log2(share(c))).otherwise(0.0))
    return F.when(n > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features of columns u (URL), host and path."""
    u, host, path = F.col("u"), F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    d = lambda c: c.cast("double")
    return df.select(
        "*", F.element_at(F.split(host, r"\."), -1).alias("tld"), F.regexp_extract(path, r"^/([^/]*)", 1).alias("segment"),
        d(F.length(u)).alias("url_length"), d(F.length(host)).alias("host_length"), d(F.length(path)).alias("path_length"),
        d(F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).alias("depth"),
        d(F.size(F.split(host, r"\."))).alias("host_labels"),
        d(F.length(F.regexp_replace(u, r"[^0-9]", "")) / F.greatest(F.length(u), F.lit(1))).alias("digit_ratio"),
        d(F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).alias("hyphens"), entropy(u).alias("entropy"),
        d(F.when(query == "", 0).otherwise(F.size(F.split(query, "&")))).alias("n_params"), d(F.length(query)).alias("query_length"),
        d(F.translate(F.substring(u, 1, 6), UPPER, LOWER) == "https:").alias("is_https"), d(F.locate("#", u) > 0).alias("has_fragment"))


def with_rates(df: DataFrame, value: str, rate: str) -> DataFrame:
    """Adds the smoothed block rate of ``value`` among labelled rows, without the row's own label.

    The labels of a value are counted by a partial aggregation; the counts (a
    row per distinct value) are joined back, and AQE splits a hot value.
    """
    seen = df.where("label is not null").groupBy(value).agg(F.sum("label").alias("blocked"), F.count("label").alias("labelled"))
    own, one = F.coalesce(F.col("label"), F.lit(0.0)), F.col("label").isNotNull().cast("double")
    blocked, labelled = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("blocked", "labelled"))
    return df.join(seen, value, "left").withColumn(rate, (blocked - own + 1) / (labelled - one + 2)).drop("blocked", "labelled")


def fit_trees(rows: DataFrame, limit: int = TRAIN_LIMIT, trees: int = 10, depth: int = 4) -> GBTClassificationModel | None:
    """Boosted trees over at most ``limit`` (2 at least) distinct labelled URLs; None when all labelled URLs have one verdict.

    Rows of a URL have the same label and features, so any of them stands for it.
    """
    known = rows.where("label is not null")
    of = lambda label: (known.where(F.col("label") == label).groupBy(F.xxhash64("u").alias("h"), "u")
                        .agg(F.first("label").alias("label"), F.first("features").alias("features")).orderBy("h", "u").limit(limit))
    both = [stored(of(label), "labelled") for label in (0.0, 1.0)]
    many = [d.count() for d in both]
    if not all(many):
        return None
    half = limit // 2
    share = [min(m, max(half, limit - other)) for m, other in (many, many[::-1])]
    sample = reduce(DataFrame.unionByName, [d.orderBy("h", "u").limit(n) for d, n in zip(both, share)]).select("features", "label")
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, featuresCol="features", labelCol="label").fit(sample)


def url_filter(df: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
               train_limit: int = TRAIN_LIMIT) -> DataFrame:
    """One row per URL: id, host, path, rule, verdict, block_score (the trees' probability of block)."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("u"))
    host, path = host_and_path(F.col("u"))
    rows = rows.select("id", "u", host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "by_rule": verdict})
    rows = lexical(rows.withColumn("label", F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == "block").cast("double"))))
    rows = reduce(lambda d, x: with_rates(d, *x), [("tld", "tld_rate"), ("segment", "segment_rate")], rows)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = fit_trees(rows, train_limit)
    if model is None:
        only = rows.select(F.max("by_rule")).first()[0] or "allow"
        judged = rows.withColumns({"block_score": F.lit(float(only == "block")), "judged": F.lit(only)})
    else:
        judged = model.transform(rows).withColumn("block_score", vector_to_array("probability")[1])
        judged = judged.withColumn("judged", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("by_rule", "judged").alias("verdict"), "block_score")
