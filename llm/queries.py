"""The registered queries of this subpackage: name -> fn(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.collocations import collocations
from llm.decontamination import decontaminate
from llm.exact_dedup import exact_dedup
from llm.fill_middle import fim_digest
from llm.language_id import language_id
from llm.lm_scoring import lm_scores
from llm.near_dedup import near_dedup
from llm.packing import pack
from llm.page_text import page_text
from llm.repeat_removal import remove_repeats
from llm.toxicity import toxicity
from llm.training_order import materialise, shard_path
from llm.url_filter import url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, as stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates over all documents."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page URL."""
    return url_filter(table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates over all documents."""
    return near_dedup(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of all documents, learned from six sevenths of them."""
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 100-byte strings removed from all documents."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed sequences in training order, written to shards."""
    return materialise(table(spark, sf_dir, "documents"), shard_path(spark))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learned from two thirds of them."""
    return language_id(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of all documents, learned from the labelled ones."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return page_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of all documents, as lengths and digests."""
    return fim_digest(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_packing": op3_packing,
    "op4_near_dedup": op4_near_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_training_order": op8_training_order,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_html_text": op11_html_text,
    "op12_fill_middle": op12_fill_middle,
    "op13_collocations": op13_collocations,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op12_fill_middle": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                 regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
          FROM documents),
        e AS (
          SELECT *, CAST(len(u) AS BIGINT) AS n,
                 CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
          FROM d),
        f AS (
          SELECT doc_id, t, n, u, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
          FROM e),
        g AS (
          SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
          FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM g""",
    "op13_collocations": r"""
        WITH p AS (
          SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
          FROM (SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents)),
        g AS (
          SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k))),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
        t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
        inside AS (
          SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
          FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
          GROUP BY ALL),
        cut AS (
          SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, CAST(1000::HUGEINT * c.a * t.n // (x.f::HUGEINT * y.f) AS BIGINT) AS score, c.j
          FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
          JOIN t USING (lang)
          JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.j], ' ')
          JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.j + 1:], ' ')
          LEFT JOIN inside s ON s.lang = c.lang AND s.phrase = c.phrase
          WHERE s.longer IS NULL OR 100 * s.longer < 100 * c.a),
        best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best QUALIFY rank <= 2000""",
}
