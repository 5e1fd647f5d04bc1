import hashlib
import re

from pyspark.sql import functions as F

from llm.fill_middle import fill_in_middle, fim_digest, restored
from llm.queries import ORACLE
from tests.llm.conftest import DOCS, odd_rows

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    """(n, form, prefix, middle, output) of one document, unit by unit."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", prefix, middle, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", prefix, middle, f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(df, rows):
    got = sorted((repr(tuple(r)) for r in fill_in_middle(df).collect()))
    assert got == sorted(repr((i, *(b := brute(i, t))[:2], b[4], b[2], b[3])) for i, t in rows)


def test_equals_brute_force(spark, odd):
    check(odd, odd_rows())


def test_markers_white_space_and_other_planes(spark):
    texts = ["a<P>b", "x <S", "<M>", "<", "  lead and trail  ", "\x0b\x0c", "née 🙂 𝔘𝔫𝔦 code line", "a\nb\r\nc", "$1 \\2 {3}", "one", "a < P > b"]
    rows = [(40 * i + k, t) for i, t in enumerate(texts) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, rows)
    forms = {r.form for r in fill_in_middle(df).collect()}
    assert forms == {"plain", "psm", "spm"}


def test_very_long_text_and_empty_table(spark, none):
    rows = [(i, "word  " * 400_000) for i in range(6)] + [(7, "x" * 1_000_000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert fim_digest(none).count() == 0


def test_restores_every_text(spark, odd):
    back = fill_in_middle(odd).select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()))


def test_sql(spark, duck, tmp_path):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, "en", *["s"] * 6, 1, "y", "z") for i, t in rows], DOCS).select("doc_id", "text")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    duck.execute(f"CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = duck.execute(ORACLE["op12_fill_middle"]).fetchall()
    got = [tuple(r) for r in fim_digest(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
