"""Training-corpus pipeline: five stages, each one operator over all that the stage before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that stay, with the columns of ``docs`` and no others, or,
last, the packed pieces. Results are written as Parquet and reread between
stages, so a lost executor costs a stage's running tasks at most.

Filters that only look at a text are columns, so documents do not move. The two
duplicate filters decide by id; rows without an id get a surrogate from their
text for that. Rows that repeat an id and a text leave the second stage once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import stored
from llm.decontamination import with_matches
from llm.exact_dedup import exact_dedup, normalised
from llm.language_id import UNKNOWN, fit, held_out, language_of
from llm.near_dedup import near_dedup
from llm.packing import pack


def row_id() -> Column:
    """The document's id; without one, a number from its text above any real id."""
    spare = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), spare)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without text or a letter go."""
    coder = fit(docs.where(~held_out("doc_id")))
    return docs.where(language_of(coder, F.col("text"))["lang_pred"] != UNKNOWN)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id, once."""
    key, mark = free_name(docs, "row_key"), free_name(docs, "row_mark")
    found = exact_dedup(docs.select(row_id().alias("doc_id"), "text"))
    kept = found.where("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(mark)).distinct()
    rows = docs.withColumns({key: row_id(), mark: F.sha2(normalised(F.col("text")).cast("binary"), 256)})
    # merge joins at every size: the kept ids grow with the input
    return rows.join(kept.hint("merge"), [key, mark], "left_semi").dropDuplicates([key, mark]).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id."""
    key = free_name(docs, "row_key")
    found = near_dedup(docs.select(row_id().alias("doc_id"), "text"))
    kept = found.where("kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, row_id()).join(kept.hint("merge"), key, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = free_name(docs, "found")
    return with_matches(docs, benchmark, "text", found).where(F.size(f"{found}.items") == 0).drop(found)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens packed into sequences."""
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
