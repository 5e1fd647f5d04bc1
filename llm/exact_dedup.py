"""Exact duplicates: 128-bit content hash, smallest id stays, bytes compared.

Texts are equal when they are identical after every run of white space became
one space. Rows are grouped by hash *and* text in one aggregation: the partial
aggregation folds the copies of a task before anything moves, so a text that a
third of all rows share travels once per task, and grouping on the text itself
is the byte comparison. Only (hash, smallest id, size) come back to the rows,
joined on the hash. Should two texts share a hash, the rows under that hash
(and only those) are joined on their bytes instead.

Defined results: NULL text counts as empty; a NULL id never becomes the id
that stays unless the group has no other; rows that repeat an id with the same
text are copies of one document and share its verdict; an empty text is a
text like any other, and a text of any length is compared whole; an empty table
gives an empty result. Only the id and text columns are read, so other columns
may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored

#: Runs of white space that normalisation replaces by one space.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Text with each white-space run as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``content_hash`` maps the normalised bytes to the grouping hash (128-bit
    MD5); a weak one only makes more groups take the byte join.
    """
    rows = df.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    rows = rows.withColumn("h", content_hash(F.col("t").cast("binary")))
    per_text = [F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    sha = F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256")
    classes = stored(rows.groupBy("h", "t").agg(*per_text).select("h", "keep_id", "group_size", sha), "exact-classes")
    shared = classes.groupBy("h").count().where("count > 1").select("h")
    thin = rows.select("id", "h")
    if shared.isEmpty():
        found = thin.join(classes, "h")
    else:
        odd = rows.join(shared, "h", "left_semi")
        by_bytes = odd.join(odd.groupBy("h", "t").agg(*per_text), ["h", "t"]).select("id", "h", "keep_id", "group_size", sha)
        plain = thin.join(classes.join(shared, "h", "left_anti"), "h")
        found = plain.select("id", "h", "keep_id", "group_size", "text_sha256").unionByName(by_bytes)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
