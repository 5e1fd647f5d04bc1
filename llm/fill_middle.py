r"""Fill-in-middle transformation by one counted-quantifier match a text.

A text is a row of units, white space with the word behind it or the white
space at its end. ``regexp_count`` gives their number n; two cuts a <= b are
drawn from the id; and one pattern, made per row, with the possessive groups
``(?:unit){a}+`` and ``(?:unit){b-a}+`` captures prefix, middle and suffix in a
single match whose replacement is the transformed text. A possessive counted
group takes its units one after the other and never gives one back, so the
match is linear in the text and needs no stack, however long the text is.
Nothing is shuffled and no row depends on another.

Forms: ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is
``<S>suffix<P>prefix<M>middle``, ``plain`` the text itself. A text that holds a
marker stays plain, so each marker occurs once in the others and ``restored``
rebuilds the text from output and form alone.

Defined results: a NULL text counts as empty, and empty texts are plain with
n = 0; a NULL id draws as the empty string does; a text of white space only is
one unit; cuts may fall together or at the ends, which leaves empty parts; a
very long text is cut whole, never by a prefix of it; repeated rows get the
same result each; an empty table gives an empty result. Only the id and text
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space with the word behind it, or the white space at the end of the text.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percent of texts that are transformed, and of those the percent in suffix-prefix-middle form.
RATE, SPM_SHARE = 50, 80


def draws(row_id: Column, seed: int) -> list[Column]:
    """Four 32-bit draws from the seed and the id: the first 8-digit groups of a sha256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut_pattern(a: Column, b: Column) -> Column:
    """The row's pattern: the first a units, the next b - a, the rest."""
    counted = lambda k: F.concat(F.lit(f"((?:{UNIT}){{"), k.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"(?s)\A"), counted(a), counted(b - a), F.lit(r"(.*+)\z"))


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """(prefix, middle, suffix) of a transformed output, found by its markers."""
    head = F.substring_index(output, MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    first = F.when(form == PSM, F.substring_index(head, SUFFIX, 1)).otherwise(F.substring_index(head, PREFIX, 1))
    second = F.when(form == PSM, F.substring_index(head, SUFFIX, -1)).otherwise(F.substring_index(head, PREFIX, -1))
    first = F.substr(first, F.lit(len(PREFIX) + 1))  # without the marker the output begins with
    return F.when(form == PSM, first).otherwise(second), middle, F.when(form == PSM, second).otherwise(first)


def restored(output: Column, form: Column) -> Column:
    """The original text from a transformed output and its form."""
    return F.when(form == PLAIN, output).otherwise(F.concat(*parts(output, form)))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """One row per input row: id, n (units), form, output; prefix and middle (texts, NULL where plain)."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = draws(F.col("id"), seed)
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    x, y = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    held = F.col("text") == ""
    for marker in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains("text", F.lit(marker))
    form = F.when(held | (h3 % 100 >= rate), PLAIN).when(h4 % 100 < spm_share, SPM).otherwise(PSM)
    cut = rows.withColumns({"form": form, "a": F.least(x, y), "b": F.greatest(x, y)})
    shape = F.when(F.col("form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == PLAIN, F.col("text")).otherwise(F.regexp_replace("text", cut_pattern(F.col("a"), F.col("b")), shape))
    made = cut.select("id", "n", "form", output.alias("output"))
    prefix, middle, _ = parts(F.col("output"), F.col("form"))
    moved = F.col("form") != PLAIN
    return made.select(F.col("id").alias(id_col), "n", "form", "output", F.when(moved, prefix).alias("prefix"), F.when(moved, middle).alias("middle"))


def fim_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``fill_in_middle`` with lengths and digests in place of the texts."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(df, id_col, text_col).select(
        id_col, "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
