import random
import re

import pytest
from pyspark.sql import types as T

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: documents with columns whose names the operators use inside
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("id", T.StringType()), T.StructField("kept", T.StringType()),
                     T.StructField("h", T.StringType()), T.StructField("block", T.StringType()), T.StructField("row_key", T.StringType()),
                     T.StructField("n", T.IntegerType()), T.StructField("root", T.StringType()), T.StructField("found", T.StringType())])


def prose(rng: random.Random, n: int) -> str:
    syllables = ["the", "an", "er", "on", "ing", "ed", "tion", "é", "sch", "ñ", "ble", "or"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", "", ".", ",", ".\n"]) for _ in range(n))


def odd_rows() -> list[tuple[int | None, str | None]]:
    """NULLs, empty and very long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split(" ")
    near[60] = "changed"
    long = prose(rng, 60_000)
    rows: list[tuple[int | None, str | None]] = [(i, prose(rng, rng.randint(1, 150))) for i in range(10, 60)]
    rows += [(1, base), (2, base), (3, " ".join(near)), (4, base.replace(" ", "  ")), (5, base.upper()), (6, prose(rng, 40) + " " + base + " " + prose(rng, 40))]
    rows += [(100, None), (101, ""), (102, "   \t"), (103, "!!! 123"), (104, "one two"), (105, "One  two"), (106, "é"), (107, long), (108, long + " end"), (109, None), (110, "")]
    rows += [(None, base), (None, None), (None, "alone without a number"), (1, base), (1, base), (50, rows[40][1])]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents as a table with clashing extra columns."""
    rows = odd_rows()
    return spark.createDataFrame([(i, t, ["en", "de", None][k % 3], f"s{k % 4}", *["x"] * 5, k, "y", "z") for k, (i, t) in enumerate(rows)], DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    """The same table without rows."""
    return spark.createDataFrame([], DOCS)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))
