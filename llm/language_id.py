r"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. One binary classifier per bit
tells from byte n-grams of the lower-cased letters whether the bit is set;
a text's language is the one whose codeword has the least loss against the
classifiers' margins, each bit weighted by how well its classifier did in
training. A text whose two nearest codewords lie close together is flagged.

Classifiers are linear. Spark counts, per language, the hashed n-grams of all
training texts: each task sums into one fixed-width vector per language, and
the vectors of ``FAN_IN`` neighbouring tasks are added up at a time, level by
level, so no group holds more than that many of the vectors below it. The
weights of each bit are the smoothed log-odds of the n-grams of the languages at
+1 against those at -1. What reaches the driver is one vector of ``BUCKETS``
counts per language, whatever the input.

Letters are the characters of Unicode's category L, so digits of any kind,
fractions, Roman and circled numbers and lone accents are none.

Defined results: a NULL text or one without a letter is ``und`` with score 0
and ambiguous; a very long text is counted whole, some bytes at a time; equal
losses go to the language first by name; with no training rows every text is ``und``; with one learned
language every text with a letter gets it with score 1; repeated rows are
judged alike; an empty table gives an empty result. Only the id, text and lang
columns are read; lang, source and id never enter a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import CHUNK_BYTES, text_bytes

#: Hashed n-gram buckets, n-gram lengths in bytes, and the codeword bits at least.
BUCKETS, SIZES, MIN_BITS = 1 << 14, (1, 2, 3), 15
#: Gap between the two least losses below which a text is ambiguous.
AMBIGUOUS = 0.05
UNKNOWN = "und"
#: Vectors added up in one group, and the levels of groups: enough for 64 ** 4 tasks.
FAN_IN, LEVELS = 64, 3

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(b: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram of the bytes: letters folded, all else one blank.

    N-grams are taken inside words with one blank on each side; runs of blanks
    count once.
    """
    t = _FOLD[b]
    keep = np.ones(len(t), bool)
    keep[1:] = (t[1:] != 32) | (t[:-1] != 32)
    t = np.concatenate([[32], t[keep], [32]]).astype(np.uint32)
    out = []
    for n in SIZES:
        code = t[:len(t) - n + 1].copy()
        for j in range(1, n):
            code = (code << np.uint32(8)) | t[j:len(t) - n + 1 + j]
        if n == 1:
            code = code[code != 32]
        code = code + np.uint32((n << 24) & 0xFFFFFFFF)
        out.append(((code * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64))
    return np.concatenate(out)


def counts(b: np.ndarray) -> np.ndarray:
    """N-gram counts of one whole text, a slice of ``CHUNK_BYTES`` at a time."""
    total = np.bincount(grams(b[:CHUNK_BYTES]), minlength=BUCKETS)
    for at in range(CHUNK_BYTES, len(b), CHUNK_BYTES):
        total += np.bincount(grams(b[at:at + CHUNK_BYTES]), minlength=BUCKETS)
    return total


def codebook(n: int) -> np.ndarray:
    """n distinct codewords of +1/-1 bits, far apart: rows of a Hadamard matrix for larger n.

    Up to 15 bits are all the ways to split few languages in two; beyond, the
    rows of the Sylvester matrix without its constant column, any two of which
    differ in half their bits.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 4:
        splits = [[1 if (s >> i) & 1 else -1 for i in range(n)] for s in range(1, 1 << (n - 1))]
        return np.array(splits).T
    size = 1
    while size < max(n, MIN_BITS + 1):
        size *= 2
    h = np.array([[1 - 2 * (bin(i & j).count("1") & 1) for j in range(size)] for i in range(size)])
    return h[:n, 1:]


class Coder:
    """Binary classifiers and codewords; ``margins`` and ``decode`` work on counts."""

    def __init__(self, langs: list[str], totals: np.ndarray):
        self.langs, self.code = langs, codebook(len(langs))
        p = (totals + 0.5) / (totals.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
        self.weights = np.zeros((BUCKETS, self.code.shape[1]), np.float32)
        self.trust = np.ones(self.code.shape[1])
        if len(langs) < 2:
            return
        for k, bit in enumerate(self.code.T):
            self.weights[:, k] = np.log(p[bit > 0].mean(axis=0)) - np.log(p[bit < 0].mean(axis=0))
            # how far apart the classifier holds its two sides, in mean margin over a training gram
            drift = p @ self.weights[:, k]
            self.trust[k] = max(float((drift * bit).min()), 1e-3)
        self.trust /= self.trust.sum()

    def decode(self, b: np.ndarray) -> tuple[str, float, bool]:
        """(language, score, ambiguous) of a text's bytes."""
        if len(self.langs) < 2:
            return self.langs[0], 1.0, False
        c = counts(b)
        margins = (c.astype(np.float32) @ self.weights) / np.sqrt(max(int(c.sum()), 1))
        loss = (self.trust * np.logaddexp(0, -self.code * np.clip(margins, -30, 30))).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        odds = np.exp(-(loss - loss[order[0]]) * len(self.trust))
        gap = float(loss[order[1]] - loss[order[0]])
        return self.langs[order[0]], float(1 / odds.sum()), gap < AMBIGUOUS


def counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language, the summed n-gram counts."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        raw, offs = text_bytes(batch.column(0))
        langs = batch.column(1).to_pylist()
        for i, lang in enumerate(langs):
            part = counts(raw[offs[i]:offs[i + 1]])
            if lang in sums:
                sums[lang] += part
            else:
                sums[lang] = part
    task = TaskContext.get().partitionId()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([task] * len(sums), pa.int64()),
                                          pa.array([v.astype("<i8").tobytes() for v in sums.values()], pa.binary())], ["lang", "part", "counts"])


def added(rows: pa.Table) -> pa.Table:
    """The vectors of a language and part summed."""
    total = np.zeros(BUCKETS, np.int64)
    for v in rows.column("counts"):
        total += np.frombuffer(v.as_buffer(), "<i8")
    return pa.table({"lang": rows.column("lang")[:1], "part": rows.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Coder | None:
    """The coder learned from all rows of ``df`` with a language; None without any."""
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("lang"))
    row = "lang string, part long, counts binary"
    sums = rows.mapInArrow(counter, row)
    for _ in range(LEVELS):
        sums = sums.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("lang", "part").applyInArrow(added, row)
    sums = sums.withColumn("part", F.lit(0).cast("long")).groupBy("lang").applyInArrow(added, row)
    learned = sorted(sums.select("lang", "counts").collect())
    if not learned:
        return None
    return Coder([r.lang for r in learned], np.stack([np.frombuffer(r.counts, "<i8") for r in learned]).astype(float))


def language_of(coder: Coder | None, text: Column) -> Column:
    """Prediction of a text as a struct lang_pred, score, ambiguous."""

    def judge(texts: pa.Array) -> pa.Array:
        raw, offs = text_bytes(texts)
        out = []
        for lo, hi in zip(offs[:-1], offs[1:]):
            b = raw[lo:hi]
            if coder is None or not _LETTER.search(b.tobytes().decode("utf-8", "replace")):
                out.append((UNKNOWN, 0.0, True))
            else:
                out.append(coder.decode(b))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.StructArray.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())],
                                          ["lang_pred", "score", "ambiguous"])

    return F.arrow_udf(judge, "lang_pred string, score double, ambiguous boolean")(text.cast("string"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, remainder 1 by 3 (a NULL id is learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, ambiguous."""
    coder = fit(df.where(~held_out(id_col)), text_col, lang_col)
    found = df.select(F.col(id_col), held_out(id_col).alias("held_out"), language_of(coder, F.col(text_col)).alias("found"))
    return found.select(id_col, "held_out", "found.lang_pred", "found.score", "found.ambiguous")
