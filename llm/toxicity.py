r"""Toxicity by cumulative-link ordinal regression over sparse words.

Severity grades 0 < 1 < ... < K-1 share one weight vector; threshold k gives
P(grade >= k) = sigmoid(w.x - t_k) with t_1 < t_2 < ..., and the expected
severity is the sum of those probabilities. Features are the distinct words of
a text (letters only, A-Z lower-cased), those whose rate among graded texts
differs from that among clean ones by ``Z_LEAST`` standard errors; each enters
with its log-rate ratio as scale.

Labels are 0/1. A toxic labelled text is graded 2 when its density of
toxic-leaning words is above the median of the toxic texts, else 1, so the
thresholds separate clean, toxic and severely toxic. The model is fitted on a
documented sample: at most ``TRAIN_LIMIT`` labelled ids of either label, the
smallest by id hash. Their words (hashes) meet in one task, whose size that
limit bounds; the thresholds are then moved to the odds of all labels. Every
text is scored whole.

Defined results: NULL and empty texts, and texts without a known word, score
like a text without features; an id with several labels counts as toxic if any
says so; labels with a NULL id or label, or without a document, are not used
(neither for the sample nor for the odds);
without both kinds of labels nothing can be learned and every text gets
severity 0 and is not toxic; repeated rows are judged alike; an empty table
gives an empty result. Only the id, text and label columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import U64, chunks, prefix_sums, span_hash, stored, text_bytes, words

#: Labelled ids of either label that the model is fitted on, at most.
TRAIN_LIMIT = 4_000
#: Bytes of the word beginnings that are features beside the words.
STEMS = (4, 5, 6, 7)
#: Standard errors by which a word's log-rate ratio must differ from zero; L2 penalty; gradient steps.
Z_LEAST, PENALTY, STEPS = 2.0, 1e-3, 400
#: Probability of any severity from which a text counts as toxic.
TOXIC_FROM = 0.3

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def letter_words(raw: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Distinct hashes of each text's words (runs of letters, A-Z lower-cased) and of their beginnings.

    Beginnings of ``STEMS`` bytes stand for the stem that inflected forms share.
    """
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        for lo, hi in chunks(offs):
            b, at = _FOLD[raw[offs[lo]:offs[hi]]], offs[lo:hi + 1] - offs[lo]
            starts, ends, first = words(b, at)
            if not len(starts):
                out += [np.zeros(0, U64)] * (hi - lo)
                continue
            sums = prefix_sums(b)
            h = np.stack([span_hash(sums, starts, ends), *(span_hash(sums, starts, np.minimum(ends, starts + n)) + U64(n) for n in STEMS)], axis=1)
            out += [np.unique(h[i:j]) for i, j in zip(first[:-1], first[1:])]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grades(docs: list[np.ndarray], toxic: np.ndarray, vocabulary: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """0 for clean texts; 1 or 2 for toxic ones by their density of toxic-leaning words."""
    density = np.zeros(len(docs))
    for i, d in enumerate(docs):
        if toxic[i] and len(d):
            r = ratio[np.searchsorted(vocabulary, d)]
            density[i] = r[r > 0].sum() / len(d)
    return np.where(toxic, 1 + (density > np.median(density[toxic])), 0)


def fit_ordinal(indptr: np.ndarray, cols: np.ndarray, scale: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model on 0/scale features, by gradient steps with momentum scaling.

    Thresholds are a first one and positive gaps (their logarithms are fitted),
    so they stay in order.
    """
    n, k = len(indptr) - 1, int(y.max())
    rows = np.repeat(np.arange(n), np.diff(indptr))
    p = np.concatenate([np.ones(len(scale)) * 0.5, [2.0], np.zeros(k - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    above = (y[:, None] >= np.arange(1, k + 1)[None, :]).astype(float)
    for step in range(1, STEPS + 1):
        w, t = p[:len(scale)], np.cumsum(np.concatenate([p[len(scale):len(scale) + 1], np.exp(p[len(scale) + 1:])]))
        z = np.bincount(rows, w[cols] * scale[cols], minlength=n)
        gap = (_sigmoid(z[:, None] - t) - above) / n
        gw = np.bincount(cols, gap.sum(axis=1)[rows] * scale[cols], minlength=len(scale)) + PENALTY * w
        gt = -gap.sum(axis=0)
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, tail[:1], tail[1:] * np.exp(p[len(scale) + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return p[:len(scale)], np.cumsum(np.concatenate([p[len(scale):len(scale) + 1], np.exp(p[len(scale) + 1:])]))


def fitted(rows: pa.Table, odds: float) -> pa.Table:
    """The model of the sample: word hashes, their summands, thresholds (one row, or none).

    ``odds`` are toxic to clean among all labels.
    """
    schema = pa.schema([("hashes", pa.binary()), ("adds", pa.binary()), ("thresholds", pa.binary())])
    docs = [np.frombuffer(x, U64) for x in rows.column("words").to_pylist()]
    toxic = rows.column("toxic").to_numpy() > 0
    if not toxic.any() or toxic.all():
        return schema.empty_table()
    vocabulary, inverse = np.unique(np.concatenate(docs), return_inverse=True)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    in_toxic = np.bincount(inverse, toxic[owner], minlength=len(vocabulary)) + 0.5
    in_clean = np.bincount(inverse, ~toxic[owner], minlength=len(vocabulary)) + 0.5
    ratio = np.log(in_toxic / (toxic.sum() + 1)) - np.log(in_clean / ((~toxic).sum() + 1))
    z = ratio / np.sqrt(1 / in_toxic + 1 / in_clean)
    y = grades(docs, toxic, vocabulary, np.where(z >= Z_LEAST, ratio, 0))
    chosen = np.flatnonzero(np.abs(z) >= Z_LEAST)
    place = np.full(len(vocabulary), -1)
    place[chosen] = np.arange(len(chosen))
    known = place[inverse] >= 0
    indptr = np.concatenate([[0], np.cumsum(np.bincount(owner[known], minlength=len(docs)))])
    w, t = fit_ordinal(indptr, place[inverse][known], ratio[chosen], y)
    t = t + np.log(toxic.sum() / (~toxic).sum() / odds)
    return pa.table([pa.array([vocabulary[chosen].tobytes()], pa.binary()), pa.array([(w * ratio[chosen]).tobytes()], pa.binary()),
                     pa.array([t.tobytes()], pa.binary())], schema=schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The model, or None without both kinds of labels."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    known = stored(known.join(docs.select(F.col(id_col).alias("id")).hint("merge"), "id", "left_semi"), "labels")
    count = {r.toxic > 0: r["count"] for r in known.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    if len(count) < 2:
        return None
    odds = count[True] / count[False]
    of = lambda kind: known.where(kind).orderBy(F.xxhash64("id"), "id").limit(limit)
    sample = of("toxic > 0").unionByName(of("toxic <= 0"))  # at most twice the limit, so it may be broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = letter_words(*text_bytes(b.column(0)))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([x.tobytes() for x in found], pa.binary())], ["toxic", "words"])

    found = texts.select("text", "toxic").mapInArrow(featurise, "toxic int, words binary").withColumn("all", F.lit(1))
    model = found.groupBy("all").applyInArrow(lambda t: fitted(t, odds), "hashes binary, adds binary, thresholds binary").collect()
    if not model:
        return None
    return np.frombuffer(model[0].hashes, U64), np.frombuffer(model[0].adds), np.frombuffer(model[0].thresholds)


def scorer(model: tuple[np.ndarray, np.ndarray, np.ndarray] | None, id_type: pa.DataType) -> Callable:
    """Task function: (id, text) in; severity, grade, p_toxic and the verdict out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = letter_words(*text_bytes(batch.column(1)))
            p = np.zeros((len(docs), 1))
            if model is not None:
                hashes, adds, thresholds = model
                z = np.zeros(len(docs))
                if len(hashes):
                    for i, d in enumerate(docs):
                        at = np.minimum(np.searchsorted(hashes, d), len(hashes) - 1)
                        z[i] = adds[at[hashes[at] == d]].sum()
                p = _sigmoid(z[:, None] - thresholds)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)),
                                              pa.array(p[:, 0]), pa.array(p[:, 0] >= TOXIC_FROM)], ["id", "severity", "grade", "p_toxic", "toxic"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             train_limit: int = TRAIN_LIMIT) -> DataFrame:
    """One row per document: id, severity (expected grade), grade, p_toxic, toxic."""
    from pyspark.sql.pandas.types import to_arrow_type
    model = fit(docs, labels, id_col, text_col, label_col, train_limit)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    out = f"id {kind.simpleString()}, severity double, grade int, p_toxic double, toxic boolean"
    return rows.mapInArrow(scorer(model, to_arrow_type(kind)), out).withColumnRenamed("id", id_col)
