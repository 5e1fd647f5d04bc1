import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard

from llm import repeat_removal
from llm.common import pack_counts, pack_sorted, prefix_sums, span_hash, unpack_counts, unpack_sorted
from llm.repeat_removal import (COVER, FULL, PERIOD, SAMPLE, WHOLE, answer, first_questions, name_size, narrowed, pack_fano, remove_repeats,
                               sampled_places, second_questions, unpack_fano, widened)
from tests.llm.conftest import odd_rows, prose


def brute(rows, window=100):
    """(id, n_bytes, n_removed, n_spans, sha256 of the rest) of every row."""
    docs = {}
    for d, t in rows:
        b = (t or "").encode()
        docs[(d is None, d or 0, hashlib.sha256(b).digest())] = b
    seen, result = set(), {}
    for key in sorted(docs):
        b = docs[key]
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            w = b[i:i + window]
            if w in seen:
                gone[i:i + window] = b"\1" * window
            else:
                seen.add(w)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        result[key] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return [(d, *result[(d is None, d or 0, hashlib.sha256((t or "").encode()).digest())]) for d, t in rows]


def planted():
    rng = random.Random(9)
    passage, other = prose(rng, 60), "é" * 130
    rows = [(500 + k, prose(rng, 30) + " " + passage[k:] + " " + prose(rng, 20)) for k in range(0, 40, 3)]
    rows += [(600, passage + passage), (601, "z" * 400), (602, "z" * 99), (603, "z" * 100), (604, other), (605, "x" + other), (606, "ab" * 300), (607, passage[:99]), (608, passage[5:105])]
    return rows


@pytest.mark.parametrize("block", [2500, 1 << 20])
def test_odd_rows(spark, odd, block):
    small = [(d, t) for d, t in odd_rows() if len(t or "") < 100_000]
    rows = small + planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeats(df, block_bytes=block, shard_bytes=2000).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))


def test_long_texts_and_kept_bytes(spark, odd):
    rows = {r.doc_id: r for r in remove_repeats(odd.where("doc_id in (107, 108)"), with_text=True).collect()}
    assert rows[107].n_removed == 0 and bytes(rows[108].kept) == b" end"


def test_empty(none):
    assert remove_repeats(none).count() == 0


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_packed_arrays_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (unpack_sorted(pack_sorted(keys)) == keys).all()
        counts = rng.integers(0, 1 << int(rng.integers(1, 60)), n)
        assert (unpack_counts(pack_counts(counts)) == counts).all()


def test_windows_of_one_64_bit_hash_are_told_apart(spark):
    """Two windows, different in 14 of their bytes, that share the polynomial hash of common.span_hash."""
    rng = random.Random(2)
    apart = [-2, -4, -6, 5, 6, 3, 0, -2, 2, 0, 3, 0, 1, -1, 0, -2, -5, -2]
    first, tail = "mnopqrstmnopqrstmn", "".join(rng.choice("abcdefgh") for _ in range(82))
    second = "".join(chr(ord(c) + d) for c, d in zip(first, apart))
    windows = [np.frombuffer((x + tail).encode(), np.uint8) for x in (first, second)]
    assert len({int(span_hash(prefix_sums(w), np.array([0]), np.array([100]))[0]) for w in windows}) == 1
    rows = [(1, "0" * 40 + first + tail + "1" * 40), (2, "2" * 40 + second + tail + "3" * 40)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert {r.doc_id: bytes(r.kept).decode() for r in got} == dict(rows)


def test_names():
    assert [name_size(n) for n in (0, 1 << 29, 30 << 30, 1 << 46, 1 << 60)] == [(48, 4), (57, 4), (59, 5), (59, 8), (64, 8)]
    words = np.random.default_rng(3).integers(0, 1 << 40, 50, dtype=np.uint64)
    for width in (5, 8):
        assert (widened(narrowed(words, width), 50) == words).all()
    assert len(widened(b"", 0)) == 0


def test_sorted_keys_round_trip():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 1000):
        for top in (1, 5, 300, 1 << 21, 1 << 40, (1 << 64) - 1):
            keys = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))  # also repeated ones
            assert (unpack_fano(pack_fano(keys)) == keys).all()
    keys = np.sort(rng.integers(0, 1 << 40, 1 << 16, dtype=np.uint64))
    assert len(pack_fano(keys)) < (40 - 16 + 2) / 8 * len(keys) + 100


def test_sampled_places_are_the_cover_of_every_text():
    rng = random.Random(4)
    for reach in (70, 1, 40):
        sizes = [0, 1, reach - 1, reach, 31, 62, *(rng.randint(0, 300) for _ in range(20))]
        at = np.cumsum([0, *sizes])
        want = [a + i for a, n in zip(at, sizes) for i in range(n) if i % PERIOD in COVER and i + reach <= n]
        assert sampled_places(at, reach).tolist() == want


@pytest.mark.parametrize("repeat", [False, True])
def test_bytes_are_summed_once_where_nothing_repeats(monkeypatch, repeat):
    """A round sums a chunk's bytes for the sampled names, and again only for windows in question."""
    calls = []
    monkeypatch.setattr(repeat_removal, "prefix_sums", lambda b, w=None: calls.append(len(b)) or prefix_sums(b, w))
    rng = random.Random(6)
    texts = [prose(rng, 200) for _ in range(20)]
    texts += [texts[3][50:400] + "x"] * repeat
    packed = [zstandard.ZstdCompressor().compress(t.encode()) for t in texts]
    table, key, args = pa.table({"id": list(range(len(texts))), "packed": packed}), (pa.scalar(0),), (100, 40, (56, 5), 1)
    asked = first_questions(*args)(key, table)
    told = pa.concat_tables([answer(asked.filter(pc.equal(asked.column("kind"), k))) for k in (SAMPLE, WHOLE)])
    assert len(calls) == 1
    calls.clear()
    more = second_questions(*args)(key, table, told)
    assert set(more.column("kind").to_pylist()) == ({FULL} if repeat else set())
    assert len(calls) == (3 if repeat else 1)
