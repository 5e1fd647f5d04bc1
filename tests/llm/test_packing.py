import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.packing import CAPACITY, SLACK, Bins, cut, default_ranks, encoder_of, pack
from tests.llm.conftest import odd_rows


def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@given(st.integers(1, 20_000))
def test_cut_covers_the_document_with_little_waste(n):
    pieces = cut(n)
    assert sum(p for p, _ in pieces) == n
    for length, j in pieces:
        assert 1 <= length and length * j <= CAPACITY
        assert CAPACITY // j - length <= SLACK * (CAPACITY // j)


@given(st.lists(st.integers(1, 6000), max_size=60))
def test_bins_hold_every_token_once(lengths):
    bins, rows = Bins(7, CAPACITY), []
    for d, n in enumerate(lengths):
        start = 0
        for length, j in cut(n):
            rows += bins.add(j, (d, start, length))
            start += length
    for s in bins.rest():
        rows += s
    by = defaultdict(list)
    for d, start, length, seq, off in rows:
        by[seq].append((off, length))
    for held in by.values():
        held.sort()
        assert [o for o, _ in held] == list(np.cumsum([0, *[n for _, n in held]])[:-1]) and sum(n for _, n in held) <= CAPACITY
    assert sum(r[2] for r in rows) == sum(lengths)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Zé'\n\t .,!1   \x1csñ<|>中"), max_size=60))
def test_word_cache_gives_the_tokenizer_ids(text):
    t = tokenizer_once()
    assert encoder_of(default_ranks()).ids(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_held = []


def tokenizer_once():
    if not _held:
        _held.append(tokenizer())
    return _held[0]


def test_special_token_text_is_ordinary():
    t = tokenizer_once()
    text = "a <|endoftext|> b <|endoftext|>"
    assert encoder_of(default_ranks()).ids(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_odd_rows(odd):
    t = tokenizer_once()
    want = defaultdict(int)
    for i, x in odd_rows():
        want[(i, len(t.encode(x or "", add_special_tokens=False).ids) + 1)] += 1
    ids = {len(x or ""): np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for _, x in odd_rows()}
    rows = pack(odd).collect()
    tokens = defaultdict(int)
    by = defaultdict(list)
    known = {len(v): v for v in ids.values()}
    for r in rows:
        tokens[(r.doc_id, r.doc_tokens)] += r.length
        by[r.sequence_id].append((r.offset, r.length))
        if r.doc_tokens in known and list(known).count(r.doc_tokens) == 1 and r.doc_id == 107:
            assert zlib.crc32(known[r.doc_tokens][r.start:r.start + r.length].tobytes()) == r.ids_crc32
    assert {k: v for k, v in tokens.items()} == {k: k[1] * n for k, n in want.items()}
    for held in by.values():
        at = 0
        for off, n in sorted(held):
            assert off == at
            at += n
        assert at <= CAPACITY


def test_empty(none):
    assert pack(none).count() == 0
