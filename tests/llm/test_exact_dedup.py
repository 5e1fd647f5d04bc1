import hashlib
import re

from pyspark.sql import functions as F

from llm.exact_dedup import exact_dedup
from tests.llm.conftest import odd_rows


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected():
    groups = {}
    for i, t in odd_rows():
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in odd_rows():
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_rows(odd):
    assert sorted((tuple(r) for r in exact_dedup(odd).collect()), key=repr) == expected()


def test_colliding_hashes_are_told_apart_by_bytes(odd):
    weak = lambda c: F.crc32(c) % 3
    assert sorted((tuple(r) for r in exact_dedup(odd, content_hash=weak).collect()), key=repr) == expected()


def test_empty(none):
    assert exact_dedup(none).count() == 0
