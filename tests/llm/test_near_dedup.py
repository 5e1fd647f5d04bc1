import random
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row

from llm.graph import components, joined
from llm.near_dedup import asker, completion, near_dedup, prefixes, text_sets, totals
from tests.llm.conftest import odd_rows, prose, words


def shingles(text):
    w = words(text)
    if len(w) >= 5:
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows):
    """doc_id -> (n_shingles, component) for rows with an id."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same_id or (a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j])):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)]


def test_odd_rows_and_a_dense_group(spark, odd):
    rng = random.Random(3)
    base = prose(rng, 150).split(" ")
    group = []
    for k in range(400):
        w = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 4, 5])):
            w[rng.randrange(len(w))] = f"new{rng.random()}"
        group.append((1000 + k, " ".join(w)))
    passage = prose(rng, 25)
    group += [(2000 + k, passage + " " + prose(rng, 30)) for k in range(100)]
    more = spark.createDataFrame([Row(doc_id=d, text=t) for d, t in group])
    got = near_dedup(odd.select("doc_id", "text").unionByName(more)).collect()
    want = brute(odd_rows() + group)
    assert sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(repr, want))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_empty(none):
    assert near_dedup(none).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    rng = random.Random(1)
    nodes = list(range(200))
    rng.shuffle(nodes)
    edges = list(zip(nodes[:100], nodes[1:100])) + [(nodes[100], x) for x in nodes[101:150]] + [(5000, 5000), (None, 3), (6000, 6001), (6001, 6000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (nodes[:100], nodes[100:150], [6000, 6001]):
        assert {got[x] for x in part} == {min(part)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    cut = [spark.createDataFrame(x, "a long, b long") for x in (edges[::2], edges[1::2])]
    assert {r.node: r.root for r in joined(components(cut[0]), cut[1]).collect()} == {n: r for n, r in got.items() if n != 5000}


def test_shared_passage_is_complete(spark):
    """Texts just under the limit by one long passage, and pairs of 0.75 to 0.78 among them."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(180)]
    rows = []
    for k in range(1500):
        own = [f"u{k}x{i}" for i in range(32)]
        rows.append((2 * k, " ".join(passage + own)))
        if k % 5 == 0:  # a partner that shares some of the own words as well
            keep = rng.choice([3, 4, 5, 6])
            rows.append((2 * k + 1, " ".join(passage + own[:keep] + [f"v{k}x{i}" for i in range(32 - keep)])))
    rng.shuffle(rows)
    sets = {d: shingles(t) for d, t in rows}
    a, b = sets[0], sets[2]
    assert 0.72 < len(a & b) / len(a | b) < 0.75
    got = near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {}
    for d, s in sets.items():
        partner = sets.get(d - 1) if d % 2 else None
        similar = partner and len(s & partner) / len(s | partner)
        assert similar is None or 0.75 <= similar <= 0.78
        want[d] = d - 1 if similar else d
    assert {r.doc_id: r.component_id for r in got} == want


def crowd(rng):
    """(id, text): variants of one text, texts with a common passage, a long one and ones without words."""
    base, passage = prose(rng, 60).split(" "), prose(rng, 12)
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            w[rng.randrange(len(w))] = f"new{rng.random()}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, passage + " " + prose(rng, 10)) for k in range(40)]
    return rows + [(200, prose(rng, 3000)), (201, ""), (202, None), (203, "one two"), (204, "one two")]


def test_shingles_are_ordered_by_their_counts_in_all_texts():
    rows = crowd(random.Random(12))
    seen = Counter(s for x in text_sets(pa.chunked_array([[t for _, t in rows]]), 5) for s in x.tolist())
    blocks = {b: pa.table({"id": [d for d, _ in rows[b::4]], "text": [t for _, t in rows[b::4]], "root": [d for d, _ in rows[b::4]]}) for b in range(4)}
    asked = pa.concat_tables([asker(5, 3)((pa.scalar(b),), x) for b, x in blocks.items()])
    told = pa.concat_tables([totals(asked.filter(pc.equal(asked.column("shard"), s))) for s in range(3)])
    for b, x in blocks.items():
        got = prefixes(5, 75)(x, told.filter(pc.equal(told.column("block"), b))).to_pylist()
        want = []
        for d, found in zip(x.column("id").to_pylist(), text_sets(x.column("text"), 5)):
            order = sorted(found.tolist(), key=lambda s: (seen[s], s))
            want += [(d, s, len(order), len(order) - i) for i, s in enumerate(order) if 100 * (len(order) - i) >= 75 * len(order) and seen[s] > 1]
        assert [(r["id"], r["shingle"] % (1 << 64), r["n"], r["rest"]) for r in got] == want
    assert max(seen.values()) > 40


def test_completion_has_every_pair_whatever_the_blocks(spark):
    rows = crowd(random.Random(13))
    sets = {d: shingles(t or "") for d, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert len(want) > 50
    texts, roots = spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([], "node long, root long")
    for size in (1 << 20, 3000):
        assert want <= {tuple(r) for r in completion(texts, roots, block_bytes=size, shard_bytes=size).collect()}
