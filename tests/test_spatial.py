"""Nearest site agrees with brute force, by the array and by the tree, and for odd points and sites."""

import random

import pytest

from blotter.operators.spatial import nearest_site

SITES = "district string, latitude double, longitude double"
POINTS = "id long, latitude double, longitude double"


def _brute(pts, sites):
    out = []
    for i, px, py in pts:
        best = min((((px - sx) ** 2 + (py - sy) ** 2, s) for s, sx, sy in sites if sx is not None and sy is not None), default=None) \
            if px is not None and py is not None else None
        out.append((i, *((best[1], round(best[0], 6)) if best else (None, None))))
    return sorted(map(repr, out))


def _got(spark, pts, sites, **kw):
    found = nearest_site(spark.createDataFrame(pts, POINTS), spark.createDataFrame(sites, SITES), **kw)
    return sorted(repr((r.id, r.nearest_site, None if r.nearest_d2 is None else round(r.nearest_d2, 6))) for r in found.collect())


@pytest.mark.parametrize("how", [{}, {"few": 0}, {"few": 7, "leaf": 2}])
def test_nearest_site_exact(spark, how):
    rnd = random.Random(11)
    sites = [(f"s{j:03d}", rnd.uniform(0, 100), rnd.uniform(0, 50)) for j in range(60)]
    sites += [("none", None, 3.0), ("void", 3.0, None), ("twin", *sites[5][1:])]
    pts = [(i, rnd.uniform(-20, 120), rnd.uniform(-10, 60)) for i in range(300)]
    pts += [(1000 + i, 50.0, 25.0) for i in range(50)]                      # many in one place
    pts += [(7, 1.0, 1.0), (7, 99.0, 49.0), (8, None, 1.0), (9, 1.0, None)]  # repeated id, no coordinates
    pts += [(10, 1e6, 3e7), (11, 50.0, -1e9)]                               # far outliers
    assert _got(spark, pts, sites, **how) == _brute(pts, sites)


def test_dense_cells_and_levels(spark):
    """Sites packed into a speck beside a wide field, sites in one place, points packed on a cell: several levels deep."""
    rnd = random.Random(12)
    sites = [(f"d{j:03d}", 50 + rnd.uniform(0, 1e-3), 20 + rnd.uniform(0, 1e-3)) for j in range(150)]
    sites += [(f"w{j:03d}", rnd.uniform(0, 100), rnd.uniform(0, 50)) for j in range(100)] + [(f"p{j:02d}", 3.0, 3.0) for j in range(30)]
    sites += [("nan", float("nan"), 1.0), ("far", float("inf"), 1.0)]
    pts = [(i, 50 + rnd.uniform(0, 1e-3), 20 + rnd.uniform(0, 1e-3)) for i in range(200)] + [(300 + i, rnd.uniform(-50, 150), rnd.uniform(-50, 100)) for i in range(200)]
    pts += [(600, 3.0, 3.0), (601, -1e7, 4e6), (602, float("nan"), 1.0), (603, float("inf"), 1.0), (604, 50.0, 20.0)]
    sound = [s for s in sites if s[0] not in ("nan", "far")]
    want = _brute(pts[:-3] + [(602, None, 1.0), (603, None, 1.0), pts[-1]], sound)
    assert _got(spark, pts, sites, few=10, leaf=4) == want


def test_tree_in_one_place_and_null_ids(spark):
    assert _got(spark, [(1, 0.0, 0.0)], [("b", 1.0, 1.0), ("a", 1.0, 1.0)], few=0) == [repr((1, "a", 2.0))]
    assert _got(spark, [(1, 0.0, 0.0)], [(None, 1.0, 0.0), ("a", 0.0, 1.0)], few=0) == [repr((1, "a", 1.0))]


def test_hot_key_join(spark):
    """Hot left keys are dealt to several salts and lose or double no pair."""
    from blotter.operators.joins import hot_keys, spread_join
    left = spark.range(900).selectExpr("id", "case when id < 500 then 7 else id % 100 + 10 end as k")
    right = spark.createDataFrame([(7, "a"), (7, "b"), (20, "c"), (999, "d")], "k long, v string")
    assert set(hot_keys(left, "k", 8)) == {7} and hot_keys(left, "k", 8)[7] >= 2
    got = sorted(map(tuple, spread_join(left, right, "k", "id", 8).select("id", "k", "v").collect()))
    assert got == sorted(map(tuple, left.join(right, "k").select("id", "k", "v").collect())) and len(got) == 1004


def test_ties_and_no_site(spark):
    sites = [("b", 0.0, 1.0), ("a", 0.0, -1.0), ("c", 1.0, 0.0), ("a0", -1.0, 0.0)]
    assert _got(spark, [(1, 0.0, 0.0)], sites) == [repr((1, "a", 1.0))]
    assert _got(spark, [(1, 0.0, 0.0)], [("x", None, None)]) == [repr((1, None, None))]
    assert _got(spark, [], sites) == []
