"""K-Means hotspots: properties, not exact centroids."""

from pyspark.sql import functions as F

from tests.conftest import SMALL

from blotter.plans import hotspots as HS
from blotter.sources import testtables as TT


def test_kmeans_hotspots_properties(spark):
    pts = TT.points(spark, SMALL)
    hs, model = HS.detect_hotspots(pts, k=4, seed=42, max_iter=10)
    rows = hs.collect()
    assert len(rows) == 4
    assert sum(r.crime_count for r in rows) == HS.valid_points(pts).count()
    again, _ = HS.detect_hotspots(pts.repartition(7), k=4, seed=42, max_iter=10)  # whatever the layout of the points
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in rows)


def test_nearest_centroid_is_nearest(spark):
    pts = HS.valid_points(TT.points(spark, SMALL))
    cents = HS.seed_centroids(pts, 5)
    c = {r.cluster_id: (r.latitude, r.longitude) for r in cents.collect()}
    for r in HS.nearest_centroid(pts, cents).collect():
        d = {k: (r.latitude - v[0]) ** 2 + (r.longitude - v[1]) ** 2 for k, v in c.items()}
        assert d[r.cluster_id] == min(d.values())


def test_invalid_coordinates_excluded(spark):
    pts = TT.points(spark, SMALL)
    v = HS.valid_points(pts)
    assert v.filter((F.col("latitude") == 0) | F.col("longitude").isNull()).count() == 0


def test_cells_keep_every_point_and_fit_as_well(spark):
    """The cells hold all valid points; the fit on them costs at most 5 % more than one on the points."""
    from pyspark.ml.clustering import KMeans
    pts = TT.points(spark, SMALL)
    valid = HS.valid_points(pts)
    for grid in (8, 1024):
        cells = HS.weighted_cells(pts, grid)
        assert cells.agg(F.sum("weight")).first()[0] == valid.count() and cells.count() <= grid * grid
        row = cells.agg(F.sum(F.col("latitude") * F.col("weight")), F.sum(F.col("longitude") * F.col("weight"))).first()
        want = valid.agg(F.sum("latitude"), F.sum("longitude")).first()
        assert all(abs(a - b) <= 1e-6 * abs(b) for a, b in zip(row, want))
    rows = [(r.latitude, r.longitude) for r in valid.collect()]
    cost = lambda centers: sum(min((a - x) ** 2 + (b - y) ** 2 for x, y in centers) for a, b in rows)
    full = KMeans(k=6, seed=42, maxIter=20, featuresCol="features").fit(HS.features(pts).repartition(1, "id").sortWithinPartitions("id"))
    folded = HS.fit_hotspots(pts, k=6, seed=42, max_iter=20)
    assert cost(folded.clusterCenters()) <= 1.05 * cost(full.clusterCenters())


def test_hotspots_of_one_place_and_none(spark):
    one = spark.createDataFrame([(i, 41.5, -87.5) for i in range(20)] + [(99, None, 1.0)], "id long, latitude double, longitude double")
    hs, _ = HS.detect_hotspots(one, k=2)
    assert [tuple(r) for r in hs.collect()] == [(0, 41.5, -87.5, 20)]
    none, _ = HS.detect_hotspots(one.where("id = 99"), k=3)
    assert none.count() == 0
