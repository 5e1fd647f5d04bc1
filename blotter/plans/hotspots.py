"""Geographic hotspots: K-Means over valid coordinates, centroid member counts.

``detect_hotspots`` folds the points into the cells of a fine grid over their
extent first: one partial aggregation gives each of the at most ``GRID`` squared
non-empty cells its mean point and its number of points, and ``pyspark.ml``
K-Means (k-means||, euclidean) runs on the cells with that number as weight. So
the iterations work on a bounded table whatever the number of points; a point
moves by at most a cell's diagonal, a thousandth of the extent. Sums are taken
in decimals and the cells are laid out by their place, so the same points give
the same centroids however they are partitioned. The membership count then
predicts on a plain scan of all points.

Counting members is one ``groupBy(prediction)`` joined to the k centroids
(a left join, empty clusters count 0) instead of one filter job per cluster.

``nearest_centroid`` assigns points to a given set of centroids with no join:
the centroids (bounded by k) travel as one array in a scalar subquery and
each point takes the minimum of (squared distance, cluster id) over it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import valid_coords
from blotter.session import scratch_path

#: Cells along each axis, and cells that a partition of the fit holds.
GRID, PARTITION_CELLS = 1024, 1 << 16


def valid_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.filter(valid_coords(lat, lon))


def features(points: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=["latitude", "longitude"], outputCol="features").transform(
        valid_points(points))


def weighted_cells(points: DataFrame, grid: int = GRID) -> DataFrame:
    """Mean point and ``weight`` (points) of each non-empty cell of a grid over the valid points: ix, iy, latitude, longitude, weight."""
    pts = valid_points(points).select("latitude", "longitude")
    ends = pts.agg(*[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("lo", F.min), ("hi", F.max))]).first()

    def place(c):
        lo, hi = ends[f"lo_{c}"] or 0.0, ends[f"hi_{c}"] or 0.0
        return F.least(F.floor((F.col(c) - lo) / ((hi - lo) or 1.0) * grid), F.lit(grid - 1)).cast("int")

    exact = lambda c: F.sum(F.col(c).cast("decimal(20,9)")).cast("double")
    cells = pts.groupBy(place("latitude").alias("ix"), place("longitude").alias("iy")).agg(
        exact("latitude").alias("lat"), exact("longitude").alias("lon"), F.count(F.lit(1)).cast("double").alias("weight"))
    return cells.select("ix", "iy", (F.col("lat") / F.col("weight")).alias("latitude"), (F.col("lon") / F.col("weight")).alias("longitude"), "weight")


def stored_cells(points: DataFrame, grid: int = GRID) -> DataFrame:
    """``weighted_cells`` written once."""
    path = scratch_path(points.sparkSession, f"cells-{uuid.uuid4().hex[:12]}")
    weighted_cells(points, grid).write.parquet(path)
    return points.sparkSession.read.parquet(path)


def fit_hotspots(points: DataFrame, k: int = 10, seed: int = 42, max_iter: int = 20, grid: int = GRID):
    """Fit K-Means on the weighted cells of the valid (latitude, longitude) points; returns the model."""
    return fit_cells(stored_cells(points, grid), k, seed, max_iter)


def fit_cells(cells: DataFrame, k: int, seed: int, max_iter: int):
    """Fit K-Means on stored weighted cells, whose partitions follow from their number and place."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    parts = -(-cells.count() // PARTITION_CELLS) or 1
    laid = cells.repartition(parts, "ix", "iy").sortWithinPartitions("ix", "iy")
    vectors = VectorAssembler(inputCols=["latitude", "longitude"], outputCol="features").transform(laid)
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", weightCol="weight").fit(vectors)


def centroid_counts(centroids: DataFrame, assigned: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Centroids with their member counts (0 when a cluster is empty)."""
    counts = assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("crime_count"))
    return centroids.join(counts, cluster, "left").select(
        F.col(cluster).cast("int").alias("cluster_id"), "latitude", "longitude",
        F.coalesce("crime_count", F.lit(0)).cast("bigint").alias("crime_count"))


def detect_hotspots(points: DataFrame, k: int = 10, seed: int = 42, max_iter: int = 20, grid: int = GRID):
    """(hotspots frame: cluster_id, latitude, longitude, crime_count; fitted model).

    With at most k cells the cells are the hotspots, in their order, and there
    is no model (None).
    """
    spark, cells = points.sparkSession, stored_cells(points, grid)
    few = [(r.latitude, r.longitude) for r in cells.orderBy("ix", "iy").limit(k + 1).collect()]
    if len(few) <= k:
        centroids = spark.createDataFrame([(i, *c) for i, c in enumerate(few)], "cluster_id int, latitude double, longitude double")
        return centroid_counts(centroids, nearest_centroid(valid_points(points), centroids)), None
    model = fit_cells(cells, k, seed, max_iter)
    centers = [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]
    centroids = spark.createDataFrame(centers, "cluster_id int, latitude double, longitude double")
    assigned = model.transform(features(points)).select(F.col("prediction").alias("cluster_id"))
    return centroid_counts(centroids, assigned), model


def seed_centroids(points: DataFrame, k: int = 10, id_col: str = "id", digits: int = 6) -> DataFrame:
    """Deterministic centroids: mean of the valid points per ``id % k`` (rounded)."""
    pts = valid_points(points)
    return pts.groupBy((F.col(id_col) % k).cast("int").alias("cluster_id")).agg(
        F.round(F.avg("latitude"), digits).alias("latitude"),
        F.round(F.avg("longitude"), digits).alias("longitude"))


def nearest_centroid(points: DataFrame, centroids: DataFrame, out: str = "cluster_id") -> DataFrame:
    """Append the id of the nearest centroid (ties: lowest id); centroids must be few (k)."""
    arr = centroids.agg(F.collect_list(F.struct("cluster_id", "latitude", "longitude"))).scalar()

    def score(c):
        dx = F.col("latitude") - c["latitude"]
        dy = F.col("longitude") - c["longitude"]
        return F.struct((dx * dx + dy * dy).alias("d"), c["cluster_id"].alias("cid"))

    return (points.withColumn("__cents", arr)
            .withColumn(out, F.array_min(F.transform("__cents", score))["cid"]).drop("__cents"))


def hotspot_checks(points: DataFrame, k: int = 10, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """One row on a fit: clusters, points counted, whether each point went to a nearest centroid, whether the cost
    is below that of the overall mean as the only centroid."""
    hotspots, model = detect_hotspots(points, k, seed, max_iter)
    centers = F.array(*[F.array(F.lit(float(c[0])), F.lit(float(c[1]))) for c in model.clusterCenters()])  # k pairs
    lat, lon = F.col("latitude"), F.col("longitude")
    d2 = lambda c: (lat - c[0]) * (lat - c[0]) + (lon - c[1]) * (lon - c[1])
    pts = valid_points(points).agg(F.avg("latitude").alias("mx"), F.avg("longitude").alias("my"))
    judged = model.transform(features(points)).select(
        F.element_at(F.transform(centers, d2), F.col("prediction") + 1).alias("own"), F.array_min(F.transform(centers, d2)).alias("least"),
        d2([pts.select("mx").scalar(), pts.select("my").scalar()]).alias("whole"))
    told = judged.agg(F.bool_and(F.col("own") <= F.col("least") * (1 + 1e-9)).alias("all_nearest"), (F.sum("own") < F.sum("whole")).alias("below_mean"))
    sizes = hotspots.agg(F.count(F.lit(1)).alias("clusters"), F.sum("crime_count").alias("points"))
    return sizes.select("clusters", "points", told.select("all_nearest").scalar().alias("all_nearest"), told.select("below_mean").scalar().alias("below_mean"))
