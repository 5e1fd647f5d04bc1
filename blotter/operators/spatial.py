"""Nearest site (e.g. police station) for every point, Euclidean in the coordinate plane.

At most ``FEW`` sites (after counting) travel as one array and a point takes
the least over it: no shuffle. Beyond that the sites form a tree of grid cells,
each cell divided into 4 by 4, and the points descend it level by level:

* A level's table has a row per non-empty cell: the bounding box and number of
  its sites, and one of them. The first level's at most 256 cells travel as one
  array; each later level is one equi-join of the points' open cells with the
  cells inside them.
* The distance to a cell's own site bounds the nearest from above; the distance
  to its box bounds all of its sites from below. A point drops the cells whose
  box is beyond its bound, so it keeps the few that can still hold its nearest
  site, however far away it lies. A cell of one site is settled by it.
* The tree ends where no cell holds more than ``LEAF`` sites, and the cells
  still open join the sites in them. The minimum per point is the answer.

Cells that many points share are salted (``spread_join``); sites at one place
are one site, the smallest id. Sites stay on the executors: the driver sees
their number and extent, and the fullest cell of a level.

Sites without finite coordinates are no sites; a point without them has no
nearest site (NULL), as has every point when there is none. Of equally near
sites the smallest id wins, a NULL id last. Points need no id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.joins import spread_join
from blotter.session import scratch_path

#: Sites that travel as one array, sites of a cell that is not divided, and the deepest level.
FEW, LEAF, DEEPEST = 256, 64, 15
#: The level whose cells (at most 16 ** 2) travel as one array.
TOP = 2


def _finite_value(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def _finite(c: str) -> Column:
    return _finite_value(F.col(c))


def _d2(dx: Column, dy: Column) -> Column:
    return dx * dx + dy * dy


def _site(px: Column, py: Column, sx: Column, sy: Column, sid: Column) -> Column:
    """A candidate, ordered by distance, then id (NULL last)."""
    return F.struct(_d2(px - sx, py - sy).alias("d2"), sid.isNull().alias("none"), sid.alias("sid"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"nearest-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cell(level: int) -> Column:
    """A site's cell at a level as one number, from its place (ix, iy) in the finest grid."""
    up = 2 * (DEEPEST - level)
    return F.shiftright("ix", up) * F.lit(4 ** level) + F.shiftright("iy", up)


def _cells(sites: DataFrame, level: int) -> DataFrame:
    """The level's non-empty cells: cell, the cell above, box, number of sites, and one site."""
    return sites.groupBy(_cell(level).alias("cell"), _cell(level - 1).alias("above")).agg(
        F.min("sx").alias("x0"), F.max("sx").alias("x1"), F.min("sy").alias("y0"), F.max("sy").alias("y1"),
        F.count(F.lit(1)).alias("n"), F.min(F.struct("sx", "sy", "sid")).alias("one"))


def _reach(c: Column) -> Column:
    """What a cell means to a point px, py: the cell, its number, the least distance, and its own site as a candidate."""
    px, py = F.col("px"), F.col("py")
    out = lambda p, lo, hi: F.greatest(lo - p, p - hi, F.lit(0.0))
    return F.struct(c["cell"].alias("cell"), c["n"].alias("n"), _d2(out(px, c["x0"], c["x1"]), out(py, c["y0"], c["y1"])).alias("least"),
                    _site(px, py, c["one"]["sx"], c["one"]["sy"], c["one"]["sid"]).alias("own"))


def _narrowed(points: DataFrame) -> DataFrame:
    """Points with ``near`` (cells as ``_reach``) and the best site so far: the best now, and the cells still open."""
    best = F.array_min(F.array_append(F.transform("near", lambda c: c["own"]), F.col("best")))
    points = points.withColumn("best", best)
    # a cell of one site has said all it can
    still = F.filter("near", lambda c: (c["n"] > 1) & (c["least"] <= F.col("best.d2")))
    return points.withColumn("open", F.transform(still, lambda c: c["cell"])).drop("near")


def _descended(points: DataFrame, sites: DataFrame, levels: int) -> DataFrame:
    """r, best of every point, by descending the tree; ``sites`` have sx, sy, sid, ix, iy."""
    no_site = F.lit(None).cast(f"struct<d2:double,none:boolean,sid:{sites.schema['sid'].dataType.simpleString()}>")
    top = _cells(sites, TOP).agg(F.collect_list(F.struct("cell", "n", "x0", "x1", "y0", "y1", "one"))).scalar()
    points = points.withColumns({"best": no_site, "top": top})
    state = _narrowed(points.withColumn("near", F.transform("top", _reach)).drop("top"))
    done = []
    for level in range(TOP + 1, levels + 1):
        state = _stored(state, f"level-{level}")
        done.append(state.where(F.size("open") == 0).select("r", "best"))
        opened = state.where(F.size("open") > 0).select("r", "px", "py", "best", F.explode("open").alias("above"))
        inside = spread_join(opened, _cells(sites, level), "above", "r")
        near = inside.groupBy("r").agg(F.first("px").alias("px"), F.first("py").alias("py"), F.first("best").alias("best"),
                                       F.collect_list(_reach(F.struct("cell", "n", "x0", "x1", "y0", "y1", "one"))).alias("near"))
        state = _narrowed(near)
    state = _stored(state, "leaves")
    opened = state.where(F.size("open") > 0).select("r", "px", "py", F.explode("open").alias("cell"))
    last = spread_join(opened, sites.select(_cell(levels).alias("cell"), "sx", "sy", "sid"), "cell", "r")
    done += [state.select("r", "best"), last.select("r", _site(F.col("px"), F.col("py"), F.col("sx"), F.col("sy"), F.col("sid")).alias("best"))]
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    return every.groupBy("r").agg(F.min("best").alias("best"))


def nearest_site(points: DataFrame, sites: DataFrame, site_id: str = "district", x: str = "latitude", y: str = "longitude",
                 few: int = FEW, leaf: int = LEAF) -> DataFrame:
    """``points`` + ``nearest_site`` (ties: smallest id) + ``nearest_d2`` (squared distance)."""
    real = sites.select(F.col(site_id).alias("sid"), F.col(x).cast("double").alias("sx"), F.col(y).cast("double").alias("sy"))
    real = real.where(_finite("sx") & _finite("sy")).groupBy("sx", "sy").agg(F.min("sid").alias("sid"))
    size = real.agg(F.count(F.lit(1)).alias("n"), F.min("sx").alias("x0"), F.max("sx").alias("x1"), F.min("sy").alias("y0"), F.max("sy").alias("y1")).first()
    columns = [F.col(f"`{c}`") for c in points.columns]
    answer = [F.col("__best.sid").alias("nearest_site"), F.col("__best.d2").alias("nearest_d2")]
    if size["n"] <= few:
        every = real.agg(F.collect_list(F.struct("sx", "sy", "sid"))).scalar()
        px, py = F.col(x).cast("double"), F.col(y).cast("double")
        found = F.array_min(F.transform("__sites", lambda s: _site(px, py, s["sx"], s["sy"], s["sid"])))
        out = points.withColumn("__sites", every).withColumn("__best", F.when(_finite_value(px) & _finite_value(py), found))
        return out.select(*columns, *answer)

    # each cell is a square of the wider extent, so that it is about as high as it is wide
    width = max(size["x1"] - size["x0"], size["y1"] - size["y0"]) or 1.0
    place = lambda c, lo: F.least(F.floor((F.col(c) - lo) / width * 4 ** DEEPEST).cast("long"), F.lit(4 ** DEEPEST - 1))
    real = _stored(real.withColumns({"ix": place("sx", size["x0"]), "iy": place("sy", size["y0"])}), "sites")
    levels = TOP
    while levels < DEEPEST and real.groupBy(_cell(levels).alias("cell")).count().agg(F.max("count")).first()[0] > leaf:
        levels += 1
    kept = _stored(points.withColumn("__r", F.monotonically_increasing_id()), "points")
    placed = kept.select(F.col("__r").alias("r"), F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")).where(_finite("px") & _finite("py"))
    best = _descended(placed, real, levels).select(F.col("r").alias("__r"), F.col("best").alias("__best"))
    return kept.join(best, "__r", "left").select(*columns, *answer)
