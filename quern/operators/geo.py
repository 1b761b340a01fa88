"""GEO-1 (with JOIN-2, FN-6, FN-7, AGG-13): the farthest pair of stations.

The reference crosses every station with every other one. Here no pair list of
the whole input is ever built:

* ``degrees`` (planar, the reference's metric): the farthest pair of a planar
  set lies on its convex hull. Every task of the scan folds its batches into hull rows
  (``mapInPandas``); only these are exchanged and folded again, and rotating calipers
  search the last hull. The two smallest ids of a point are kept, so ties between equal
  points are still decided by ids.
* ``haversine``: when every point lies in the open hemisphere around the
  centre direction c (checked exactly), the farthest point from any q is a
  vertex of the planar hull of the points' orthographic projection on the
  tangent plane at c (−x·q is convex in those coordinates), so the same hull
  pruning applies. Otherwise the partner of a point is the point nearest to its
  antipode: with a lower bound from sweeps, points and antipodes are hashed on a 3-D grid
  as wide as the bound leaves open and joined on neighbouring cells (salted).

Output: one row ``(station_a, station_b, distance)`` with ``station_a < station_b``,
largest distance, ties broken by the smallest ids; ``distance`` rounded to 6.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.columns import EARTH_RADIUS_KM, euclidean, haversine
from quern.operators.joins import salted_join

FOLD_ROWS = 65_536


def _strict_hull(xy: np.ndarray) -> np.ndarray:
    """Indices of the strict convex hull of unique points, counter-clockwise."""
    if len(xy) <= 2:
        return np.arange(len(xy))
    order = np.lexsort((xy[:, 1], xy[:, 0]))

    def half(seq):
        out = []
        for k in seq:
            while len(out) >= 2:
                o, a, p = xy[out[-2]], xy[out[-1]], xy[k]
                if (a[0] - o[0]) * (p[1] - o[1]) - (a[1] - o[1]) * (p[0] - o[0]) <= 0:
                    out.pop()
                else:
                    break
            out.append(k)
        return out
    lower, upper = half(order), half(order[::-1])
    return np.array(lower[:-1] + upper[:-1])


def _inside_extremes(xy: np.ndarray) -> np.ndarray:
    """Points strictly inside the polygon of the extreme points of eight directions:
    no hull vertex is among them, and few points are left for the chain."""
    x, y = xy[:, 0], xy[:, 1]
    far = [x.argmin(), (x + y).argmin(), y.argmin(), (x - y).argmax(),
           x.argmax(), (x + y).argmax(), y.argmax(), (x - y).argmin()]
    corners = xy[list(dict.fromkeys(int(k) for k in far))]
    if len(corners) < 3:
        return np.zeros(len(xy), dtype=bool)
    scale = max(np.ptp(x), np.ptp(y)) or 1.0
    inside = np.ones(len(xy), dtype=bool)
    for o, a in zip(corners, np.roll(corners, -1, axis=0)):
        inside &= (a[0] - o[0]) * (y - o[1]) - (a[1] - o[1]) * (x - o[0]) > 1e-12 * scale * scale
    return inside


def _hull_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows at hull vertices, of each point the two smallest ids."""
    pdf = pdf.drop_duplicates(["id", "x", "y"]).sort_values(["x", "y", "id"], kind="stable")
    pdf = pdf[pdf.groupby(["x", "y"], sort=False).cumcount() < 2]
    first = pdf.drop_duplicates(["x", "y"])[["x", "y"]]
    first = first[~_inside_extremes(first.to_numpy())]
    vertices = first.iloc[_strict_hull(first.to_numpy())]
    return pdf.merge(vertices, on=["x", "y"])


def _hull_points(batches):
    """Fold the batches of a task into the rows of its hull."""
    held, waiting, n = None, [], 0
    for pdf in batches:
        if len(pdf):
            waiting.append(pdf)
            n += len(pdf)
        if n >= FOLD_ROWS:
            held = _hull_rows(pd.concat(waiting if held is None else [held, *waiting], ignore_index=True))
            waiting, n = [], 0
    if waiting:
        held = _hull_rows(pd.concat(waiting if held is None else [held, *waiting], ignore_index=True))
    if held is not None:
        yield held


def _planar(lat1, lon1, lat2, lon2):
    dx, dy = lat1 - lat2, lon1 - lon2
    return np.sqrt(dx * dx + dy * dy)


def _great_circle(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = (np.sin((p2 - p1) / 2) ** 2
         + np.cos(p1) * np.cos(p2) * np.sin((np.radians(lon2) - np.radians(lon1)) / 2) ** 2)
    return np.arcsin(np.sqrt(np.minimum(1.0, h)))


def _antipodal_pairs(h: np.ndarray) -> list[tuple[int, int]]:
    """All antipodal vertex pairs of a CCW convex polygon (rotating calipers).

    Every diametral pair is antipodal, so the planar farthest pairs (ties
    included) are among these O(h) pairs.
    """
    n = len(h)
    if n < 3:
        return [(0, 1)] if n == 2 else []

    def area(i, j, k):
        a, b, c = h[i], h[j], h[k]
        return abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    pairs = set()
    j = 1
    for i in range(n):
        ni = (i + 1) % n
        while area(i, ni, (j + 1) % n) > area(i, ni, j):
            j = (j + 1) % n
        for a in (i, ni):
            pairs.add((min(a, j), max(a, j)))
        if area(i, ni, (j + 1) % n) == area(i, ni, j):      # parallel edges
            for a in (i, ni):
                pairs.add((min(a, (j + 1) % n), max(a, (j + 1) % n)))
    return sorted(p for p in pairs if p[0] != p[1])


def _farthest_planar(batches):
    """Planar farthest pair of the hull rows by rotating calipers; ties → smallest (a, b).

    Each vertex stands for the smallest id at its coordinates; points that all lie at
    one place give its two smallest ids.
    """
    frames = list(_hull_points(batches))
    if not frames:
        return
    pdf = frames[0].sort_values("id", kind="stable")
    first = pdf.drop_duplicates(["x", "y"])
    if len(first) == 1:
        if len(pdf) > 1:
            yield pd.DataFrame({"station_a": pdf["id"].iloc[:1].to_numpy(), "station_b": pdf["id"].iloc[1:2].to_numpy()})
        return
    xy, ids = first[["x", "y"]].to_numpy(), first["id"].to_numpy()
    hull = _strict_hull(xy)
    pts, ids = xy[hull], ids[hull]
    pairs = np.array(_antipodal_pairs(pts))
    d = _planar(pts[pairs[:, 0], 0], pts[pairs[:, 0], 1], pts[pairs[:, 1], 0], pts[pairs[:, 1], 1])
    ends = np.sort(ids[pairs[d == d.max()]], axis=1)
    best = ends[np.lexsort((ends[:, 1], ends[:, 0]))[0]]
    yield pd.DataFrame({"station_a": best[:1], "station_b": best[1:]})


def _farthest_on_sphere(batches):
    """Great-circle farthest pair of hull rows, one row against all after it."""
    frames = list(_hull_points(batches))
    if not frames:
        return
    pdf = frames[0].sort_values("id", kind="stable")
    ids, lat, lon = pdf["id"].to_numpy(), pdf["lat"].to_numpy(), pdf["lon"].to_numpy()
    best = (-1.0, None, None)
    for i in range(len(ids) - 1):
        d = _great_circle(lat[i], lon[i], lat[i + 1:], lon[i + 1:])
        j = int(np.argmax(d))
        if d[j] > best[0]:
            best = (float(d[j]), int(ids[i]), int(ids[i + 1 + j]))
    if best[1] is not None:
        yield pd.DataFrame({"station_a": [best[1]], "station_b": [best[2]]})


def _hull_pair(pts: DataFrame, farthest=_farthest_planar, fan_in: int = 32) -> DataFrame:
    """Farthest pair among the points whose plane coordinates (x, y) are hull vertices.

    The first step runs in the tasks of the scan; only hull rows are exchanged.
    """
    schema = "id long, x double, y double, lat double, lon double"
    cur = pts.mapInPandas(_hull_points, schema)
    n = int(pts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    while n > fan_in:
        n = math.ceil(n / fan_in)
        cur = cur.repartition(n, "id").mapInPandas(_hull_points, schema)
    return cur.repartition(1).mapInPandas(farthest, "station_a long, station_b long")


def _unit(lat, lon):
    la, lo = F.radians(lat), F.radians(lon)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def _chord(ax, ay, az, bx, by, bz):
    return F.sqrt(F.pow(ax - bx, 2) + F.pow(ay - by, 2) + F.pow(az - bz, 2))


SWEEPS = 4


def _sphere_pair(pts: DataFrame, salts: int) -> DataFrame:
    ux, uy, uz = _unit(F.col("x"), F.col("y"))
    p = pts.select("id", "x", "y", ux.alias("px"), uy.alias("py"), uz.alias("pz"))
    # Three global scalars, each one aggregate over the points (a few numbers
    # reach the driver, never rows): centre direction, enclosing radius, and a
    # lower bound from a double sweep (farthest point from the farthest point).
    sx, sy, sz = p.agg(F.sum("px"), F.sum("py"), F.sum("pz")).first()
    norm = math.sqrt(sx * sx + sy * sy + sz * sz) or 1.0
    cx, cy, cz = sx / norm, sy / norm, sz / norm
    p = p.withColumn("rc", _chord(F.col("px"), F.col("py"), F.col("pz"),
                                  F.lit(cx), F.lit(cy), F.lit(cz)))
    big_r, far = p.agg(F.max("rc"), F.max_by(F.struct("px", "py", "pz"), "rc")).first()
    # Tangent basis at c: e = c × z (or x-axis at a pole), f = c × e.
    ex, ey, ez = -cy, cx, 0.0
    en = math.hypot(ex, ey)
    ex, ey = (ex / en, ey / en) if en > 0 else (1.0, 0.0)
    fx, fy, fz = cy * ez - cz * ey, cz * ex - cx * ez, cx * ey - cy * ex
    if big_r * big_r < 2.0 - 1e-9:
        # Every point within the open hemisphere around c (|p - c|² < 2 ⇔ p·c > 0):
        # for a fixed q, -x·q is convex in the orthographic coordinates
        # u = (x·e, x·f) of x, so the farthest point from q is a vertex of the
        # planar hull of the projected points. Exact hull pruning applies.
        proj = p.select("id", (F.col("px") * ex + F.col("py") * ey + F.col("pz") * ez).alias("x"),
                        (F.col("px") * fx + F.col("py") * fy + F.col("pz") * fz).alias("y"),
                        F.col("x").alias("lat"), F.col("y").alias("lon"))
        return _hull_pair(proj, _farthest_on_sphere)
    # Points beyond the hemisphere: a lower bound of the answer from sweeps (the farthest
    # point from the last one found), each one aggregate. Points farther apart than
    # ``low`` are close to antipodal, |a + b|² = 4 - |a - b|², so with cells of that
    # width b lies in the cell of -a or next to it.
    low = 0.0
    for _ in range(SWEEPS):
        gap = _chord(F.col("px"), F.col("py"), F.col("pz"), F.lit(far[0]), F.lit(far[1]), F.lit(far[2]))
        reach, far = p.agg(F.max(gap), F.max_by(F.struct("px", "py", "pz"), gap)).first()
        if reach <= low:
            break
        low = reach
    near = math.sqrt(max(0.0, 4.0 - low * low)) * (1 + 1e-9) + 1e-6
    # One row per place (its smallest id): copies of a place make no pairs.
    place = p.groupBy("x", "y", "px", "py", "pz").agg(F.min("id").alias("id"))
    axes = ("px", "py", "pz")
    left = place.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"),
                        *[F.col(c).alias(f"a{c}") for c in axes],
                        *[F.floor(-F.col(c) / near).alias(f"c{c}") for c in axes])
    for c in axes:
        left = left.withColumn(f"c{c}", F.explode(F.array(*[F.col(f"c{c}") + k for k in (-1, 0, 1)])))
    right = place.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"),
                         *[F.col(c).alias(f"b{c}") for c in axes],
                         *[F.floor(F.col(c) / near).alias(f"c{c}") for c in axes])
    cand = salted_join(left, right, [f"c{c}" for c in axes], salts).where("a < b")
    cand = cand.where(_chord(*[F.col(f"a{c}") for c in axes], *[F.col(f"b{c}") for c in axes]) >= low - 1e-9)
    d = haversine(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    return cand.select(F.col("a").alias("station_a"), F.col("b").alias("station_b"), d.alias("_d")) \
        .orderBy(F.col("_d").desc(), "station_a", "station_b").limit(1).select("station_a", "station_b")


def farthest_pair(points: DataFrame, id_col: str = "id", lat: str = "lat", lon: str = "long",
                  metric: str = "degrees", radius: float = EARTH_RADIUS_KM,
                  salts: int = 8) -> DataFrame:
    """GEO-1: ``(station_a, station_b, distance)`` of the farthest pair (see module doc)."""
    pts = points.select(F.col(id_col).cast("long").alias("id"), F.col(lat).cast("double").alias("x"),
                        F.col(lon).cast("double").alias("y")).na.drop()
    if metric == "degrees":
        pair = _hull_pair(pts.select("id", "x", "y", F.col("x").alias("lat"), F.col("y").alias("lon")))
        dist = euclidean(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    elif metric == "haversine":
        pair = _sphere_pair(pts, salts)
        dist = haversine(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), radius)
    else:
        raise ValueError(f"unknown metric {metric!r}")
    # The pair is one row; attach coordinates by two key joins and compute the
    # distance with the same column expression as everywhere else.
    a = pts.select(F.col("id").alias("station_a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = pts.select(F.col("id").alias("station_b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    out = F.broadcast(pair).join(a, "station_a").join(b, "station_b")
    return out.select("station_a", "station_b", F.round(dist, 6).alias("distance"))
