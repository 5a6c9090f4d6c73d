"""What can match, from metadata alone.

Column contract
  footprints: fp_id, kind, min_lon, max_lon, min_lat, max_lat, polygon, points,
              sensing_start, sensing_end
  samples:    satellite, t, lat, lon
  targets:    target_id, satellite, start, end, and a box, polygon or point
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathmatch import constants as K
from swathmatch.functions.geo import (
    bearing_deg, haversine_km, in_box, inside_edges, polygon_edges, segment_distance_km, unit_xyz,
)
from swathmatch.operators.ordered import micros, run_numbers, with_neighbours
from swathmatch.operators.overlap import Axis, overlap_counts, overlap_join, overlap_pair_counts
from swathmatch.operators.skew import attach_single, salted_join
from swathmatch.operators.spatial import MINUTE, radius_pairs

TILE = 5.0
DAY = 86_400_000_000
SLOT, CELL_DEG = 60 * MINUTE, 30.0
_EVERYWHERE, _ANYWHERE = 360.0, 99


def _tile(x: Column) -> Column:
    return F.floor(x / F.lit(TILE)).cast("bigint")


def _with_tiles(df: DataFrame, w: str, e: str, s: str, n: str) -> DataFrame:
    for name, lo, hi in (("_tx", w, e), ("_ty", s, n)):
        df = df.withColumn(name, F.explode(F.sequence(_tile(F.col(lo)), _tile(F.col(hi)))))
    return df


# --- J12-J14: points and areas ----------------------------------------------------

def polygon_frame(shapes: DataFrame, polygon: str = "polygon") -> DataFrame:
    """Tiles each polygon may touch; a ring across the date line is listed on both sides."""
    lons, lats = F.transform(polygon, lambda v: v["lon"]), F.transform(polygon, lambda v: v["lat"])
    east = F.transform(lons, lambda x: F.when(x < 0, x + 360.0).otherwise(x))
    wraps = F.array_max(lons) - F.array_min(lons) > 180.0
    spans = F.when(~wraps, F.array(F.struct(F.array_min(lons).alias("w"), F.array_max(lons).alias("e")))).otherwise(
        F.array(F.struct(F.array_min(east).alias("w"), F.lit(180.0).alias("e")),
                F.struct(F.lit(-180.0).alias("w"), (F.array_max(east) - 360.0).alias("e"))))
    framed = shapes.withColumns({"_s": F.array_min(lats), "_n": F.array_max(lats), "_span": F.explode(spans)})
    framed = framed.withColumns({"_w": F.col("_span.w"), "_e": F.col("_span.e")})
    return _with_tiles(framed, "_w", "_e", "_s", "_n").drop("_span")


def point_in_polygon_join(points: DataFrame, shapes: DataFrame, polygon: str = "polygon") -> DataFrame:
    """Points inside polygons, by shared tile and then the exact rule.

    A shape with fewer than three vertices cannot be judged and matches every
    point; a shape without a polygon matches none.  A position is judged once,
    however many points it has.
    """
    real = shapes.filter(F.size(polygon) >= 3)
    vague = shapes.filter(F.size(polygon).between(0, 2))
    placed = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    inside = placed.join(_spots_in_polygons(_spots(placed), real, polygon), ["lon", "lat"])
    columns = [*points.columns, *shapes.columns]
    return inside.select(*columns).unionByName(_everywhere(points, vague).select(*columns))


def _spots(points: DataFrame) -> DataFrame:
    """Each position of *points* once."""
    return points.select("lon", "lat").dropna().distinct()


def _spots_in_polygons(spots: DataFrame, shapes: DataFrame, polygon: str = "polygon") -> DataFrame:
    at = spots.withColumns({"_tx": _tile(F.col("lon")), "_ty": _tile(F.col("lat"))})
    # the frame of the ring first: it costs two comparisons
    framed = F.col("lat").between(F.col("_s"), F.col("_n")) & F.col("lon").between(F.col("_w"), F.col("_e"))
    rings = shapes.withColumn("_edges", polygon_edges(polygon))
    return salted_join(at, polygon_frame(rings, polygon), ["_tx", "_ty"]).filter(framed).filter(
        inside_edges("lat", "lon", "_edges")).drop("_tx", "_ty", "_s", "_n", "_w", "_e", "_edges")


def _everywhere(points: DataFrame, shapes: DataFrame) -> DataFrame:
    """All points for each shape: the answer, not a step on the way.

    The number of tasks is given: both sides may be small and their pairs many, so sizes
    measured in the shuffle would put the work into a few tasks.
    """
    lanes = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lane = F.pmod(F.xxhash64(*points.columns, F.spark_partition_id()), F.lit(lanes)).cast("int")
    lhs = points.withColumn("_lane", lane).repartition(lanes, "_lane")
    rhs = shapes.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).repartition(lanes, "_lane")
    return lhs.join(rhs, "_lane").drop("_lane")


BOX = (Axis("min_lon", "max_lon", "r_min_lon", "r_max_lon"), Axis("min_lat", "max_lat", "r_min_lat", "r_max_lat"))
WINDOW = Axis("start", "end", "r_start", "r_end", time=True)


def box_overlap_join(left: DataFrame, right: DataFrame, times: bool = False) -> DataFrame:
    """J13 (and J22 with *times*): boxes that meet, edges included.

    Both sides carry ``min_lon ... max_lat``, the right one with prefix ``r_``.
    With *times* also ``start, end`` / ``r_start, r_end`` must meet (J15).  Boxes of
    every size go through one join, each listed by its own size (``overlap_join``).
    """
    return overlap_join(left, right, ((WINDOW,), BOX) if times else (BOX,))


def windows_overlap(a_start: str, a_end: str, b_start: str, b_end: str) -> Column:
    """Inclusive overlap of two windows."""
    return (F.col(a_start) <= F.col(b_end)) & (F.col(b_start) <= F.col(a_end))


def interval_overlap_join(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Windows that overlap, each pair once, whatever their lengths (``overlap_join``).

    A NULL start or end is open: it meets whatever there is on that side.  A window
    that ends before it starts meets nothing.
    """
    return overlap_join(left, right, ((WINDOW,),), by)


def point_in_footprint_join(points: DataFrame, footprints: DataFrame,
                            radius_km: float = K.DEFAULT_FOOTPRINT_RADIUS_KM) -> DataFrame:
    """Points in footprints by the footprint's kind: polygon (else box), vignettes, box.

    *points* need ``point_id, lon, lat``; returns ``(point_id, fp_id)``.
    """
    placed = points.select("point_id", "lon", "lat").dropna(subset=["lon", "lat"])
    inside = placed.join(_spots_in_footprints(_spots(placed), footprints, radius_km), ["lon", "lat"]).select("point_id", "fp_id")
    return inside.unionByName(_everywhere(points.select("point_id"), _vague(footprints).select("fp_id")))


def _has_ring() -> Column:
    return (F.col("kind") == "polygon") & F.col("polygon").isNotNull()


def _vague(footprints: DataFrame) -> DataFrame:
    """Footprints with rings below three vertices, which match every point."""
    return footprints.filter(_has_ring() & F.size("polygon").between(0, 2))


def _spots_in_footprints(spots: DataFrame, footprints: DataFrame, radius_km: float, keep: Sequence[str] = ()) -> DataFrame:
    """``lon, lat, fp_id`` of positions in footprints, with the columns *keep* of the footprints.

    Rings below three vertices are left to the caller (``_vague``)."""
    cols = ["fp_id", *keep]
    has_ring = _has_ring()
    by_ring = _spots_in_polygons(spots, footprints.filter(has_ring & (F.size("polygon") >= 3)).select(*cols, "polygon"))
    vignettes = footprints.filter(F.col("kind") == "wv_points").select(*cols, F.explode("points").alias("v"))
    by_vignette = radius_pairs(
        vignettes.select(*cols, F.col("v.lon").alias("a_lon"), F.col("v.lat").alias("a_lat")),
        spots.select("lon", "lat", F.col("lon").alias("t_lon"), F.col("lat").alias("t_lat")),
        radius_km, by=(),
    )
    by_box = point_in_box_join(spots, footprints.filter((F.col("kind") != "wv_points") & ~has_ring))
    pairs = [d.select("lon", "lat", *cols) for d in (by_ring, by_vignette, by_box)]
    return pairs[0].unionByName(pairs[1].distinct()).unionByName(pairs[2])


def point_in_box_join(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points in boxes, a box with ``min_lon > max_lon`` lying across the date line."""
    spans = F.when(F.col("min_lon") <= F.col("max_lon"),
                   F.array(F.struct(F.col("min_lon").alias("w"), F.col("max_lon").alias("e")))).otherwise(
        F.array(F.struct(F.col("min_lon").alias("w"), F.lit(180.0).alias("e")),
                F.struct(F.lit(-180.0).alias("w"), F.col("max_lon").alias("e"))))
    split = boxes.select("*", F.explode(spans).alias("_r")).withColumns({"_w": F.col("_r.w"), "_e": F.col("_r.e")})
    tiled = _with_tiles(split, "_w", "_e", "min_lat", "max_lat")
    at = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumns({"_tx": _tile(F.col("lon")), "_ty": _tile(F.col("lat"))})
    hit = F.col("lon").between(F.col("_w"), F.col("_e")) & F.col("lat").between(F.col("min_lat"), F.col("max_lat"))
    return salted_join(at, tiled, ["_tx", "_ty"]).filter(hit).drop("_tx", "_ty", "_w", "_e", "_r")


# --- J16, J18, J19, J21, J23 --------------------------------------------------------

def index_match(index: DataFrame, requests: DataFrame) -> DataFrame:
    """Platform files for requests: common parameter, time and box overlap.

    A file whose own box spans more than 180 degrees crossed the date line and
    matches any longitude; a request with ``r_min_lon > r_max_lon`` lies across it, as
    two boxes.  Time and both sides of the boxes are keys, each by its own size, so
    platforms that live for years in ocean-wide boxes are listed under few of them.
    """
    around = F.col("lon_max") - F.col("lon_min") > 180
    rows = index.withColumnsRenamed({"time_start": "start", "time_end": "end"}).withColumns({
        "_w": F.when(around, -_EVERYWHERE).otherwise(F.col("lon_min")), "_e": F.when(around, _EVERYWHERE).otherwise(F.col("lon_max"))})
    west, east = F.col("r_min_lon"), F.col("r_max_lon")
    parts = F.when(west <= east, F.array(F.struct(F.lit(0).alias("part"), west.alias("w"), east.alias("e")))).otherwise(F.array(
        F.struct(F.lit(0).alias("part"), west.alias("w"), F.lit(_EVERYWHERE).alias("e")),
        F.struct(F.lit(1).alias("part"), F.lit(-_EVERYWHERE).alias("w"), east.alias("e"))))
    asked = requests.select("*", F.explode(parts).alias("_p")).select(*requests.columns, F.col("_p.part").alias("_part"), F.col("_p.w").alias("_rw"), F.col("_p.e").alias("_re"))
    plane = (Axis("_w", "_e", "_rw", "_re"), Axis("lat_min", "lat_max", "r_min_lat", "r_max_lat"))
    # a file that meets both parts of a request counts with the first
    once = (F.col("_part") == 0) | (F.col("_e") < west)
    return overlap_join(rows, asked, ((WINDOW,), plane)).filter(F.arrays_overlap("parameters", "wanted") & once).drop("_w", "_e", "_part", "_rw", "_re")


def station_window_match(stations: DataFrame, footprints: DataFrame, tolerance_minutes: float,
                         radius_km: float = K.DEFAULT_FOOTPRINT_RADIUS_KM) -> DataFrame:
    """Stations inside a footprint whose record meets its padded window.

    A station without a position is kept for every footprint its record meets.
    Returns ``station_id, fp_id, start, end`` (the station's record).
    """
    pad = F.expr(f"interval {int(tolerance_minutes)} minutes")
    fp = footprints.withColumns({"r_start": F.col("sensing_start") - pad, "r_end": F.col("sensing_end") + pad})
    # a footprint's window comes along with the position, so pairs of station and footprint are made last
    placed = stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    inside = _spots_in_footprints(_spots(placed), fp, radius_km, ["r_start", "r_end"])
    anywhere = _everywhere(placed, _vague(fp).select("fp_id", "r_start", "r_end"))
    known = placed.join(inside, ["lon", "lat"]).select(*anywhere.columns).unionByName(anywhere).filter(
        windows_overlap("start", "end", "r_start", "r_end"))
    lost = interval_overlap_join(stations.filter(F.col("lat").isNull() | F.col("lon").isNull()),
                                 fp.select("fp_id", "r_start", "r_end"))
    cols = ["station_id", "fp_id", "start", "end"]
    return known.select(*cols).unionByName(lost.select(*cols))


def semi_exists(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with at least one match; the first hit is enough."""
    return left.join(right, list(on), "left_semi")


def granule_day_exists(windows: DataFrame, granules: DataFrame, pad_minutes: float) -> DataFrame:
    """Windows, padded, of which some touched day has a daily file of the source."""
    pad = F.expr(f"interval {int(pad_minutes)} minutes")
    days = windows.withColumn("day", F.explode(F.sequence(
        F.to_date(F.col("start") - pad), F.to_date(F.col("end") + pad), F.expr("interval 1 day"))))
    hit = days.join(granules.select("source", "day").distinct(), ["source", "day"], "left_semi")
    return hit.select("window_id", "source").distinct()


def catalog_window_match(footprints: DataFrame, catalog: DataFrame, tolerance_minutes: float) -> DataFrame:
    """Catalogue entries meeting a footprint's box in its padded window.

    Footprints of sparse scenes count point by point.  *catalog* has prefix ``r_``.
    """
    return box_overlap_join(_padded_areas(footprints, tolerance_minutes), catalog, times=True)


def catalog_window_counts(footprints: DataFrame, catalog: DataFrame, tolerance_minutes: float, group: str) -> DataFrame:
    """J22, counted: ``fp_id, <group>, n_windows`` by a column of the catalogue, in parts to be summed up.

    A verdict asks for numbers only, and the pairs grow with the square of the tables.
    """
    return overlap_pair_counts(_padded_areas(footprints, tolerance_minutes), catalog, ((WINDOW,), BOX), "fp_id", group, "n_windows")


def _padded_areas(footprints: DataFrame, tolerance_minutes: float) -> DataFrame:
    """Boxes of the footprints (points of sparse scenes) with their padded windows."""
    pad = F.expr(f"interval {int(tolerance_minutes)} minutes")
    padded = footprints.withColumns({"start": F.col("sensing_start") - pad, "end": F.col("sensing_end") + pad})
    area = padded.filter(F.col("kind") != "wv_points").select(
        "fp_id", "start", "end", "min_lon", "max_lon", "min_lat", "max_lat")
    dots = padded.filter(F.col("kind") == "wv_points").select("fp_id", "start", "end", F.explode("points").alias("v")).select(
        "fp_id", "start", "end", F.col("v.lon").alias("min_lon"), F.col("v.lon").alias("max_lon"),
        F.col("v.lat").alias("min_lat"), F.col("v.lat").alias("max_lat"))
    return area.unionByName(dots)


# --- J17, A18: ground tracks ----------------------------------------------------------

def track_neighbours(samples: DataFrame, chunk_us: int = 3_600_000_000) -> DataFrame:
    """Samples with the one before and after, and the heading.

    The last sample of a satellite goes on with the heading it arrived with.
    """
    rows = samples.withColumn("t_us", micros("t"))
    rows = with_neighbours(rows, ["satellite"], ["t_us"], ["t_us", "lat", "lon"], "t_us", chunk_us)
    heading = F.coalesce(bearing_deg("lat", "lon", "next_lat", "next_lon"),
                         bearing_deg("prev_lat", "prev_lon", "lat", "lon"))
    return rows.withColumn("heading", heading)


def track_match(samples: DataFrame, targets: DataFrame, swaths: DataFrame, margin_km: float = 100.0,
                interval_s: float = 15.0) -> DataFrame:
    """J17 + A18: windows in which a satellite's swath may see a target.

    *targets*: ``target_id, satellite, start, end, shape`` with ``shape`` one of
    ``box`` (min_lon ... max_lat), ``polygon``, ``point`` (lat0, lon0).  Areas are
    met by the sample itself or by a point of a cross-track sweep every 50 km out
    to swath half width plus margin; points by distance to the sample or to the
    track between two samples.  Unknown satellites, and windows with fewer than
    two samples (neighbours included), keep their whole window.

    A sample lies in one cell of latitude and longitude; an area is listed under the
    cells from which the sweep may reach it, in the hours of its window.  Cells and hours are
    wide: a pair too many costs two products of vectors (``_in_strip``), a listing a row of the shuffle.
    """
    known = targets.join(swaths, "satellite").withColumns({
        "offset_km": F.col("swath_half_width_km") + margin_km, "start_us": micros("start"), "end_us": micros("end")})
    hits = _seen(_in_strip(_in_reach(_placed(track_neighbours(samples)), _capped(known))))
    # a run goes on where the sample ahead on the track was seen too: within a day first,
    # then over the days, of which a run is one row each
    inside = Window.partitionBy("target_id", "_day").orderBy("t_us")
    days = hits.withColumn("_day", F.floor(F.col("t_us") / DAY))
    ahead = F.lag("t_us").over(inside)
    days = days.withColumn("_new", F.coalesce((ahead != F.col("before_us")) & (ahead != F.col("t_us")), ahead.isNull() | (ahead != F.col("t_us"))).cast("int"))
    parts = days.withColumn("_part", F.sum("_new").over(inside)).groupBy("target_id", "_day", "_part").agg(
        F.min("t_us").alias("lo"), F.max("t_us").alias("hi"), F.min_by("before_us", "t_us").alias("before_us"),
        F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"))
    across = Window.partitionBy("target_id").orderBy("lo")
    parts = parts.withColumn("_new", F.coalesce(F.lag("hi").over(across) != F.col("before_us"), F.lit(True)).cast("int"))
    runs = parts.withColumn("run", F.sum("_new").over(across))
    step = int(interval_s * 1e6)
    windows = runs.groupBy("target_id", "run").agg(
        F.greatest(F.min("start_us"), F.min("lo") - step).alias("from_us"),
        F.least(F.max("end_us"), F.max("hi") + step).alias("to_us"),
    ).select("target_id", "from_us", "to_us")
    return windows.unionByName(_unjudged(samples, targets, swaths))


def _in_reach(track: DataFrame, targets: DataFrame) -> DataFrame:
    """Samples of a target's satellite inside its window, for areas only those in cells which the
    sweep reaches it from (a point may be met between two samples far off, so it is asked everywhere)."""
    def slots(us: Column) -> Column:
        return F.floor(us / F.lit(SLOT)).cast("bigint")

    def cell(x: Column) -> Column:
        return F.floor(x / F.lit(CELL_DEG)).cast("int")

    spans = targets.filter("start_us <= end_us").withColumn("_slot", F.explode(F.sequence(slots(F.col("start_us")), slots(F.col("end_us")))))
    reach = F.least(F.col("offset_km") / 111.0, F.lit(180.0))
    areas = spans.filter(F.col("shape") != "point").withColumn("_y", F.explode(F.sequence(
        cell(F.greatest(F.col("min_lat") - reach, F.lit(-90.0))), cell(F.least(F.col("max_lat") + reach, F.lit(90.0))))))
    # how far a circle reaches in longitude, on the side of the row where it reaches furthest;
    # one that comes near a pole, and a box across the date line, may be seen from everywhere
    side = F.greatest(F.abs(F.col("_y") * CELL_DEG), F.abs((F.col("_y") + 1) * CELL_DEG))
    ratio = F.sin(F.radians(F.least(reach, F.lit(90.0)))) / F.cos(F.radians(F.least(side, F.lit(89.9))))
    half = F.when((side + reach < 90) & (ratio < 1) & (F.col("min_lon") <= F.col("max_lon")), F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-6)
    west, east = cell(F.col("min_lon") - half), cell(F.col("max_lon") + half)
    n = int(360 / CELL_DEG)
    xs = F.when(half.isNotNull() & (east - west < n - 1), F.transform(F.sequence(west, east), lambda x: F.pmod(x + n // 2, F.lit(n)) - n // 2)).otherwise(
        F.sequence(F.lit(-n // 2), F.lit(n // 2 - 1)))
    areas = areas.withColumn("_x", F.explode(xs))
    dots = spans.filter(F.col("shape") == "point").withColumns({"_y": F.lit(_ANYWHERE), "_x": F.lit(_ANYWHERE)})
    around = F.pmod(cell(F.col("lon")) + n // 2, F.lit(n)) - n // 2
    own = F.struct(cell(F.col("lat")).alias("y"), around.cast("int").alias("x"))
    any_ = F.struct(F.lit(_ANYWHERE).alias("y"), F.lit(_ANYWHERE).alias("x"))
    rows = track.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).withColumn("_slot", slots(F.col("t_us")))
    rows = rows.withColumn("_c", F.explode(F.array(own, any_))).withColumns({"_y": F.col("_c.y"), "_x": F.col("_c.x")}).drop("_c")
    pairs = rows.join(areas.unionByName(dots), ["satellite", "_slot", "_y", "_x"])
    return pairs.filter(F.col("t_us").between(F.col("start_us"), F.col("end_us"))).drop("_slot", "_y", "_x")


def _placed(track: DataFrame) -> DataFrame:
    """Samples of a track once each, with what ``_in_strip`` asks: their place and heading
    as unit vectors, the longest way to a neighbour in radians, and the time ahead of their own.

    Samples repeated at one time and place differ in their neighbours only, so a few rows are left of them.
    """
    same = Window.partitionBy("satellite", "t_us")
    before = F.min(F.when(F.col("prev_t_us") < F.col("t_us"), F.col("prev_t_us"))).over(same)
    rows = track.withColumn("before_us", before).select(
        "satellite", "t_us", "before_us", "lat", "lon", "heading", "prev_lat", "prev_lon", "next_lat", "next_lon").distinct()
    lat, lon, turn = F.radians("lat"), F.radians("lon"), F.radians("heading")
    north = (-F.sin(lat) * F.cos(lon), -F.sin(lat) * F.sin(lon), F.cos(lat))
    east = (-F.sin(lon), F.cos(lon), F.lit(0.0))
    steps = [F.coalesce(haversine_km("lon", "lat", f"{k}_lon", f"{k}_lat"), F.lit(0.0)) / K.EARTH_RADIUS_KM for k in ("prev", "next")]
    return rows.withColumns({
        **{f"_p{k}": x for k, x in zip("xyz", unit_xyz("lon", "lat"), strict=True)},
        **{f"_h{k}": n * F.cos(turn) + e * F.sin(turn) for k, n, e in zip("xyz", north, east, strict=True)}, "_step": F.greatest(*steps)})


def _capped(targets: DataFrame) -> DataFrame:
    """Targets with a circle around each, for ``_in_strip``: its centre as a unit vector, its radius in radians
    (NULL where a box wraps, spans more than half the globe or has no sides)."""
    point = F.col("shape") == "point"
    south, north = F.greatest(F.col("min_lat"), F.lit(-90.0)), F.least(F.col("max_lat"), F.lit(90.0))
    half = (F.col("max_lon") - F.col("min_lon")) / 2
    lon, lat = (F.col("min_lon") + F.col("max_lon")) / 2, (south + north) / 2
    # the corners are what lies furthest from the middle of a box up to 180 degrees wide
    corner = F.greatest(*[haversine_km(lon, lat, F.col("max_lon"), edge) for edge in (south, north)]) / K.EARTH_RADIUS_KM
    framed = half.between(0, 90) & (south <= north)
    centre = unit_xyz(F.when(point, F.col("lon0")).otherwise(lon), F.when(point, F.col("lat0")).otherwise(lat))
    return targets.withColumns({**{f"_c{k}": x for k, x in zip("xyz", centre, strict=True)},
                                "_cap": F.when(point, F.lit(0.0)).when(framed, corner)})


def _in_strip(pairs: DataFrame) -> DataFrame:
    """Pairs that ``_seen`` may accept, told by two products of vectors; the sweep's steps worth looking at as ``_w``.

    A sweep lies on the great circle across the heading, so the target's circle must meet
    that one, no further off than the sweep is long; a point must lie within the offset
    and the way to the next sample.  Where that cannot be told, the pair stays.
    """
    def dot(a: str, b: str) -> Column:
        return sum((F.col(f"_{a}{k}") * F.col(f"_{b}{k}") for k in "yz"), F.col(f"_{a}x") * F.col(f"_{b}x"))

    slack, half_turn = 1e-6, math.pi
    point, cap, long = F.col("shape") == "point", F.col("_cap"), F.col("offset_km") / K.EARTH_RADIUS_KM
    far = F.when(point, long + F.col("_step")).otherwise(long + cap) + slack
    reached = (far >= half_turn) | (dot("c", "p") >= F.cos(far))
    met = point | (cap + slack >= half_turn / 2) | (F.abs(dot("c", "h")) <= F.sin(cap + slack))
    known = F.abs(F.col("lat")) <= 90
    rows = pairs.filter(F.coalesce(~known | (reached & met), F.lit(True)))
    # how far the target lies along the sweep, to the right of the heading
    c, h, p = ([F.col(f"_{v}{k}") for k in "xyz"] for v in "chp")
    right = sum((c[i] * (h[(i + 1) % 3] * p[(i + 2) % 3] - h[(i + 2) % 3] * p[(i + 1) % 3]) for i in (1, 2)), c[0] * (h[1] * p[2] - h[2] * p[1]))
    at, steps = F.atan2(right, dot("c", "p")), _steps(F.col("offset_km"))
    told = F.coalesce(known & (long + cap + slack < half_turn) & (cap + slack < half_turn / 2), F.lit(False))
    least = F.when(told, F.greatest(-steps, F.floor((at - cap - slack) / long * steps).cast("int"))).otherwise(-steps)
    most = F.when(told, F.least(steps, F.ceil((at + cap + slack) / long * steps).cast("int"))).otherwise(steps)
    # a row of its own keeps the costly test behind the cheap one
    return rows.withColumn("_w", F.explode(F.array(F.struct(least.alias("least"), most.alias("most")))))


def _steps(offset: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(offset / K.CROSS_TRACK_STEP_KM).cast("int"))


def _seen(pairs: DataFrame) -> DataFrame:
    """``target_id, t_us, before_us, start_us, end_us`` of pairs of a sample and a target that it sees.

    Of the sweep only the steps ``_w`` are tried (to the left below 0).  They are worked out
    in arrays, many pairs at once: there are dozens to a pair, and none of them becomes a row.
    """
    lat, offset, point = F.col("lat"), F.col("offset_km"), F.col("shape") == "point"
    # nothing the sweep reaches is further off in latitude than its length
    reach = offset / F.lit(111.0)
    close = lat.between(F.col("min_lat") - reach, F.col("max_lat") + reach)
    near = haversine_km("lon", "lat", "lon0", "lat0") <= offset
    for other in ("prev", "next"):
        seg = segment_distance_km("lat0", "lon0", "lat", "lon", f"{other}_lat", f"{other}_lon") \
            if other == "next" else segment_distance_km("lat0", "lon0", "prev_lat", "prev_lon", "lat", "lon")
        near = near | F.coalesce(seg <= offset, F.lit(False))
    out = ["target_id", "t_us", "before_us", "start_us", "end_us"]
    numbers = ("lat", "lon", "heading", "offset_km", "min_lon", "max_lon", "min_lat", "max_lat")
    ring = F.when(F.col("shape") == "polygon", F.col("polygon"))
    # a test on an array keeps this filter out of the stage's one method, which the JVM leaves
    # uncompiled when it grows as large as the distances make it
    apart = F.exists(F.array(point), lambda p: p)
    rows = pairs.filter(F.coalesce(F.when(apart, near).otherwise(close), F.lit(False))).select(
        *out, F.coalesce(F.col("shape"), F.lit("box")).alias("shape"), *[F.col(c).cast("double").alias(c) for c in numbers], _steps(offset).alias("steps"),
        F.col("_w.least").alias("least"), F.col("_w.most").alias("most"),
        F.transform(ring, lambda v: v["lat"].cast("double")).alias("ring_lat"), F.transform(ring, lambda v: v["lon"].cast("double")).alias("ring_lon"))
    radius, at_once = K.EARTH_RADIUS_KM, 1 << 18

    def judged(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lat, lon, heading, offset, west, east, south, north = (batch.column(c).to_numpy(zero_copy_only=False) for c in numbers)
            steps, least, most = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("steps", "least", "most"))
            shape = batch.column("shape").to_numpy(zero_copy_only=False)
            polygon, seen = shape == "polygon", shape == "point"
            ring_lat, ring_lon = (batch.column(f"ring_{c}") for c in ("lat", "lon"))
            first, size = ring_lat.offsets.to_numpy()[:-1], np.diff(ring_lat.offsets.to_numpy())
            known = ring_lat.is_valid().to_numpy(zero_copy_only=False)
            v_lat, v_lon = (r.values.to_numpy(zero_copy_only=False) for r in (ring_lat, ring_lon))
            wraps = np.zeros(batch.num_rows, dtype=bool)
            some = np.flatnonzero(size > 0)
            if len(some):
                # nothing lies between the rings of two rows
                wraps[some] = np.fmax.reduceat(v_lon[:first[some[-1]] + size[some[-1]]], first[some]) - np.fmin.reduceat(
                    v_lon[:first[some[-1]] + size[some[-1]]], first[some]) > 180.0

            def holds(row, y, x):
                """Whether the targets of some rows hold a place each: the box, then the ring."""
                w, e = west[row], east[row]
                hit = np.where(w <= e, (x >= w) & (x <= e), (x >= w) | (x <= e)) & (y >= south[row]) & (y <= north[row])
                hit &= ~polygon[row] | known[row]
                ask = np.flatnonzero(hit & polygon[row] & (size[row] > 2))
                if len(ask):
                    of, n = row[ask], size[row[ask]]
                    place = np.repeat(np.arange(len(ask)), n)
                    k = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
                    a = first[of][place] + k
                    b = np.where(k > 0, a - 1, a + n[place] - 1)
                    up, py = wraps[of][place], y[ask][place]
                    ax, bx, px = (np.where(up & (v < 0), v + 360.0, v) for v in (v_lon[a], v_lon[b], x[ask][place]))
                    ay, by = v_lat[a], v_lat[b]
                    crossed = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
                    hit[ask] = np.bincount(place, crossed, len(ask)) % 2 == 1
                return hit

            with np.errstate(all="ignore"):
                areas = np.flatnonzero(~seen)
                seen[areas] = holds(areas, lat[areas], lon[areas])
                left = areas[~seen[areas] & (least[areas] <= most[areas])]
                p1, th = np.radians(lat), {side: np.radians(heading + turn) for side, turn in ((True, 90.0), (False, -90.0))}
                sin_1, cos_1 = np.sin(p1), np.cos(p1)
                sin_th, cos_th = (np.stack([f(th[False]), f(th[True])]) for f in (np.sin, np.cos))
                count = (most[left] - least[left] + 1).astype(np.int64)
                ends = np.cumsum(count)
                begin = 0
                while begin < len(left):
                    done = ends[begin - 1] if begin else 0
                    stop = max(begin + 1, int(np.searchsorted(ends, done + at_once, "right")))
                    n = count[begin:stop]
                    row = np.repeat(left[begin:stop], n)
                    i = least[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    way = offset[row] * np.abs(i) / steps[row] / radius
                    right, sin_d, cos_d = (i > 0).astype(np.int64), np.sin(way), np.cos(way)
                    p2 = np.arcsin(np.clip(sin_1[row] * cos_d + cos_1[row] * sin_d * cos_th[right, row], -1.0, 1.0))
                    y = np.degrees(p2)
                    kept = np.flatnonzero((i != 0) & (y >= south[row]) & (y <= north[row]))
                    row, right, sin_d, cos_d, p2, y = (v[kept] for v in (row, right, sin_d, cos_d, p2, y))
                    turned = np.arctan2(sin_th[right, row] * sin_d * cos_1[row], cos_d - sin_1[row] * np.sin(p2))
                    x = np.mod(np.degrees(np.radians(lon[row]) + turned) + 180.0, 360.0) - 180.0
                    seen[row[holds(row, y, x)]] = True
                    begin = stop
            found = pa.array(seen)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(found) for c in out], names=out)

    return rows.mapInArrow(lambda batches: judged(batches), pairs.select(*out).schema)


def _unjudged(samples: DataFrame, targets: DataFrame, swaths: DataFrame) -> DataFrame:
    """Targets whose satellite is unknown, or whose window holds too few samples.

    Two samples or more lie around or inside every window that meets the time from the
    first sample of a satellite to its last; all other windows have too few."""
    whole = ["target_id", micros("start").alias("from_us"), micros("end").alias("to_us")]
    unknown = targets.join(swaths, "satellite", "left_anti").select(*whole)
    spans = samples.filter("t IS NOT NULL").groupBy("satellite").agg(
        F.min("t").alias("_first"), F.max("t").alias("_last"), F.count("*").alias("_n")).filter("_n > 1")
    known = targets.join(swaths.select("satellite"), "satellite").join(spans, "satellite", "left")
    judged = F.coalesce((F.col("start") <= F.col("_last")) & (F.col("end") >= F.col("_first")) & (F.col("start") <= F.col("end")), F.lit(False))
    return unknown.unionByName(known.filter(~judged).select(*whole))


def islands(rows: DataFrame, by: Sequence[str], matched: Column, axis: str, tie: str,
            step: int = 0, chunk: int = DAY) -> DataFrame:
    """Runs of consecutive matched rows as padded windows ``lo, hi, n``."""
    marked = rows.withColumn("_m", F.coalesce(matched, F.lit(False)))
    near = with_neighbours(marked, by, [axis, tie], ["_m"], axis, chunk)
    starts = F.col("_m") & ~F.coalesce("prev__m", F.lit(False))
    runs = run_numbers(near, by, [axis, tie], starts, axis, chunk)
    return runs.filter("_m").groupBy(*by, "run").agg(
        (F.min(axis) - step).alias("lo"), (F.max(axis) + step).alias("hi"), F.count("*").alias("n"))


def track_prefilter(files: DataFrame, targets: DataFrame, samples: DataFrame, swaths: DataFrame,
                    margin_km: float) -> DataFrame:
    """Candidate files whose track comes near the box; files that cannot be judged stay."""
    judged = targets.filter(F.col("satellite").isNotNull() & F.col("start").isNotNull())
    near = track_match(samples, judged, swaths, margin_km).select("target_id").distinct()
    open_ = targets.filter(F.col("satellite").isNull() | F.col("start").isNull()).select("target_id")
    keep = near.unionByName(open_).withColumnRenamed("target_id", "file_name")
    return files.join(keep, "file_name", "left_semi")


# --- J20 ------------------------------------------------------------------------------

def category(source: str) -> Column:
    """Display category of a source or platform type."""
    c = F.col(source)
    # every word of a layer name is capitalised, the underscores stay
    out = F.when(c.isin(*K.LAYER_DATA_TYPES), F.translate(F.initcap(F.translate(c, "_", " ")), " ", "_")).otherwise("In-situ")
    for name, label in K.SOIL_CATEGORY.items():
        out = F.when(c == name, F.lit(label)).otherwise(out)
    return out


def matched_unmatched(obs: DataFrame, pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """Observations as matched, or unmatched though their time was eligible.

    *obs*: ``obs_id, lon, lat, time, platform_type, tolerance_us``; *windows*:
    ``start, end`` of every scene.  Matched means its position, rounded to six
    decimals, is among the matched ones of its category.  Unmatched ones count
    only where some scene was within their tolerance; an unknown time is eligible,
    and every time is where no scene has one.

    The observations are read once: a row looks up its position, then the day in
    which its tolerance ends.
    """
    def place(lon: str, lat: str) -> list[Column]:
        return [F.round(lon, 6).alias("_lon"), F.round(lat, 6).alias("_lat")]

    rows = obs.withColumn("category", category("platform_type")).select("*", *place("lon", "lat"))
    done = pairs.select(category("val_source").alias("category"), *place("val_lon", "val_lat")).distinct()
    found = salted_join(rows, done.withColumn("_hit", F.lit(True)), ["category", "_lon", "_lat"], "left")
    known = windows.filter(F.col("start").isNotNull() & F.col("end").isNotNull())
    ends = F.when(F.col("start") <= F.col("end"), micros("end"))
    found = attach_single(found, known.agg((F.count("*") > 0).alias("_timed"), (F.floor(F.max(ends) / F.lit(DAY)) + 1).alias("_beyond")))
    from_us, to_us = micros("time") - F.col("tolerance_us"), micros("time") + F.col("tolerance_us")
    # rows without a time meet no day; they are kept apart, so as not to share one key
    nowhere = F.lit(-(1 << 40)) - F.pmod(F.xxhash64("obs_id", "lon", "lat"), F.lit(1 << 16))
    found = found.withColumns({"_from": from_us, "_to": to_us}).withColumn("_day", F.when(
        F.col("_to").isNull(), nowhere).otherwise(F.least(F.floor(F.col("_to") / F.lit(DAY)), F.col("_beyond"))))
    seen = salted_join(found, _scene_days(known), ["_day"], "left")
    near = F.exists("_spans", lambda s: (s["w_from"] <= F.col("_to")) & (s["w_to"] >= F.col("_from")))
    eligible = F.col("time").isNull() | ~F.col("_timed") | F.coalesce(F.col("_earlier") >= F.col("_from"), F.lit(False)) | F.coalesce(near, F.lit(False))
    matched = F.coalesce("_hit", F.lit(False))
    return seen.filter(matched | eligible).select("obs_id", "category", "lon", "lat", "platform_type", matched.alias("matched"))


def _scene_days(windows: DataFrame) -> DataFrame:
    """``_day, _spans, _earlier`` of every day from the first window to the day behind the
    last: the merged windows of the day, and the end of the last one of the days before.

    The days are a calendar: their number depends on the time covered only.
    """
    merged = merged_windows(windows)
    spans = merged.groupBy("_day").agg(F.collect_list(F.struct("w_from", "w_to")).alias("_spans"))
    days = Window.partitionBy().orderBy("_day")
    lasts = merged.groupBy("_day").agg(F.max("w_to").alias("_last")).select(
        "_day", "_last", F.lag("_last").over(days).alias("_before"), F.coalesce(F.lead("_day").over(days) - 1, F.col("_day") + 1).alias("_until"))
    calendar = lasts.withColumn("_at", F.explode(F.sequence("_day", "_until"))).select(
        F.col("_at").alias("_day"), F.when(F.col("_at") == F.col("_day"), F.col("_before")).otherwise(F.col("_last")).alias("_earlier"))
    return calendar.join(spans, "_day", "left")


def merged_windows(windows: DataFrame, slot: int = DAY) -> DataFrame:
    """Windows cut into days and merged inside each: ``_day, w_from, w_to`` (microseconds),
    no two of a day overlapping.  A day at a time, so no task sees all windows."""
    cut = windows.select(micros("start").alias("s"), micros("end").alias("e")).filter("s <= e").distinct().select(
        "s", "e", F.explode(F.sequence(F.floor(F.col("s") / F.lit(slot)), F.floor(F.col("e") / F.lit(slot)))).alias("_day"))
    cut = cut.select("_day", F.greatest(F.col("s"), F.col("_day") * slot).alias("s"), F.least(F.col("e"), (F.col("_day") + 1) * slot - 1).alias("e"))
    order = Window.partitionBy("_day").orderBy("s", "e")
    fresh = F.coalesce(F.col("s") > F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = cut.withColumn("_new", fresh.cast("int")).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy("_day", "_run").agg(F.min("s").alias("w_from"), F.max("e").alias("w_to")).drop("_run")


# --- A17, A19-A25 ------------------------------------------------------------------------

def cluster_times(times: DataFrame, by: Sequence[str], pad_minutes: float, start: str, end: str,
                  chunk: int = DAY) -> DataFrame:
    """Request windows around clusters of scene times.

    A gap above twice the padding opens a new cluster; each is padded and cut to
    the nominal padded window, empty ones vanish.
    """
    pad = int(round(pad_minutes * MINUTE))
    rows = times.filter(F.col("time").isNotNull()).select(*by, micros("time").alias("t_us")).distinct()
    near = with_neighbours(rows, by, ["t_us"], ["t_us"], "t_us", chunk)
    fresh = F.coalesce(F.col("t_us") - F.col("prev_t_us") > 2 * pad, F.lit(True))
    runs = run_numbers(near, by, ["t_us"], fresh, "t_us", chunk, "cluster")
    lo = F.unix_micros(F.to_timestamp(F.lit(start))) - pad
    hi = F.unix_micros(F.to_timestamp(F.lit(end))) + pad
    return runs.groupBy(*by, "cluster").agg(
        F.greatest(lo, F.min("t_us") - pad).alias("from_us"), F.least(hi, F.max("t_us") + pad).alias("to_us"),
        F.count("*").alias("n_times"),
    ).filter(F.col("from_us") <= F.col("to_us"))


def footprint_from_cells(cells: DataFrame, value: str) -> DataFrame:
    """Box of the non-missing cells of each scene; scenes without a time have none."""
    return cells.filter(F.col("time").isNotNull() & F.col(value).isNotNull()).groupBy("scene").agg(
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.min("time").alias("sensing_start"), F.max("time").alias("sensing_end"), F.count("*").alias("n_cells"))


def wrap_aware_lon_bounds(lon: str = "lon") -> tuple[Column, Column]:
    """(min, max) aggregates; a span above 180 degrees is read across the date line."""
    c = F.col(lon)
    east = F.when(c < 0, c + 360.0).otherwise(c)
    wide = F.max(c) - F.min(c) > 180.0

    def back(x: Column) -> Column:
        return F.when(x > 180.0, x - 360.0).otherwise(x)

    return (F.when(wide, back(F.min(east))).otherwise(F.min(c)),
            F.when(wide, back(F.max(east))).otherwise(F.max(c)))


def footprint_union_bbox(footprints: DataFrame, radius_km: float = K.DEFAULT_FOOTPRINT_RADIUS_KM,
                         by: Sequence[str] = ()) -> DataFrame:
    """Common box of all footprints, widened by the footprint radius."""
    pad = radius_km / K.KM_PER_DEG_RADAR
    return footprints.groupBy(*by).agg(
        (F.min("min_lon") - pad).alias("min_lon"), (F.max("max_lon") + pad).alias("max_lon"),
        (F.min("min_lat") - pad).alias("min_lat"), (F.max("max_lat") + pad).alias("max_lat"))


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """(lon, lat) mean of a ring's vertices, the closing one left out."""
    n = F.size(ring)
    closed = (n > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    open_ring = F.slice(ring, F.lit(1), F.when(closed, n - 1).otherwise(n))

    def mean(part: str) -> Column:
        return F.aggregate(open_ring, F.lit(0.0), lambda acc, v: acc + v[part]) / F.nullif(F.size(open_ring), F.lit(0))

    return mean("lon"), mean("lat")


def centroids(rings: DataFrame, box: Sequence[float], ring: str = "ring") -> DataFrame:
    """Ring centroids inside the request box."""
    lon, lat = ring_centroid(F.col(ring))
    return rings.withColumns({"c_lon": lon, "c_lat": lat}).filter(
        in_box("c_lon", "c_lat", *[F.lit(float(v)) for v in box]))


def verdict(sources: DataFrame, matches: DataFrame, n_footprints: DataFrame) -> DataFrame:
    """One row per source.

    *sources*: ``source_type, bucket, listing_failed``; *matches*: ``source_type,
    fp_id, window_id``, or counted as ``source_type, fp_id, n_windows``; *n_footprints*: one row ``n`` (``footprints.agg(count)``).  No footprint at all or a
    failed listing leaves the verdict open.
    """
    # a footprint is one row before they are counted, whatever the number of its windows
    windows = F.sum("n_windows") if "n_windows" in matches.columns else F.count("*")
    found = matches.groupBy("source_type", "fp_id").agg(windows.alias("_n")).groupBy("source_type").agg(
        F.count("fp_id").alias("n_footprints"), F.sum("_n").alias("n_windows"))
    rows = attach_single(sources.join(found, "source_type", "left"), n_footprints.select(F.col("n").alias("_total")))
    hits = F.coalesce("n_windows", F.lit(0))
    return rows.select(
        "source_type", "bucket",
        F.when((F.col("_total") == 0) | F.col("listing_failed"), "unknown")
        .when(hits > 0, "collocated").otherwise("none-predicted").alias("verdict"),
        F.coalesce("n_footprints", F.lit(0)).alias("n_footprints"), hits.alias("n_windows"))


def combined_verdict(parts: DataFrame) -> DataFrame:
    """A source made of several listings: any hit wins, then any open one."""
    rank = F.when(F.col("verdict") == "collocated", 2).when(F.col("verdict") == "unknown", 1).otherwise(0)
    best = parts.groupBy("source_type").agg(F.max(rank).alias("_r"), F.sum("n_windows").alias("n_windows"))
    return best.select("source_type", F.when(F.col("_r") == 2, "collocated").when(F.col("_r") == 1, "unknown")
                       .otherwise("none-predicted").alias("verdict"), "n_windows")


def model_coverage(footprints: DataFrame, coverage: DataFrame) -> DataFrame:
    """A22 for models: only time coverage counts; an open end is no limit.

    *coverage*: ``source_type, coverage_start, coverage_end``.  Footprints are counted by
    running sums (``overlap_counts``), not by their pairs.
    """
    spans = coverage.select("source_type", F.col("coverage_start").alias("start"), F.col("coverage_end").alias("end"))
    seen = footprints.select(F.col("sensing_start").alias("start"), F.col("sensing_end").alias("end")).filter("start IS NOT NULL AND end IS NOT NULL")
    rows = attach_single(overlap_counts(spans, seen, "n_footprints"), footprints.agg(F.count("*").alias("_n")))
    n = F.col("n_footprints")
    return rows.select("source_type", F.when(F.coalesce("_n", F.lit(0)) == 0, "unknown")
                       .when(n > 0, "collocated").otherwise("none-predicted").alias("verdict"), n.alias("n_footprints"))


def skip_gate(predictions: DataFrame) -> DataFrame:
    """Sources to fetch: only a confirmed "none" is skipped."""
    return predictions.filter(F.coalesce(F.col("verdict") != "none-predicted", F.lit(True)))


def day_footprint(records: DataFrame) -> DataFrame:
    """One footprint per daily record, from the first to the last matched window."""
    return records.groupBy("record_id").agg(
        F.min("start").alias("sensing_start"), F.max("end").alias("sensing_end"), F.count("*").alias("n_windows"))
