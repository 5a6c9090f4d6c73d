"""Great-circle joins between scene cells and observations.

Column contract
  cells:  scene, y, x, lon, lat, time, <scene variables>
  points: scene, point_idx, lon, lat, time, <scene variables>
  obs:    obs_id, platform_id, platform_type, time, lon, lat, <variables>

``obs_id`` is the row id that stands for "order of observations" in ties.
Distances that agree to a millimetre are ties.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathmatch import constants as K
from swathmatch.functions.geo import RadiusBins, haversine_km, project_radial
from swathmatch.functions.weights import array_weight, distance_weight
from swathmatch.operators.ordered import keep_first, micros, next_valid
from swathmatch.operators.overlap import PIECES, cut_groups
from swathmatch.operators.skew import salted_join

MINUTE = 60_000_000
TILE_DEG = 5.0
_POW31 = 2 ** 31


@dataclass(frozen=True)
class MatchSpec:
    """Settings of one matching pass; the defaults are those of point sources."""

    time_tolerance_minutes: float = 30.0
    spatial_tolerance_km: float = 25.0
    aggregation_window_km: float = 5.0
    distance_weighting: str = "gaussian"
    gaussian_sigma_km: float = 2.0
    dedup_nearest_in_time: bool = False
    collocation_type: str = "point_vs_layer"

    @property
    def tolerance_us(self) -> int:
        return int(round(self.time_tolerance_minutes * MINUTE))


# --- shared parts ---------------------------------------------------------------

def scene_extents(cells: DataFrame) -> DataFrame:
    """One row per scene: plain lon/lat limits and acquisition time."""
    return (
        cells.filter(F.col("time").isNotNull())
        .groupBy("scene").agg(
            F.min("lon").alias("w"), F.max("lon").alias("e"),
            F.min("lat").alias("s"), F.max("lat").alias("n"),
            F.min("time").alias("scene_time"),
        )
    )


def candidates(obs: DataFrame, extents: DataFrame, buffer_deg: float, tolerance_us: int, limits: bool = False) -> DataFrame:
    """Observations inside the widened box and time window of each scene.

    Both limits belong to the result, not only to the speed.  Scenes are listed
    under the (time slot, tile) pairs they cover, an observation has one pair.
    With *limits* the widened ``w, e, s, n`` stay.
    """
    slot = max(2 * tolerance_us, 3600 * 1_000_000)
    t = F.unix_micros(F.col("scene_time").cast("timestamp"))
    boxes = (
        extents.withColumns({
            "w": F.col("w") - buffer_deg, "e": F.col("e") + buffer_deg,
            "s": F.col("s") - buffer_deg, "n": F.col("n") + buffer_deg,
            "scene_us": t,
        })
        .withColumn("_slot", F.explode(_span(t - tolerance_us, t + tolerance_us, slot)))
        .withColumn("_tx", F.explode(_span(F.col("w"), F.col("e"), TILE_DEG)))
        .withColumn("_ty", F.explode(_span(F.col("s"), F.col("n"), TILE_DEG)))
    )
    known = obs.dropna(subset=["time", "lon", "lat"])
    readings = known.withColumn("obs_us", micros("time")).withColumns({
        "_slot": _cell(F.col("obs_us"), slot),
        "_tx": _cell(F.col("lon"), TILE_DEG),
        "_ty": _cell(F.col("lat"), TILE_DEG),
    })
    return (
        salted_join(readings, boxes, ["_slot", "_tx", "_ty"])
        .filter(
            F.col("lon").between(F.col("w"), F.col("e"))
            & F.col("lat").between(F.col("s"), F.col("n"))
            & (F.abs(F.col("obs_us") - F.col("scene_us")) <= tolerance_us)
        )
        .drop("_slot", "_tx", "_ty", *([] if limits else ["w", "e", "s", "n"]))
    )


def _cell(x: Column, width) -> Column:
    return F.floor(x / F.lit(width)).cast("bigint")


def _span(lo: Column, hi: Column, width) -> Column:
    return F.sequence(_cell(lo, width), _cell(hi, width))


def radius_pairs(anchors: DataFrame, targets: DataFrame, radius_km: float,
                 by: Sequence[str] = ("scene",)) -> DataFrame:
    """Every (anchor, target) pair no further apart than *radius_km*.

    *anchors* carry ``a_lon, a_lat``, *targets* ``t_lon, t_lat``; *by* are extra
    equality keys.  Adds ``dist_km``.  The targets stay in one bin each and are
    shuffled once; the anchors are listed in the one to four bins they reach.
    The targets of a bin are spread over lanes and its anchors wait in each of
    them; whoever aggregates per anchor combines the lanes.
    """
    bins = RadiusBins(radius_km)
    rhs = bins.place_targets(targets.dropna(subset=["t_lon", "t_lat"]), "t_lon", "t_lat")
    lhs = bins.spread_anchors(anchors.dropna(subset=["a_lon", "a_lat"]), "a_lon", "a_lat")
    joined = salted_join(rhs, lhs, [*by, "_lat_bin", "_lon_bin"]).drop("_lat_bin", "_lon_bin")
    # the latitude test is free and spares most of the trigonometry
    near_rows = F.abs(F.col("a_lat") - F.col("t_lat")) <= bins.half
    return (
        joined.filter(near_rows)
        .withColumn("dist_km", haversine_km("a_lon", "a_lat", "t_lon", "t_lat"))
        .filter(F.col("dist_km") <= radius_km)
    )


def _rank(dist: Column, second: Column) -> Column:
    """Distance in millimetres, then *second* (BIGINT >= 0), as one orderable number.

    A DECIMAL stays inside the hash aggregation, a struct would force a sort.
    """
    mm = F.rint(dist * F.lit(1e6)).cast("decimal(18,0)")
    return (mm * F.lit("10000000000000000000").cast("decimal(20,0)")
            + second.cast("decimal(19,0)")).cast("decimal(38,0)")


def _cell_number(y: str, x: str) -> Column:
    """Row-major number of a cell, the order in which ties are settled."""
    return F.col(y).cast("bigint") * F.lit(_POW31) + F.col(x).cast("bigint")


def _weighted(variables: Sequence[str], weight: str) -> list[Column]:
    """Partial sums of a weighted mean over the non-missing values of each variable."""
    out = []
    for v in variables:
        out.append(F.sum(F.col(v) * F.col(weight)).alias(f"_s_{v}"))
        out.append(F.sum(F.when(F.col(v).isNotNull(), F.col(weight))).alias(f"_w_{v}"))
    return out


def _mean(v: str) -> Column:
    # all-zero weights leave the variable missing
    return F.col(f"_s_{v}") / F.nullif(F.col(f"_w_{v}"), F.lit(0.0))


def _any_present(cols: Sequence[str]) -> Column:
    if not cols:
        return F.lit(False)
    return F.coalesce(*[F.col(c) for c in cols]).isNotNull()


def measurements(variables: Sequence[str]) -> list[str]:
    """Variables whose presence makes a match; flags and geometry do not."""
    return [v for v in variables if v not in K.AUXILIARY_VARS]


def _own_label(label: str) -> Column:
    own = F.col("platform_type")
    return F.when(own.isNotNull() & (own != ""), own).otherwise(F.lit(label))


PAIR_COLUMNS = (
    "sar_lon", "sar_lat", "val_lon", "val_lat", "spatial_distance_km", "temporal_distance_minutes",
    "val_source", "aggregation_window_km", "sar_pixel_spacing_km", "collocation_type",
    "sar_y_idx", "sar_x_idx", "sar_scene_name", "time", "val_time", "val_id",
)


def _pairs(df: DataFrame, sar_vars: Sequence[str], val_vars: Sequence[str]) -> DataFrame:
    data = [f"sar_{v}" for v in sar_vars] + [f"val_{v}" for v in val_vars]
    return df.select(*PAIR_COLUMNS, *data)


# --- J1 / J2 ----------------------------------------------------------------------

def radius_join(cells: DataFrame, obs: DataFrame, sar_vars: Sequence[str], val_vars: Sequence[str],
                spec: MatchSpec, label: str = "insitu", extents: DataFrame | None = None) -> DataFrame:
    """One row per observation and scene, scene cells averaged around it.

    *extents* may bring a stored scene catalogue (see ``scene_extents``) instead
    of one scan of the cells.

    Observations sharing a position in a scene share their cells, so the cells
    are averaged once per scene and position: a station with a million readings
    costs as much searching as one with a single reading.  Pairs of observation and
    scene are made last, straight into the result, and never shuffled: what is
    shuffled are the observations, the cells, and one row for each position of a scene.
    """
    extents = scene_extents(cells) if extents is None else extents
    tol = spec.tolerance_us
    buffer_deg = spec.spatial_tolerance_km / K.KM_PER_DEG_RADIUS_BUFFER
    slot = max(2 * tol, 3600 * 1_000_000)
    # a source without platforms is filled as a whole, and its matches have no val_id
    platform = "platform_id" if "platform_id" in obs.columns else None
    known = obs.dropna(subset=["time", "lon", "lat"]).withColumn("obs_us", micros("time"))
    near_slots = _span(F.col("obs_us") - tol, F.col("obs_us") + tol, slot)
    listed = known.withColumn("_slot", F.explode(near_slots))
    around = _scene_means(
        listed.select("_slot", F.col("lon").alias("t_lon"), F.col("lat").alias("t_lat")).distinct(),
        salted_join(cells.select("scene", "y", "x", "lon", "lat", *sar_vars), extents.select("scene", *LIMITS), ["scene"]),
        sar_vars, spec, slot)
    later = later_valid(known, "obs_us", "obs_id", val_vars, tol, platform)
    readings = later.withColumns({"_slot": F.explode(near_slots), "_own": F.lit(None).cast(extents.schema["scene"].dataType)})
    # the few whose next readings all lie beside a scene: filled for that scene, among its candidates
    beside = _beside(later, obs, extents, buffer_deg, val_vars, tol, platform)
    if beside is not None:
        readings = readings.unionByName(beside.withColumn("_slot", _cell(F.col("scene_us"), slot)).withColumnRenamed(
            "scene", "_own").select(*[c for c in readings.columns if not c.startswith("_next_")],
                                    *[F.lit(None).cast(readings.schema[c].dataType).alias(c)
                                      for c in readings.columns if c.startswith("_next_")]))
    hits = readings.withColumnsRenamed({"lon": "a_lon", "lat": "a_lat"}).join(around, ["_slot", "a_lon", "a_lat"])
    hits = hits.withColumn("scene_us", micros("scene_time")).filter(
        _in_scene(F.col("a_lon"), F.col("a_lat"), F.col("obs_us"), buffer_deg, tol)
        & (F.col("_own").isNull() | (F.col("_own") == F.col("scene"))))
    unsure = _unsure(val_vars, buffer_deg, tol)
    hits = hits.filter(F.col("_own").isNotNull() | ~unsure).withColumns(
        {v: F.coalesce(F.col(v), _first_inside(v, buffer_deg, tol)["v"]) for v in val_vars})
    measured = measurements(sar_vars)
    hits = hits.filter(_any_present([f"sar_{v}" for v in measured]) & _any_present(val_vars))
    val = {v: F.col(v) for v in val_vars}
    if {"EWCT", "NSCT"} <= set(val_vars) and {"rvlRadVel", "rvlHeading"} <= set(sar_vars):
        # the plain mean heading of the cells, not the weighted one
        val["rvlRadVel_projection"] = F.when(
            F.col("sar_rvlRadVel").isNotNull(),
            project_radial("EWCT", "NSCT", "_heading"),
        )
    out = hits.select(
        F.col("near_lon").alias("sar_lon"), F.col("near_lat").alias("sar_lat"),
        F.col("a_lon").alias("val_lon"), F.col("a_lat").alias("val_lat"),
        haversine_km("a_lon", "a_lat", "near_lon", "near_lat").alias("spatial_distance_km"),
        (F.abs(F.col("obs_us") - F.col("scene_us")) / MINUTE).alias("temporal_distance_minutes"),
        _own_label(label).alias("val_source"),
        F.lit(float(spec.aggregation_window_km)).alias("aggregation_window_km"),
        F.lit(None).cast("double").alias("sar_pixel_spacing_km"),
        F.lit(spec.collocation_type).alias("collocation_type"),
        F.col("near_y").alias("sar_y_idx"), F.col("near_x").alias("sar_x_idx"),
        F.col("scene").alias("sar_scene_name"),
        F.col("scene_time").alias("time"), F.col("time").alias("val_time"),
        (F.col(platform) if platform else F.lit(None).cast("string")).alias("val_id"), "obs_id", "obs_us", "scene_us",
        *[F.col(f"sar_{v}") for v in sar_vars], *[c.alias(f"val_{v}") for v, c in val.items()],
    )
    if spec.dedup_nearest_in_time:
        out = nearest_in_time(out)
    return _pairs(out, sar_vars, list(val))


# next valid readings an observation carries: as many of them may lie beside a scene
# before its candidates are searched
LATER = 4
LIMITS = ("scene_time", "w", "e", "s", "n")


def _in_scene(lon: Column, lat: Column, us: Column, buffer_deg: float, tolerance_us: int) -> Column:
    """Whether a reading is a candidate of the scene in ``w, e, s, n, scene_us``; see ``candidates``."""
    return (lon.between(F.col("w") - buffer_deg, F.col("e") + buffer_deg)
            & lat.between(F.col("s") - buffer_deg, F.col("n") + buffer_deg)
            & (F.abs(us - F.col("scene_us")) <= tolerance_us))


def later_valid(obs: DataFrame, axis: str, tie: str, cols: Sequence[str], tolerance: int, platform: str | None,
                count: int = LATER, pieces: int = 16) -> DataFrame:
    """Add ``_next_<c>`` to rows where *c* is NULL: the next *count* later valid readings.

    Those of the same *platform* (without one: of all), no further than *tolerance* away,
    as ``(us, v, lon, lat)`` in order of time, then *tie*.  Valid readings are numbered
    along time, chunk by chunk, and looked up by number.
    """
    by = [platform] if platform else []
    kinds = {c: f"array<struct<us:bigint,v:{obs.schema[c].dataType.simpleString()},lon:double,lat:double>>" for c in cols}
    rows = (obs.filter(F.col(platform).isNotNull()) if platform else obs).withColumn(
        "_chunk", F.floor(F.col(axis) / F.lit(max(1, tolerance // pieces))).cast("bigint"))
    across = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*by, "_chunk").agg(*[F.count(c).alias(f"_n_{c}") for c in cols]).select(
        *by, "_chunk", *[F.coalesce(F.sum(f"_n_{c}").over(across), F.lit(0)).alias(f"_base_{c}") for c in cols])
    for c in cols:
        # of one time, the valid readings come first: a gap looks for strictly later ones
        inside = Window.partitionBy(*by, "_chunk").orderBy(axis, F.col(c).isNull(), tie).rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn(f"_no_{c}", F.count(c).over(inside))
    rows = rows.join(sums, [*by, "_chunk"]).withColumns({f"_no_{c}": F.col(f"_no_{c}") + F.col(f"_base_{c}") for c in cols})
    rows = out = rows.drop("_chunk", *[f"_base_{c}" for c in cols])
    for c in cols:
        # numbers begin at 0; a row without a gap asks for none, and for many a one, so as not to share a key
        asks = F.when(F.col(c).isNull(), F.col(f"_no_{c}")).otherwise(-1 - F.pmod(F.xxhash64(tie, axis), F.lit(1 << 16)))
        asked = rows.filter(F.col(c).isNull()).select(*by, F.col(f"_no_{c}").alias("_ask")).distinct().withColumn(
            "_at", F.explode(F.sequence(F.col("_ask") + 1, F.col("_ask") + count)))
        valid = rows.filter(F.col(c).isNotNull()).select(
            *by, F.col(f"_no_{c}").alias("_at"), F.struct(F.col(axis).alias("us"), F.col(c).alias("v"), "lon", "lat").alias("_entry"))
        lists = asked.join(valid, [*by, "_at"]).groupBy(*by, "_ask").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_at", "_entry"))), lambda e: e["_entry"]).cast(kinds[c]).alias("_list"))
        out = out.withColumn("_ask", asks).join(lists, [*by, "_ask"], "left").withColumn(
            f"_next_{c}", F.filter("_list", lambda e: e["us"] - F.col(axis) <= tolerance)).drop("_ask", "_list", f"_no_{c}")
    wanted = [*obs.columns, *[f"_next_{c}" for c in cols]]
    if not platform:
        return out.select(*wanted)
    return out.select(*wanted).unionByName(obs.filter(F.col(platform).isNull()).withColumns({f"_next_{c}": F.lit(None).cast(kinds[c]) for c in cols}))


def _first_inside(c: str, buffer_deg: float, tolerance_us: int) -> Column:
    """The first of the later readings that is a candidate of the scene, or NULL."""
    return F.get(F.filter(f"_next_{c}", lambda e: _in_scene(e["lon"], e["lat"], e["us"], buffer_deg, tolerance_us)), F.lit(0))


def _unsure(cols: Sequence[str], buffer_deg: float, tolerance_us: int) -> Column:
    """Whether the list of later readings ends before one of the scene was met."""
    unsure = F.lit(False)
    for c in cols:
        nxt = F.col(f"_next_{c}")
        full = F.coalesce(F.size(nxt) >= LATER, F.lit(False))
        unsure = unsure | (full & ~F.exists(nxt, lambda e: _in_scene(e["lon"], e["lat"], e["us"], buffer_deg, tolerance_us)
                                            | (e["us"] > F.col("scene_us") + tolerance_us)))
    return unsure


def _beside(later: DataFrame, obs: DataFrame, extents: DataFrame, buffer_deg: float, val_vars: Sequence[str],
            tolerance_us: int, platform: str | None) -> DataFrame | None:
    """Candidates whose next valid reading has to be searched among all candidates of their
    scene (and platform), with that reading filled in."""
    if not val_vars:
        return None
    full = F.lit(False)
    for c in val_vars:
        full = full | F.coalesce(F.size(f"_next_{c}") >= LATER, F.lit(False))
    open_rows = candidates(later.filter(full).drop("obs_us"), extents, buffer_deg, tolerance_us, limits=True).filter(
        _unsure(val_vars, 0.0, tolerance_us))
    by = ["scene", *([platform] if platform else [])]
    groups = open_rows.select(*by).distinct()
    some = obs.join(groups.select(platform).distinct(), platform, "left_semi") if platform else obs
    scenes = extents.join(groups.select("scene").distinct(), "scene", "left_semi")
    pool = candidates(some, scenes, buffer_deg, tolerance_us).join(groups, by, "left_semi")
    filled = next_valid(pool, ["scene"], "obs_us", "obs_id", val_vars, tolerance_us, platform=platform)
    return filled.join(open_rows.select("scene", "obs_id", "lon", "lat", "obs_us").distinct(),
                       ["scene", "obs_id", "lon", "lat", "obs_us"], "left_semi")


def _scene_means(places: DataFrame, cells: DataFrame, sar_vars: Sequence[str], spec: MatchSpec, slot: int) -> DataFrame:
    """Cell means, nearest cell and the limits of the scene for each scene and place of its time slot.

    A place waits in one bin and the cells are listed in the bins they reach, so all
    cells around a place meet in one task and only their mean leaves it.
    """
    radius = spec.aggregation_window_km
    bins = RadiusBins(radius)
    near = cells.filter(F.col("scene_time").isNotNull()).withColumn("_slot", _cell(micros("scene_time"), slot)).select(
        "_slot", "scene", *LIMITS, F.col("lon").alias("c_lon"), F.col("lat").alias("c_lat"), "y", "x", *sar_vars)
    near = bins.spread_anchors(near.dropna(subset=["c_lon", "c_lat"]), "c_lon", "c_lat")
    at = ["_slot", "_lat_bin", "_lon_bin"]
    pairs = bins.place_targets(places, "t_lon", "t_lat").join(near, at)
    pairs = pairs.filter(F.abs(F.col("c_lat") - F.col("t_lat")) <= bins.half).withColumn(
        "dist_km", haversine_km("t_lon", "t_lat", "c_lon", "c_lat")).filter(F.col("dist_km") <= radius)
    return _around(pairs, [*at, "scene", "t_lon", "t_lat"], sar_vars, spec, "c_lon", "c_lat", LIMITS).drop(
        "_lat_bin", "_lon_bin", "mean_dist_km").withColumnsRenamed({"t_lon": "a_lon", "t_lat": "a_lat"})


def cells_around(anchors: DataFrame, cells: DataFrame, sar_vars: Sequence[str], spec: MatchSpec,
                 by: Sequence[str] = ("scene",)) -> DataFrame:
    """Weighted cell means, nearest cell and mean distance around each anchor."""
    radius = spec.aggregation_window_km
    targets = cells.select(
        *by, *([] if "scene" in by else ["scene"]),
        F.col("lon").alias("t_lon"), F.col("lat").alias("t_lat"), "y", "x", *sar_vars,
    )
    pairs = radius_pairs(anchors, targets, radius, by)
    return _around(pairs, ["scene", *[c for c in anchors.columns if c != "scene"]], sar_vars, spec, "t_lon", "t_lat")


def _around(pairs: DataFrame, keys: Sequence[str], sar_vars: Sequence[str], spec: MatchSpec,
            lon: str, lat: str, limits: Sequence[str] = ()) -> DataFrame:
    """Weighted means and nearest cell (at ``lon, lat``) of each key; *limits* depend on the key."""
    pairs = pairs.withColumn(
        "_w", distance_weight(F.col("dist_km"), spec.distance_weighting, spec.gaussian_sigma_km, spec.aggregation_window_km)
    ).withColumn("_rank", _rank(F.col("dist_km"), _cell_number("y", "x")))
    heading = [F.avg("rvlHeading").alias("_heading")] if "rvlHeading" in sar_vars else []
    grouped = pairs.groupBy(*keys).agg(
        *_weighted(sar_vars, "_w"), *heading,
        F.avg("dist_km").alias("mean_dist_km"),
        F.min("_rank").alias("_near"),
        F.min_by(lon, "_rank").alias("near_lon"), F.min_by(lat, "_rank").alias("near_lat"),
        *[F.first(c).alias(c) for c in limits],
    )
    number = (F.col("_near") % F.lit("10000000000000000000").cast("decimal(20,0)")).cast("bigint")
    return grouped.select(
        *keys, *limits, "mean_dist_km", "near_lon", "near_lat",
        F.floor(number / _POW31).cast("int").alias("near_y"),
        (number % _POW31).cast("int").alias("near_x"),
        *([F.col("_heading")] if heading else []),
        *[_mean(v).alias(f"sar_{v}") for v in sar_vars],
    )


def nearest_in_time(pairs: DataFrame) -> DataFrame:
    """Per station (or position) and scene the reading closest in time.

    First in observation order on ties.
    """
    station = F.coalesce(
        F.concat(F.lit("i"), "val_id"),
        F.concat_ws("|", F.lit("p"), F.col("val_lon").cast("string"), F.col("val_lat").cast("string")),
    )
    lag = F.abs(F.col("obs_us") - F.col("scene_us"))
    return keep_first(pairs.withColumn("_station", station), ["sar_scene_name", "_station"],
                      [lag, F.col("obs_id")]).drop("_station")


def cell_average_join(cells: DataFrame, obs: DataFrame, sar_vars: Sequence[str],
                      val_vars: Sequence[str], layer: MatchSpec, label: str) -> DataFrame:
    """The radius join with the settings of a layer source."""
    return radius_join(cells, obs, sar_vars, val_vars, layer, label)


# --- J3 ----------------------------------------------------------------------------

def nearest_join(cells: DataFrame, obs: DataFrame, sar_vars: Sequence[str], val_vars: Sequence[str],
                 spec: MatchSpec, label: str) -> DataFrame:
    """Every cell with a measurement takes its nearest observation.

    Observations are first reduced to one per scene and position (the lowest
    ``obs_id``: at equal distance the first one wins).  One search then reaches as
    far as the tolerance; the nearest is a minimum, taken in every task before the
    shuffle, so dense observations cost comparisons but no rows.
    """
    extents = scene_extents(cells)
    buffer_deg = spec.spatial_tolerance_km / K.KM_PER_DEG_NEAREST_BUFFER
    places = candidates(obs.select("obs_id", "lon", "lat", "time"), extents, buffer_deg, spec.tolerance_us).groupBy("scene", F.col("lon").alias("t_lon"), F.col("lat").alias("t_lat")).agg(
        F.min("obs_id").alias("obs_id")
    )
    measured = measurements(sar_vars) or list(sar_vars)
    usable = cells.filter(_any_present(measured)).withColumnsRenamed({"lon": "a_lon", "lat": "a_lat"})
    pairs = radius_pairs(usable.select("scene", "y", "x", "a_lon", "a_lat"), places, spec.spatial_tolerance_km)
    ranked = pairs.withColumn("_rank", _rank(F.col("dist_km"), F.col("obs_id")))
    found = ranked.groupBy("scene", "y", "x").agg(
        F.min("_rank").alias("_rank"), F.min("dist_km").alias("dist_km")
    ).withColumn("obs_id", (F.col("_rank") % F.lit("10000000000000000000").cast("decimal(20,0)")).cast("bigint")).drop("_rank")
    spacing = native_spacing(cells, K.KM_PER_DEG_GRID)
    hits = (
        usable.join(found, ["scene", "y", "x"])
        .withColumnRenamed("time", "cell_time")
        .join(extents.select("scene", micros("scene_time").alias("scene_us"), "w", "e", "s", "n"), "scene")
        # by its id alone: pairs of reading and scene are not shuffled
        .join(obs.dropna(subset=["time", "lon", "lat"]).select(
            "obs_id", "lon", "lat", F.col("time").alias("val_time"), micros("time").alias("obs_us"), *val_vars), "obs_id")
        .filter(_in_scene(F.col("lon"), F.col("lat"), F.col("obs_us"), buffer_deg, spec.tolerance_us))
        .filter(_any_present(measurements(sar_vars)) & _any_present(val_vars))
        .join(spacing, "scene", "left")
    )
    val = {v: F.col(v) for v in val_vars}
    if {"EWCT", "NSCT"} <= set(val_vars) and {"rvlRadVel", "rvlHeading"} <= set(sar_vars):
        val["rvlRadVel_projection"] = F.when(
            F.col("rvlRadVel").isNotNull(), project_radial("EWCT", "NSCT", "rvlHeading")
        )
    out = hits.select(
        F.col("a_lon").alias("sar_lon"), F.col("a_lat").alias("sar_lat"),
        F.col("lon").alias("val_lon"), F.col("lat").alias("val_lat"),
        F.col("dist_km").alias("spatial_distance_km"),
        (F.abs(F.col("obs_us") - F.col("scene_us")) / MINUTE).alias("temporal_distance_minutes"),
        F.lit(label).alias("val_source"),
        F.lit(None).cast("double").alias("aggregation_window_km"),
        F.col("spacing_km").alias("sar_pixel_spacing_km"),
        F.lit("layer_vs_layer").alias("collocation_type"),
        F.col("y").alias("sar_y_idx"), F.col("x").alias("sar_x_idx"),
        F.col("scene").alias("sar_scene_name"),
        F.col("cell_time").alias("time"), "val_time",
        F.lit(None).cast("string").alias("val_id"),
        *[F.col(v).alias(f"sar_{v}") for v in sar_vars], *[c.alias(f"val_{v}") for v, c in val.items()],
    )
    return _pairs(out, sar_vars, list(val))


def native_spacing(cells: DataFrame, km_per_deg: float, row: str = "y", col: str = "x") -> DataFrame:
    """pixel spacing of each scene: median neighbour steps, both directions averaged.

    Neighbours differ by one in ``y`` (or ``x``), so each is found by an equality
    join on the shifted index instead of by ordering a whole scene.
    """
    from swathmatch.operators.quantiles import exact_quantiles

    here = cells.select("scene", row, col, "lon", "lat")
    down = here.select("scene", (F.col(row) - 1).alias(row), col, F.col("lat").alias("lat2"))
    right = here.select("scene", row, (F.col(col) - 1).alias(col), F.col("lon").alias("lon2"))
    lat_steps = here.join(down, ["scene", row, col]).select(
        F.col("scene"), F.lit("lat").alias("axis"), F.abs(F.col("lat2") - F.col("lat")).alias("step"))
    lon_steps = here.join(right, ["scene", row, col]).select(
        F.col("scene"), F.lit("lon").alias("axis"), F.abs(F.col("lon2") - F.col("lon")).alias("step"))
    medians = exact_quantiles(lat_steps.unionByName(lon_steps), ["scene", "axis"], "step", [0.5])
    steps = medians.groupBy("scene").agg(
        F.max(F.when(F.col("axis") == "lat", F.col("q")[0])).alias("lat_step"),
        F.max(F.when(F.col("axis") == "lon", F.col("q")[0])).alias("lon_step"),
    )
    means = cells.groupBy("scene").agg(F.avg("lat").alias("mean_lat"))
    lat_km = F.col("lat_step") * F.lit(km_per_deg)
    lon_km = F.col("lon_step") * F.lit(km_per_deg) * F.greatest(F.cos(F.radians("mean_lat")), F.lit(1e-6))
    return steps.join(means, "scene").select(
        "scene", F.when((lat_km > 0) & (lon_km > 0), (lat_km + lon_km) / 2).alias("spacing_km")
    )


# --- J4 ----------------------------------------------------------------------------

def _footprint_parts(anchors: DataFrame, readings: DataFrame, val_vars: Sequence[str], radius_km: float, tol: int, weight) -> DataFrame:
    """Rows to be put together per ``scene, point_idx``: least ``dist_km`` and ``dt``, the nearest
    reading (``mm, obs_id``), and for variable i the weighted sum and weights ``s, w`` and the
    plain sum and count ``p, c``.

    Readings of a place are sorted by time, so an anchor meets each place once and takes
    the stretch of its window from there: no pair of anchor and reading is a row.
    """
    # a long slot costs nothing, as windows are found by search
    slot = max(8 * tol, 24 * 60 * MINUTE)
    bins, at = RadiusBins(radius_km), ["_slot", "_lat_bin", "_lon_bin"]
    lhs = bins.spread_anchors(anchors.dropna(subset=["a_lon", "a_lat"]), "a_lon", "a_lat").withColumn(
        "_slot", F.explode(_span(F.col("a_us") - tol, F.col("a_us") + tol, slot)))
    rhs = bins.place_targets(readings.dropna(subset=["t_lon", "t_lat"]), "t_lon", "t_lat").withColumn("_slot", _cell(F.col("t_us"), slot))
    numbers = range(len(val_vars))
    lhs = lhs.select(*at, "scene", "point_idx", F.col("a_lon").cast("double").alias("a_lon"), F.col("a_lat").cast("double").alias("a_lat"), "a_us")
    # a missing value is 0 in no reading; a missing id never is the nearest
    none = (1 << 63) - 1
    rhs = rhs.select(*at, F.col("t_lon").cast("double").alias("t_lon"), F.col("t_lat").cast("double").alias("t_lat"), "t_us",
                     F.coalesce(F.col("obs_id").cast("bigint"), F.lit(none)).alias("obs_id"),
                     *[F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(f"v{i}") for i, v in enumerate(val_vars)],
                     *[F.col(v).isNotNull().cast("bigint").alias(f"n{i}") for i, v in enumerate(val_vars)])
    half, diameter = bins.half, 2 * K.EARTH_RADIUS_KM

    def summed(l, r):
        import numpy as np
        import pyarrow as pa

        n = l.num_rows
        least, soonest, mm, ids = np.full(n, np.inf), np.full(n, none), np.full(n, none), np.full(n, none)
        sums = {f"{part}{i}": np.zeros(n, np.int64 if part == "c" else np.float64) for i in numbers for part in "swpc"}
        if n and r.num_rows:
            a_lon, a_lat, a_us = (l[c].to_numpy() for c in ("a_lon", "a_lat", "a_us"))
            t_lon, t_lat, t_us, obs = (r[c].to_numpy() for c in ("t_lon", "t_lat", "t_us", "obs_id"))
            order = np.lexsort((t_us, t_lat, t_lon))
            t_lon, t_lat, t_us = t_lon[order], t_lat[order], t_us[order]
            # one more, as a stretch may end with the last
            obs = np.append(obs[order], none)
            values = [np.append(r[f"v{i}"].to_numpy()[order], 0.0) for i in numbers]
            counts = [np.append(r[f"n{i}"].to_numpy()[order], 0) for i in numbers]
            new = np.concatenate([[True], (t_lon[1:] != t_lon[:-1]) | (t_lat[1:] != t_lat[:-1])])
            starts = np.flatnonzero(new)
            p_lon, p_lat, p_first, p_last = t_lon[starts], t_lat[starts], t_us[starts], t_us[np.append(starts[1:], len(t_us)) - 1]
            base, width = t_us.min(), t_us.max() - t_us.min() + 1
            keys = (np.cumsum(new) - 1) * width + (t_us - base)
            block = max(1, (1 << 20) // len(starts))
            for begin in range(0, n, block):
                some = slice(begin, begin + block)
                lat, us = a_lat[some, None], a_us[some, None]
                i, p = np.nonzero((np.abs(lat - p_lat) <= half) & (p_first <= us + tol) & (p_last >= us - tol))
                i += begin
                dlat, dlon = (np.sin(np.radians(x) / 2) for x in (p_lat[p] - a_lat[i], p_lon[p] - a_lon[i]))
                h = dlat * dlat + np.cos(np.radians(a_lat[i])) * np.cos(np.radians(p_lat[p])) * dlon * dlon
                dist = diameter * np.arcsin(np.sqrt(np.clip(h, 0.0, 1.0)))
                near = dist <= radius_km
                i, p, dist = i[near], p[near], dist[near]
                us = a_us[i] - base
                lo = np.searchsorted(keys, p * width + np.clip(us - tol, 0, width))
                hi = np.searchsorted(keys, p * width + np.clip(us + tol, -1, width - 1), "right")
                # stretches from the last to the first: what reduceat sums between two is one element then
                kept = np.flatnonzero(lo < hi)
                if not len(kept):
                    continue
                kept = kept[np.argsort(-lo[kept], kind="stable")]
                i, p, dist, us, lo, hi = (x[kept] for x in (i, p, dist, us, lo, hi))
                ends = np.stack([lo, hi], axis=1).ravel()
                w = weight(dist)
                for k in numbers:
                    total, count = np.add.reduceat(values[k], ends)[::2], np.add.reduceat(counts[k], ends)[::2]
                    # a place without a value adds nothing, however it is weighted
                    for part, x in (("s", np.where(count > 0, w * total, 0.0)), ("w", np.where(count > 0, w * count, 0.0)), ("p", total), ("c", count)):
                        np.add.at(sums[f"{part}{k}"], i, x)
                after = np.clip(np.searchsorted(keys, p * width + np.clip(us, 0, width)), lo, hi)
                far = np.int64(none)
                ahead = np.where(after > lo, us - (t_us[np.maximum(after - 1, 0)] - base), far)
                behind = np.where(after < hi, t_us[np.minimum(after, len(t_us) - 1)] - base - us, far)
                np.minimum.at(soonest, i, np.minimum(ahead, behind))
                np.minimum.at(least, i, dist)
                named = np.minimum.reduceat(obs, ends)[::2]
                rounded = np.where(named < none, np.rint(dist * 1e6).astype(np.int64), none)
                before = mm[i]
                np.minimum.at(mm, i, rounded)
                ids[i[mm[i] < before]] = none
                first = rounded == mm[i]
                np.minimum.at(ids, i[first], named[first])
        hit = np.flatnonzero(soonest < none)
        lost = mm[hit] == none
        out = {"scene": l["scene"].take(hit), "point_idx": l["point_idx"].take(hit), "dist_km": least[hit], "dt": soonest[hit],
               "mm": pa.array(mm[hit], mask=lost), "obs_id": pa.array(ids[hit], mask=lost)}
        return pa.table(out | {c: x[hit] for c, x in sums.items()})

    names = ", ".join(f"{part}{i} {'bigint' if part == 'c' else 'double'}" for i in numbers for part in "swpc")
    kinds = [f"{c} {anchors.schema[c].dataType.simpleString()}" for c in ("scene", "point_idx")]
    schema = f"{', '.join(kinds)}, dist_km double, dt bigint, mm bigint, obs_id bigint" + (f", {names}" if names else "")
    lhs, rhs = cut_groups(lhs, rhs, at)
    by = [*at, *PIECES]
    return lhs.groupBy(*by).cogroup(rhs.groupBy(*by)).applyInArrow(lambda l, r: summed(l, r), schema)


def footprint_join(points: DataFrame, obs: DataFrame, sar_vars: Sequence[str], val_vars: Sequence[str],
                   radius_km: float, tolerance_minutes: float, weighting: str = "equal",
                   sigma_km: float = 5.0, label: str = "insitu",
                   collocation_type: str = "point_vs_point") -> DataFrame:
    """One row per scene point, all observations in its footprint aggregated.

    Position, time and identity come from the nearest observation, the time
    distance is the smallest among the contributors.
    """
    tol = int(round(tolerance_minutes * MINUTE))
    measured = measurements(sar_vars)
    anchors = points.filter(_any_present(measured) & F.col("time").isNotNull()).select(
        "scene", "point_idx", F.col("lon").alias("a_lon"), F.col("lat").alias("a_lat"), micros("time").alias("a_us"))
    readings = obs.filter(F.col("time").isNotNull()).select(
        F.col("lon").alias("t_lon"), F.col("lat").alias("t_lat"), "obs_id", micros("time").alias("t_us"), *val_vars)
    parts = _footprint_parts(anchors, readings, val_vars, radius_km, tol, array_weight(weighting, sigma_km, float(radius_km)))
    rank = F.col("mm").cast("decimal(18,0)") * F.lit("10000000000000000000").cast("decimal(20,0)") + F.col("obs_id").cast("decimal(19,0)")
    sums = [f"{part}{i}" for i in range(len(val_vars)) for part in "swpc"]
    grouped = parts.withColumn("_rank", rank.cast("decimal(38,0)")).groupBy("scene", "point_idx").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("dist_km").alias("dist_km"), F.min("dt").alias("dt"), F.min("_rank").alias("_rank"),
    ).withColumn("obs_id", (F.col("_rank") % F.lit("10000000000000000000").cast("decimal(20,0)"))
                 .cast("bigint"))
    # zero weight everywhere falls back to the plain mean
    means = {v: F.coalesce(F.col(f"s{i}") / F.nullif(F.col(f"w{i}"), F.lit(0.0)), F.col(f"p{i}") / F.nullif(F.col(f"c{i}"), F.lit(0)))
             for i, v in enumerate(val_vars)}
    grouped = grouped.select("scene", "point_idx", "dist_km", "dt", "obs_id",
                             *[m.alias(f"val_{v}") for v, m in means.items()])
    grouped = grouped.filter(_any_present([f"val_{v}" for v in val_vars]))
    near = obs.select("obs_id", F.col("lon").alias("val_lon"), F.col("lat").alias("val_lat"),
                      F.col("time").alias("val_time"), "platform_id", "platform_type")
    hits = points.join(grouped, ["scene", "point_idx"]).join(near, "obs_id")
    names = list(val_vars)
    if {"EWCT", "NSCT"} <= set(val_vars) and {"rvlRadVel", "rvlHeading"} <= set(sar_vars):
        hits = hits.withColumn("val_rvlRadVel_projection", F.when(
            F.col("rvlRadVel").isNotNull(), project_radial("val_EWCT", "val_NSCT", "rvlHeading")))
        names.append("rvlRadVel_projection")
    out = hits.select(
        F.col("lon").alias("sar_lon"), F.col("lat").alias("sar_lat"), "val_lon", "val_lat",
        F.col("dist_km").alias("spatial_distance_km"),
        (F.col("dt") / MINUTE).alias("temporal_distance_minutes"),
        _own_label(label).alias("val_source"),
        F.lit(None).cast("double").alias("aggregation_window_km"),
        F.lit(None).cast("double").alias("sar_pixel_spacing_km"),
        F.lit(collocation_type).alias("collocation_type"),
        F.lit(0).alias("sar_y_idx"), F.col("point_idx").alias("sar_x_idx"),
        F.col("scene").alias("sar_scene_name"), "time", "val_time",
        F.col("platform_id").alias("val_id"),
        *[F.col(v).alias(f"sar_{v}") for v in sar_vars], *[f"val_{v}" for v in names],
    )
    return _pairs(out, sar_vars, names)
