"""Matching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import query
from querybook.tables import hav, mod
from swathmatch.functions.weights import distance_weight
from swathmatch.operators import asof, model, spatial, stats
from swathmatch.operators.ordered import micros, next_valid
from swathmatch.operators.spatial import MatchSpec

EQUAL_25 = MatchSpec(180, 25, 25, "equal")
PAIR_COLS = ("sar_lon:d sar_lat:d val_lon:d val_lat:d spatial_distance_km:d temporal_distance_minutes:d val_source:s "
             "sar_y_idx:i sar_x_idx:i sar_scene_name:s time:t val_time:t val_id:s ")


def candidate_sql(buffer_deg: str, minutes: int = 180) -> str:
    """Observations in the widened box and window of each scene."""
    return f"""
        ext AS (SELECT scene, min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n, min(time) AS scene_time
                FROM cells GROUP BY scene),
        cand AS (SELECT o.*, x.scene, x.scene_time FROM obs AS o JOIN ext AS x
                 ON o.time BETWEEN x.scene_time - INTERVAL {minutes} MINUTE AND x.scene_time + INTERVAL {minutes} MINUTE
                AND o.lon BETWEEN x.w - {buffer_deg} AND x.e + {buffer_deg}
                AND o.lat BETWEEN x.s - {buffer_deg} AND x.n + {buffer_deg})"""


def filled_sql(cols, minutes: int = 180, source: str = "cand", by: str = "scene, platform_id") -> str:
    """NULLs filled from the next later valid reading of the same platform."""
    fills = ", ".join(
        f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY time RANGE BETWEEN"
        f" INTERVAL 1 MICROSECOND FOLLOWING AND INTERVAL {minutes} MINUTE FOLLOWING)) AS f_{c}" for c in cols)
    return f"SELECT *, {fills} FROM {source}"


def radius_sql(sar, val, radius: float, weight: str = "1e0", extra: str = "", minutes: int = 180,
               buffer_deg: str = "0.25e0", more: str = "", by: str = "scene, platform_id", val_id: str = "f.platform_id") -> str:
    """Brute force over all cells of the scene; the same rules as the radius join."""
    mean = ", ".join(f"sum({v} * wt) / nullif(sum(CASE WHEN {v} IS NOT NULL THEN wt END), 0) AS sar_{v}" for v in sar)
    measured = [v for v in sar if v != "rvlHeading"]
    any_sar = " OR ".join(f"sar_{v} IS NOT NULL" for v in measured)
    any_val = " OR ".join(f"f_{c} IS NOT NULL" for c in val)
    return f"""WITH {candidate_sql(buffer_deg, minutes)},
        filled AS ({filled_sql(val, minutes, by=by)}),
        pairs0 AS (SELECT o.obs_id, o.scene, c.y, c.x, c.lon AS c_lon, c.lat AS c_lat, {', '.join('c.' + v for v in sar)},
                          {hav('o.lon', 'o.lat', 'c.lon', 'c.lat')} AS d
                   FROM cand AS o JOIN cells AS c ON c.scene = o.scene AND c.lat BETWEEN o.lat - 0.4e0 AND o.lat + 0.4e0),
        hit AS (SELECT *, {weight} AS wt FROM pairs0 WHERE d <= {radius}e0),
        around AS (SELECT obs_id, scene, {mean}{extra} FROM hit GROUP BY obs_id, scene),
        near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY obs_id, scene ORDER BY round(d * 1e6), y, x) AS rn
                                FROM hit) WHERE rn = 1),
        matched AS (SELECT n.c_lon AS sar_lon, n.c_lat AS sar_lat, f.lon AS val_lon, f.lat AS val_lat,
                   n.d AS spatial_distance_km, abs(epoch_us(f.time) - epoch_us(f.scene_time)) / 6e7 AS temporal_distance_minutes,
                   f.platform_type AS val_source, n.y AS sar_y_idx, n.x AS sar_x_idx, f.scene AS sar_scene_name,
                   f.scene_time AS time, f.time AS val_time, {val_id} AS val_id, f.obs_id,
                   {', '.join(f'a.sar_{v}' for v in sar)}, {', '.join(f'f.f_{c} AS val_{c}' for c in val)}{more}
            FROM filled AS f JOIN around AS a USING (obs_id, scene) JOIN near AS n USING (obs_id, scene)
            WHERE ({any_sar}) AND ({any_val}))"""


WIND = ("owiWindSpeed", "owiWindDirection")


@query("j1_radius_join_aggregate", PAIR_COLS + "sar_owiWindSpeed:d sar_owiWindDirection:d val_WSPD:d val_WDIR:d",
       radius_sql(WIND, ("WSPD", "WDIR"), 25) + "\n--select\nSELECT * FROM matched", "obs cells")
def j1(t):
    return spatial.radius_join(t.cells, t.obs, WIND, ["WSPD", "WDIR"], EQUAL_25)


@query("j1_radius_join_no_platform", PAIR_COLS + "sar_owiWindSpeed:d val_WSPD:d",
       radius_sql(("owiWindSpeed",), ("WSPD",), 25, by="scene", val_id="CAST(NULL AS VARCHAR)") + "\n--select\nSELECT * FROM matched", "obs cells")
def j1_no_platform(t):
    return spatial.radius_join(t.cells, t.obs.drop("platform_id"), ["owiWindSpeed"], ["WSPD"], EQUAL_25)


@query("j1_radius_join_gaussian", PAIR_COLS + "sar_owiWindSpeed:d val_WSPD:d",
       radius_sql(("owiWindSpeed",), ("WSPD",), 30, "exp(-(d * d) / 200e0)", buffer_deg="0.3e0") + "\n--select\nSELECT * FROM matched",
       "obs cells")
def j1_gaussian(t):
    return spatial.radius_join(t.cells, t.obs, ["owiWindSpeed"], ["WSPD"], MatchSpec(180, 30, 30, "gaussian", 10.0))


@query("j1_radius_join_currents", PAIR_COLS + "sar_rvlRadVel:d sar_rvlHeading:d val_EWCT:d val_NSCT:d val_rvlRadVel_projection:d",
       radius_sql(("rvlRadVel", "rvlHeading"), ("EWCT", "NSCT"), 25, "1e0 / pow(greatest(d, 1e-6), 2)",
                  ", avg(rvlHeading) AS mh",
                  more=", CASE WHEN a.sar_rvlRadVel IS NOT NULL THEN f.f_EWCT * cos(radians(mh - 90)) + f.f_NSCT * sin(radians(mh - 90)) END"
                       " AS val_rvlRadVel_projection") + "\n--select\nSELECT * FROM matched", "obs cells")
def j1_currents(t):
    return spatial.radius_join(t.cells, t.obs, ["rvlRadVel", "rvlHeading"], ["EWCT", "NSCT"],
                               MatchSpec(180, 25, 25, "inverse_distance"))


@query("j2_cell_average_join", PAIR_COLS + "sar_owiWindSpeed:d val_WSPD:d collocation_type:s",
       radius_sql(("owiWindSpeed",), ("WSPD",), 25, "greatest(0e0, 1e0 - d / 25e0)") +
       "\n--select\nSELECT *, 'layer_vs_layer' AS collocation_type FROM matched", "obs cells")
def j2(t):
    spec = MatchSpec(180, 25, 25, "linear", collocation_type="layer_vs_layer")
    return spatial.cell_average_join(t.cells, t.obs, ["owiWindSpeed"], ["WSPD"], spec, "scatterometer")


@query("a16_dedup_nearest_in_time", PAIR_COLS + "sar_owiWindSpeed:d val_WSPD:d",
       radius_sql(("owiWindSpeed",), ("WSPD",), 25) + """
--select
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY val_id, sar_scene_name
               ORDER BY abs(epoch_us(val_time) - epoch_us(time)), obs_id) AS rn FROM matched) WHERE rn = 1""", "obs cells")
def a16(t):
    spec = MatchSpec(180, 25, 25, "equal", dedup_nearest_in_time=True)
    return spatial.radius_join(t.cells, t.obs, ["owiWindSpeed"], ["WSPD"], spec)


SPACING_SQL = """
    steps AS (SELECT a.scene, 'lat' AS axis, abs(b.lat - a.lat) AS step FROM cells AS a JOIN cells AS b
              ON a.scene = b.scene AND a.x = b.x AND b.y = a.y + 1
              UNION ALL SELECT a.scene, 'lon', abs(b.lon - a.lon) FROM cells AS a JOIN cells AS b
              ON a.scene = b.scene AND a.y = b.y AND b.x = a.x + 1),
    spacing AS (SELECT s.scene, (s.lat_step * 111.32e0 + s.lon_step * 111.32e0 * cos(radians(m.lat))) / 2 AS spacing_km
                FROM (SELECT scene, quantile_cont(step, 0.5) FILTER (axis = 'lat') AS lat_step,
                             quantile_cont(step, 0.5) FILTER (axis = 'lon') AS lon_step FROM steps GROUP BY scene) AS s
                JOIN (SELECT scene, avg(lat) AS lat FROM cells GROUP BY scene) AS m USING (scene))"""


@query("f28_native_spacing_km", "scene:s spacing_km:d", f"WITH {SPACING_SQL}\n--select\nSELECT * FROM spacing", "cells")
def f28(t):
    return spatial.native_spacing(t.cells, 111.32)


@query("j3_nearest_join", PAIR_COLS.replace("val_id:s ", "") + "sar_pixel_spacing_km:d sar_rvlRadVel:d sar_rvlHeading:d val_EWCT:d val_rvlRadVel_projection:d",
       f"""WITH {candidate_sql("0.545454545454545454545e0")}, {SPACING_SQL},
       ranked AS (SELECT c.scene, c.y, c.x, c.lon AS c_lon, c.lat AS c_lat, c.time AS c_time, c.rvlRadVel, c.rvlHeading, o.*,
                         {hav('o.lon', 'o.lat', 'c.lon', 'c.lat')} AS d
                  FROM cells AS c JOIN cand AS o ON o.scene = c.scene AND c.lat BETWEEN o.lat - 0.4e0 AND o.lat + 0.4e0
                  WHERE c.rvlRadVel IS NOT NULL),
       one AS (SELECT *, row_number() OVER (PARTITION BY scene, y, x ORDER BY round(d * 1e6), obs_id) AS rn
               FROM ranked WHERE d <= 30e0)
--select
SELECT c_lon AS sar_lon, c_lat AS sar_lat, lon AS val_lon, lat AS val_lat, d AS spatial_distance_km,
       abs(epoch_us(o.time) - epoch_us(scene_time)) / 6e7 AS temporal_distance_minutes, 'hf_radar' AS val_source,
       y AS sar_y_idx, x AS sar_x_idx, o.scene AS sar_scene_name, c_time AS time, o.time AS val_time,
       spacing_km AS sar_pixel_spacing_km, rvlRadVel AS sar_rvlRadVel, rvlHeading AS sar_rvlHeading, EWCT AS val_EWCT,
       EWCT * cos(radians(rvlHeading - 90)) + NSCT * sin(radians(rvlHeading - 90)) AS val_rvlRadVel_projection
FROM one AS o JOIN spacing AS s ON s.scene = o.scene WHERE rn = 1 AND (EWCT IS NOT NULL OR NSCT IS NOT NULL)""", "obs cells")
def j3(t):
    return spatial.nearest_join(t.cells, t.obs, ["rvlRadVel", "rvlHeading"], ["EWCT", "NSCT"],
                                MatchSpec(180, 30, 25, "equal"), "hf_radar")


@query("j4_footprint_join", "sar_lon:d sar_lat:d val_lon:d val_lat:d spatial_distance_km:d temporal_distance_minutes:d "
       "val_source:s val_id:s sar_x_idx:i sar_scene_name:s time:t val_time:t sar_oswTotalHs:d val_WSPD:d val_EWCT:d",
       f"""WITH hit AS (SELECT p.scene, p.point_idx, o.obs_id, o.WSPD, o.EWCT, abs(epoch_us(o.time) - epoch_us(p.time)) AS dt,
                         {hav('p.lon', 'p.lat', 'o.lon', 'o.lat')} AS d
                  FROM points AS p JOIN obs AS o ON o.time BETWEEN p.time - INTERVAL 180 MINUTE AND p.time + INTERVAL 180 MINUTE
                  AND o.lat BETWEEN p.lat - 0.3e0 AND p.lat + 0.3e0
                  WHERE p.oswTotalHs IS NOT NULL),
        inside AS (SELECT *, greatest(0e0, 1e0 - d / 28e0) AS wt FROM hit WHERE d <= 28e0),
        agg AS (SELECT scene, point_idx, min(d) AS d, min(dt) AS dt,
                       coalesce(sum(WSPD * wt) / nullif(sum(CASE WHEN WSPD IS NOT NULL THEN wt END), 0), avg(WSPD)) AS val_WSPD,
                       coalesce(sum(EWCT * wt) / nullif(sum(CASE WHEN EWCT IS NOT NULL THEN wt END), 0), avg(EWCT)) AS val_EWCT
                FROM inside GROUP BY ALL),
        near AS (SELECT scene, point_idx, obs_id FROM (SELECT *, row_number() OVER (PARTITION BY scene, point_idx
                 ORDER BY round(d * 1e6), obs_id) AS rn FROM inside) WHERE rn = 1)
--select
SELECT p.lon AS sar_lon, p.lat AS sar_lat, o.lon AS val_lon, o.lat AS val_lat, a.d AS spatial_distance_km,
       a.dt / 6e7 AS temporal_distance_minutes, o.platform_type AS val_source, o.platform_id AS val_id,
       p.point_idx AS sar_x_idx, p.scene AS sar_scene_name, p.time, o.time AS val_time, p.oswTotalHs AS sar_oswTotalHs,
       val_WSPD, val_EWCT
FROM agg AS a JOIN near AS n USING (scene, point_idx) JOIN points AS p USING (scene, point_idx) JOIN obs AS o ON o.obs_id = n.obs_id
WHERE val_WSPD IS NOT NULL OR val_EWCT IS NOT NULL""", "obs points")
def j4(t):
    return spatial.footprint_join(t.points, t.obs, ["oswTotalHs", "oswLandFlag"], ["WSPD", "EWCT"], 28.0, 180.0, "linear")


ASOF_SQL = """WITH times AS (SELECT DISTINCT time AS st FROM cells),
    near AS (SELECT o.*, st, row_number() OVER (PARTITION BY obs_id ORDER BY abs(epoch_us(o.time) - epoch_us(st)), st) AS rn
             FROM obs AS o JOIN times ON o.time BETWEEN st - INTERVAL 720 MINUTE AND st + INTERVAL 720 MINUTE)"""


@query("j5_asof_nearest", "obs_id:i scene_us:i", ASOF_SQL + "\n--select\nSELECT obs_id, epoch_us(st) AS scene_us FROM near WHERE rn = 1",
       "obs cells")
def j5(t):
    return asof.asof_nearest(t.obs, t.cells.select("time"), 720)


@query("j5_average_to_scenes", "platform_id:s time:t lon:d lat:d WSPD:d WDIR:d",
       ASOF_SQL + """
--select
SELECT platform_id, st AS time, avg(lon) AS lon, avg(lat) AS lat, avg(WSPD) AS WSPD, avg(WDIR) AS WDIR
FROM near WHERE rn = 1 GROUP BY platform_id, st""", "obs cells")
def j5_average(t):
    return asof.average_to_scenes(t.obs, t.cells.select("time"), ["platform_id"], ["WSPD", "WDIR"], 720)


@query("j5_snapped_average", "snap_lon:d snap_lat:d time:t WSPD:d n_platforms:i",
       """WITH times AS (SELECT DISTINCT time AS st FROM cells), m AS (SELECT avg(lat) AS ml FROM obs),
    snap AS (SELECT o.*, round_even(lon / (25e0 / (111e0 * cos(radians(ml)))), 0) * (25e0 / (111e0 * cos(radians(ml)))) AS snap_lon,
                    round_even(lat / (25e0 / 111e0), 0) * (25e0 / 111e0) AS snap_lat FROM obs AS o, m),
    near AS (SELECT s.*, st, row_number() OVER (PARTITION BY obs_id ORDER BY abs(epoch_us(s.time) - epoch_us(st)), st) AS rn
             FROM snap AS s JOIN times ON s.time BETWEEN st - INTERVAL 720 MINUTE AND st + INTERVAL 720 MINUTE)
--select
SELECT snap_lon, snap_lat, st AS time, avg(WSPD) AS WSPD, 1 AS n_platforms FROM near WHERE rn = 1 GROUP BY ALL""", "obs cells")
def j5_snapped(t):
    out = asof.average_to_scenes(asof.snapped(t.obs, 25.0), t.cells.select("time"), ["snap_lon", "snap_lat"], ["WSPD"], 720)
    return out.withColumn("n_platforms", F.lit(1))


@query("j6_forward_fill_same_platform", "obs_id:i WSPD:d EWCT:d",
       "WITH filled AS (" + filled_sql(("WSPD", "EWCT"), 2880, "obs", "platform_id") + ")\n--select\n"
       "SELECT obs_id, f_WSPD AS WSPD, f_EWCT AS EWCT FROM filled", "obs")
def j6(t):
    rows = t.obs.withColumn("us", micros("time"))
    return next_valid(rows, ["platform_id"], "us", "obs_id", ["WSPD", "EWCT"], 2880 * spatial.MINUTE)


@query("a15_weights", "obs_id:i gaussian:d inverse:d linear:d equal:d",
       """SELECT obs_id, exp(-(d * d) / 50e0) AS gaussian, 1 / pow(greatest(d, 1e-6), 2) AS inverse,
                 greatest(0, 1 - d / 25e0) AS linear, 1e0 AS equal FROM (SELECT obs_id, abs(lon) * 3e0 + 0.25e0 AS d FROM obs)""", "obs")
def a15(t):
    d = F.abs("lon") * 3 + 0.25
    return t.obs.select("obs_id", *[distance_weight(d, m, 5.0, 25.0).alias(n) for m, n in (
        ("gaussian", "gaussian"), ("inverse_distance", "inverse"), ("linear", "linear"), ("equal", "equal"))])


@query("w1_next_valid_value", "obs_id:i WSPD:d",
       """WITH filled AS (SELECT *, coalesce(WSPD, first_value(WSPD IGNORE NULLS) OVER (PARTITION BY platform_type, platform_id
          ORDER BY time RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND INTERVAL 600 MINUTE FOLLOWING)) AS f FROM obs)
--select
SELECT obs_id, f AS WSPD FROM filled""", "obs")
def w1(t):
    rows = t.obs.withColumn("us", micros("time"))
    return next_valid(rows, ["platform_type", "platform_id"], "us", "obs_id", ["WSPD"], 600 * spatial.MINUTE)


@query("j6_forward_fill_whole_group", "obs_id:i WSPD:d",
       """WITH filled AS (SELECT *, coalesce(WSPD, first_value(WSPD IGNORE NULLS) OVER (PARTITION BY platform_type
          ORDER BY time RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND INTERVAL 600 MINUTE FOLLOWING)) AS f FROM obs)
--select
SELECT obs_id, f AS WSPD FROM filled""", "obs")
def j6_whole_group(t):
    rows = t.obs.withColumn("us", micros("time"))
    return next_valid(rows, ["platform_type"], "us", "obs_id", ["WSPD"], 600 * spatial.MINUTE, platform=None)


# --- models ------------------------------------------------------------------------

BRACKET_SQL = """
    axis AS (SELECT m, lag(m) OVER (ORDER BY m) AS b, lead(m) OVER (ORDER BY m) AS a FROM (SELECT DISTINCT time AS m FROM model)),
    want AS (SELECT DISTINCT time AS st FROM {places}),
    two AS (SELECT st, max(m) AS t2 FROM want JOIN axis ON m <= date_trunc('hour', st) GROUP BY st),
    br AS (SELECT st, b AS t1, m AS t2, a AS t3, (epoch_us(st) - epoch_us(m)) / (epoch_us(a) - epoch_us(m)) AS p
           FROM two JOIN axis ON axis.m = two.t2 WHERE b IS NOT NULL AND a IS NOT NULL AND a - m = m - b)"""


def _blend_sql(v: str) -> str:
    return f"((c.{v} + a.{v} - 2 * b.{v}) / 2) * p * p + ((c.{v} - a.{v}) / 2) * p + b.{v}"


FIELDS_SQL = f"""
    fields AS (SELECT br.st, b.lat_idx, b.lon_idx, b.lat, b.lon, {_blend_sql('u10')} AS u10, {_blend_sql('v10')} AS v10
               FROM br JOIN model AS b ON b.time = br.t2
               LEFT JOIN model AS a ON a.time = br.t1 AND a.lat_idx = b.lat_idx AND a.lon_idx = b.lon_idx
               LEFT JOIN model AS c ON c.time = br.t3 AND c.lat_idx = b.lat_idx AND c.lon_idx = b.lon_idx)"""



@query("j8_temporal_bracket", "t_us:i m_us:i factor_1e4:i",
       "WITH " + BRACKET_SQL.format(places="points") + """
--select
SELECT epoch_us(st) AS t_us, epoch_us(t1) AS m_us, round((p * p - p) / 2 * 1e4 + 1e-7) AS factor_1e4 FROM br
UNION ALL SELECT epoch_us(st), epoch_us(t2), round((1 - p * p) * 1e4 + 1e-7) FROM br UNION ALL SELECT epoch_us(st), epoch_us(t3), round((p * p + p) / 2 * 1e4 + 1e-7) FROM br""",
       "model points")
def j8(t):
    out = model.temporal_bracket(t.points.select("time"), t.model.select("source", "time"))
    return out.withColumn("factor_1e4", F.rint(F.col("factor") * 1e4 + 1e-7))


@query("j8_temporal_nearest", "t_us:i m_us:i",
       """WITH axis AS (SELECT DISTINCT time AS m FROM model), want AS (SELECT DISTINCT time AS st FROM points)
--select
SELECT epoch_us(st) AS t_us, epoch_us(arg_min(m, (abs(epoch_us(st) - epoch_us(m)), m))) AS m_us FROM want, axis GROUP BY st""",
       "model points")
def j8_nearest(t):
    return model.temporal_bracket(t.points.select("time"), t.model.select("source", "time"), "nearest")


def _bilinear_sql(places: str, key: str, cols: str, lsm: bool, where: str = "TRUE") -> str:
    """Each place fetches its four corners at three model times by equality.

    The degree grid gives the lower corner; a value needs all four corners, and a
    corner all three times."""
    land = """LEFT JOIN (SELECT pid, sum(lsm * w) AS lsm FROM corners AS c JOIN static AS s ON s.lat_idx = c.ci AND s.lon_idx = c.cj
                  GROUP BY pid HAVING count(lsm) = 4) AS d USING (pid)""" if lsm else ""
    wet = "NOT coalesce(d.lsm > 0.5, FALSE)" if lsm else "TRUE"
    return f"""
    loc AS MATERIALIZED (SELECT *, row_number() OVER () AS pid, lat - 47.25e0 AS py, lon + 12.75e0 AS px FROM {places} WHERE {where}),
    l AS MATERIALIZED (SELECT loc.*, br.t1, br.t2, br.t3, br.p, CAST(least(8, floor(py)) AS INT) AS i, CAST(least(12, floor(px)) AS INT) AS j,
                 py - least(8, floor(py)) AS fi, px - least(12, floor(px)) AS fj FROM loc JOIN br ON br.st = loc.time
          WHERE py BETWEEN 0 AND 9 AND px BETWEEN 0 AND 13),
    corners AS MATERIALIZED (SELECT pid, t1, t2, t3, p, i + di AS ci, j + dj AS cj,
                 CASE di WHEN 0 THEN 1 - fi ELSE fi END * CASE dj WHEN 0 THEN 1 - fj ELSE fj END AS w
                 FROM l, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS step(di, dj)),
    blended AS MATERIALIZED (SELECT k.pid, sum(({_blend_sql('u10')}) * w) AS u, sum(({_blend_sql('v10')}) * w) AS v FROM corners AS k
                 JOIN model AS a ON a.time = k.t1 AND a.lat_idx = k.ci AND a.lon_idx = k.cj
                 JOIN model AS b ON b.time = k.t2 AND b.lat_idx = k.ci AND b.lon_idx = k.cj
                 JOIN model AS c ON c.time = k.t3 AND c.lat_idx = k.ci AND c.lon_idx = k.cj GROUP BY k.pid HAVING count(*) = 4),
    vals AS (SELECT {key}, {cols}, u, v FROM l JOIN blended USING (pid) {land} WHERE {wet})"""


SPEED_SQL = f"sqrt(u * u + v * v) AS WSPD, {mod('270 - degrees(atan2(v, u))')} AS WDIR"


@query("j7_bilinear_join", "place_id:i WSPD:d WDIR:d",
       "WITH " + BRACKET_SQL.format(places="points") + "," + _bilinear_sql("points", "place_id", "l.time", False)
       + f"\n--select\nSELECT place_id, {SPEED_SQL} FROM vals WHERE u IS NOT NULL AND v IS NOT NULL", "model points")
def j7(t):
    places = t.points.select("place_id", "lon", "lat", "time").withColumn("source", F.lit("era5"))
    return model.model_at_places(places, t.model, ["u10", "v10"]).filter("WSPD IS NOT NULL")


@query("j11_land_mask_join", "place_id:i WSPD:d WDIR:d",
       "WITH " + BRACKET_SQL.format(places="points") + "," + _bilinear_sql("points", "place_id", "l.time", True)
       + f"\n--select\nSELECT place_id, {SPEED_SQL} FROM vals WHERE u IS NOT NULL AND v IS NOT NULL", "model points static")
def j11(t):
    places = t.points.select("place_id", "lon", "lat", "time").withColumn("source", F.lit("era5"))
    return model.model_at_places(places, t.model, ["u10", "v10"], static=t.static).filter("WSPD IS NOT NULL")


@query("j10_model_individual_join", "scene:s y:i x:i owiWindSpeed:d WSPD:d WDIR:d",
       "WITH " + BRACKET_SQL.format(places="cells") + ","
       + _bilinear_sql("cells", "scene", "y, x, owiWindSpeed", True, "owiWindSpeed IS NOT NULL OR owiWindDirection IS NOT NULL")
       + f"\n--select\nSELECT scene, y, x, owiWindSpeed, {SPEED_SQL} FROM vals WHERE u IS NOT NULL AND v IS NOT NULL",
       "model cells static")
def j10(t):
    cells = t.cells.select("scene", "y", "x", "lon", "lat", "time", *WIND)
    return model.individual_join(cells, t.model, WIND, ["u10", "v10"], "era5", static=t.static)


@query("j9_model_cell_average_join", "scene:s sar_y_idx:i sar_x_idx:i val_lon:d val_lat:d spatial_distance_km:d sar_owiWindSpeed:d "
       "val_WSPD:d val_WDIR:d",
       "WITH " + BRACKET_SQL.format(places="cells") + "," + FIELDS_SQL + f""",
    hit AS (SELECT c.scene, c.time, n.lat_idx, n.lon_idx, n.lon, n.lat, c.owiWindSpeed,
                   {hav('n.lon', 'n.lat', 'c.lon', 'c.lat')} AS d
            FROM (SELECT DISTINCT lat_idx, lon_idx, lat, lon FROM model) AS n
            LEFT JOIN static AS s ON s.lat_idx = n.lat_idx AND s.lon_idx = n.lon_idx
            JOIN cells AS c ON c.lat BETWEEN n.lat - 0.5e0 AND n.lat + 0.5e0
            WHERE NOT coalesce(s.lsm > 0.5, FALSE)),
    around AS (SELECT scene, time, lat_idx, lon_idx, lon, lat, avg(d) AS d, avg(owiWindSpeed) AS s FROM hit WHERE d <= 40e0 GROUP BY ALL)
--select
SELECT a.scene, a.lat_idx AS sar_y_idx, a.lon_idx AS sar_x_idx, a.lon AS val_lon, a.lat AS val_lat, d AS spatial_distance_km,
       s AS sar_owiWindSpeed, sqrt(u10 * u10 + v10 * v10) AS val_WSPD, {mod('270 - degrees(atan2(v10, u10))')} AS val_WDIR
FROM around AS a JOIN fields AS f ON f.st = a.time AND f.lat_idx = a.lat_idx AND f.lon_idx = a.lon_idx
WHERE s IS NOT NULL AND u10 IS NOT NULL AND v10 IS NOT NULL""", "model cells static")
def j9(t):
    return model.cell_average_join(t.cells.select("scene", "y", "x", "lon", "lat", "time", "owiWindSpeed"), t.model,
                                   ["owiWindSpeed"], ["u10", "v10"], MatchSpec(60, 25, 40, "equal", 12.5), static=t.static)


@query("wind_statistics_by_source", "source:s N:i bias:d std:d rmse:d correlation:d scatter_index:d",
       radius_sql(("owiWindSpeed",), ("WSPD",), 25) + """
--select
SELECT val_source AS source, count(*) AS N, avg(s - v) AS bias, CASE WHEN count(*) > 1 THEN stddev_samp(s - v) END AS std,
       sqrt(avg((s - v) * (s - v))) AS rmse,
       CASE WHEN count(*) >= 10 AND stddev_pop(s) > 0 AND stddev_pop(v) > 0 THEN corr(s, v) END AS correlation,
       CASE WHEN abs(avg(v)) > 1e-10 THEN sqrt(avg((s - v) * (s - v))) / abs(avg(v)) END AS scatter_index
FROM (SELECT val_source, sar_owiWindSpeed AS s, val_WSPD AS v FROM matched WHERE sar_owiWindSpeed IS NOT NULL AND val_WSPD IS NOT NULL)
GROUP BY val_source""", "obs cells")
def wind_statistics(t):
    """Flagship: match, then agreement per platform type."""
    pairs = spatial.radius_join(t.cells, t.obs, ["owiWindSpeed"], ["WSPD"], EQUAL_25)
    return stats.linear_metrics(pairs, "sar_owiWindSpeed", "val_WSPD")
