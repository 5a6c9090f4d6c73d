"""Report tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from querybook import query
from querybook.joins import EQUAL_25, radius_sql
from querybook.statistics import CIRCULAR_LAST, LAND_QA_SQL, RESCALED, circular_steps, linear_sql
from querybook.tables import mod
from swathmatch.operators import predict, report, spatial, stats
from swathmatch.operators.ordered import keep_first, micros, with_neighbours

S, V = "sar_owiWindSpeed", "val_WSPD"
DEDUPED = f"""(SELECT val_source, val_id, val_time, val_lat, val_lon, avg({S}) AS {S}, min({V}) AS {V}, count(*) AS n_pixels FROM pairs
    WHERE {S} IS NOT NULL AND {V} IS NOT NULL GROUP BY ALL)"""


@query("t1_dedupe_observations", f"val_source:s val_id:s val_time:t val_lat:d val_lon:d {S}:d {V}:d n_pixels:i", f"SELECT * FROM {DEDUPED}", "pairs")
def t1(t):
    return report.dedupe_observations(t.pairs, S, V)


@query("t1_dedupe_first_row", f"val_source:s val_id:s val_time:t val_lat:d val_lon:d {S}:d {V}:d n_pixels:i kind:s sar_lon:d",
       f"""SELECT *, {V} AS v0 FROM (SELECT val_source, val_id, val_time, val_lat, val_lon, avg({S}) OVER w AS {S}, count(*) OVER w AS n_pixels,
             {V}, kind, sar_lon, row_number() OVER (w ORDER BY {V}, kind, sar_lon) AS rn FROM pairs WHERE {S} IS NOT NULL AND {V} IS NOT NULL
             WINDOW w AS (PARTITION BY val_source, val_id, val_time, val_lat, val_lon)) WHERE rn = 1""", "pairs")
def t1_first_row(t):
    return report.dedupe_observations(t.pairs, S, V, ["kind", "sar_lon"])


@query("t2_scatter_annotations", "N:i bias:d rmse:d correlation:d n_raw:i",
       f"""SELECT count(*) AS N, avg({S} - {V}) AS bias, sqrt(avg(pow({S} - {V}, 2))) AS rmse, corr({S}, {V}) AS correlation, sum(n_pixels) AS n_raw FROM {DEDUPED}""", "pairs")
def t2(t):
    return report.scatter_annotations(t.pairs, S, V)


_DIRS = """SELECT 'all' AS k, avg(sar_owiWindDirection) AS s, min(val_WDIR) AS v, count(*) AS px FROM pairs
    WHERE sar_owiWindDirection IS NOT NULL AND val_WDIR IS NOT NULL GROUP BY val_source, val_id, val_time, val_lat, val_lon"""


@query("t2_scatter_annotations_circular", "N:i bias:d rmse:d correlation:d",
       f"""{circular_steps(_DIRS, "k")}, pm AS (SELECT avg(d) AS mb FROM rows)
--select
SELECT N, mb AS bias, rmse, correlation FROM ({CIRCULAR_LAST}) AS q, pm""", "pairs")
def t2_circular(t):
    return report.scatter_annotations(t.pairs, "sar_owiWindDirection", "val_WDIR")


@query("t3_imbalance_share", "n_sources:i share:d split:b",
       "SELECT count(*) AS n_sources, max(c) * 1e0 / sum(c) AS share, max(c) * 1e0 / sum(c) > 0.7 AS split FROM (SELECT count(*) AS c FROM obs GROUP BY platform_type)", "obs")
def t3(t):
    return report.imbalance_share(t.obs.withColumnRenamed("platform_type", "val_source"))


@query("t4_scatter_groups", "val_source:s kind:s n:i lo:d hi:d",
       f"SELECT val_source, kind, count(*) AS n, least(min({S}), min({V})) AS lo, greatest(max({S}), max({V})) AS hi FROM pairs WHERE {S} IS NOT NULL AND {V} IS NOT NULL GROUP BY ALL",
       "pairs")
def t4(t):
    return report.scatter_groups(t.pairs.dropna(subset=[S, V]), S, V, ["val_source", "kind"])


_BY_KIND = linear_sql(f"SELECT val_source || ' | ' || kind AS g, {S} AS s, {V} AS v FROM (SELECT * REPLACE (CASE WHEN val_source IN ('mooring', 'buoy') THEN 'buoy_family' ELSE val_source END AS val_source) FROM pairs)", "g")


@query("t5_summary_table", "source:s bias:d rmse:d correlation:d",
       f"SELECT source, round(bias, 4) AS bias, round(rmse, 4) AS rmse, round(correlation, 4) AS correlation FROM ({_BY_KIND})", "pairs")
def t5(t):
    return report.summary_table(stats.linear_metrics(t.pairs, S, V, ["val_source", "kind"]))


@query("t6_statistics_bars", "source:s metric:s value:d",
       f"""WITH m AS ({_BY_KIND})
--select
SELECT source, 'bias' AS metric, bias AS value FROM m UNION ALL SELECT source, 'rmse', rmse FROM m UNION ALL SELECT source, 'correlation', correlation FROM m""", "pairs")
def t6(t):
    return report.statistics_bars(stats.linear_metrics(t.pairs, S, V, ["val_source", "kind"]))


def histogram_sql(lo: str, hi: str, where: str = "TRUE") -> str:
    return f"""WITH r AS (SELECT val_source, {S} - {V} AS r FROM pairs WHERE {S} IS NOT NULL AND {V} IS NOT NULL),
    e AS (SELECT *, {lo} AS lo, {hi} AS hi FROM r), b AS (SELECT val_source, lo, hi, least(29, floor((r - lo) / ((hi - lo) / 30))) AS bin FROM e WHERE r BETWEEN lo AND hi),
    c AS (SELECT val_source, lo, hi, bin, count(*) AS count FROM b GROUP BY ALL)
--select
SELECT val_source, bin, lo + bin * ((hi - lo) / 30) AS bin_lo, count, count / (sum(count) OVER (PARTITION BY val_source) * ((hi - lo) / 30)) AS density FROM c"""


_HIST = "val_source:s bin:i bin_lo:d count:i density:d"


@query("t7_residual_histogram", _HIST, histogram_sql("min(r) OVER ()", "max(r) OVER ()"), "pairs")
def t7(t):
    return report.residual_histogram(t.pairs, S, V)


@query("t7_residual_histogram_fixed", _HIST, histogram_sql("-50e0", "50e0"), "pairs")
def t7_fixed(t):
    return report.residual_histogram(t.pairs, S, V, fixed=(-50.0, 50.0))


@query("t7_residual_histogram_source", _HIST, histogram_sql("min(r) OVER (PARTITION BY val_source)", "max(r) OVER (PARTITION BY val_source)"), "pairs")
def t7_source(t):
    return report.residual_histogram(t.pairs, S, V, mode="source")


GRID_SQL = f"""WITH d AS (SELECT val_source, sar_lon AS lon, sar_lat AS lat, {S} - {V} AS diff, aggregation_window_km AS w, sar_pixel_spacing_km AS px FROM pairs
        WHERE {S} IS NOT NULL AND {V} IS NOT NULL AND collocation_type IN ('layer_vs_layer', 'model_vs_layer')),
    g AS (SELECT val_source, coalesce(2 * quantile_cont(w, 0.5) FILTER (w > 0), quantile_cont(px, 0.5), 0) AS km, avg(lat) AS ml, min(lat) AS lat0, min(lon) AS lon0,
                 quantile_cont(abs(diff), 0.98) AS vmax FROM d GROUP BY val_source)"""


@query("t8_difference_grid", "val_source:s row:i col:i mean_diff:d n:i", GRID_SQL + """
--select
SELECT val_source, floor((lat - (lat0 - km / 111.32e0)) / (km / 111.32e0)) AS row,
       floor((lon - (lon0 - km / (111.32e0 * cos(radians(ml))))) / (km / (111.32e0 * cos(radians(ml))))) AS col, avg(diff) AS mean_diff, count(*) AS n
FROM d JOIN g USING (val_source) GROUP BY ALL""", "pairs")
def t8(t):
    return report.difference_grid(t.pairs, S, V)[0]


@query("t8_difference_scales", "val_source:s cell_km:d wraps:b vmax:d", GRID_SQL + "\n--select\nSELECT val_source, km AS cell_km, FALSE AS wraps, vmax FROM g", "pairs")
def t8_scales(t):
    return report.difference_grid(t.pairs, S, V)[1]


# --- matched and unmatched observations ----------------------------------------------------

CLASSIFIED = radius_sql(("owiWindSpeed",), ("WSPD",), 25) + """,
    cat AS (SELECT *, CASE platform_type WHEN 'click' THEN 'Scatterometer' WHEN 'view' THEN 'Radiometer' WHEN 'error' THEN 'Hf_Radar' ELSE 'In-situ' END AS category FROM obs),
    mt AS (SELECT DISTINCT category, round(val_lon, 6) AS lo, round(val_lat, 6) AS la FROM matched JOIN cat USING (obs_id)),
    win AS (SELECT DISTINCT time AS st FROM cells),
    cls AS (SELECT c.obs_id, c.category, c.lon, c.lat, m.lo IS NOT NULL AS matched FROM cat AS c LEFT JOIN mt AS m ON m.category = c.category
            AND m.lo = round(c.lon, 6) AND m.la = round(c.lat, 6)
            WHERE m.lo IS NOT NULL OR c.obs_id % 7 = 0 OR EXISTS (SELECT 1 FROM win WHERE c.time BETWEEN st - INTERVAL 180 MINUTE AND st + INTERVAL 180 MINUTE))"""


def _classified(t, with_times=True):
    p = F.col("platform_type")
    kind = F.when(p == "click", "scatterometer").when(p == "view", "smap_ssm").when(p == "error", "hf_radar").otherwise("mooring")
    obs = t.obs.withColumns({"platform_type": kind, "tolerance_us": F.lit(180 * 60_000_000)})
    pairs = spatial.radius_join(t.cells, obs, ["owiWindSpeed"], ["WSPD"], EQUAL_25).select(
        kind_source("val_source").alias("val_source"), "val_lon", "val_lat")
    timed = obs.withColumn("time", F.when(F.col("obs_id") % 7 != 0, F.col("time")))
    windows = t.cells.groupBy("scene").agg(F.min("time").alias("start"), F.max("time").alias("end"))
    if not with_times:
        windows = windows.withColumns({"start": F.lit(None).cast("timestamp"), "end": F.lit(None).cast("timestamp")})
    return predict.matched_unmatched(timed, pairs, windows)


def kind_source(column):
    # matches of one soil source carry its own name, readings the satellite family
    p = F.col(column)
    return F.when(p == "smap_ssm", "radiometer_ssm").otherwise(p)


@query("j20_matched_unmatched", "obs_id:i category:s lon:d lat:d matched:b", CLASSIFIED + "\n--select\nSELECT * FROM cls", "obs cells")
def j20(t):
    return _classified(t)


@query("j20_without_scene_times", "obs_id:i category:s lon:d lat:d matched:b",
       CLASSIFIED.rsplit("WHERE m.lo IS NOT NULL OR", 1)[0] + ")\n--select\nSELECT * FROM cls", "obs cells")
def j20_without_times(t):
    return _classified(t, with_times=False)


@query("t9_match_coverage", "category:s n_matched:i n_unmatched:i",
       CLASSIFIED + "\n--select\nSELECT category, count(*) FILTER (matched) AS n_matched, count(*) FILTER (NOT matched) AS n_unmatched FROM cls GROUP BY category", "obs cells")
def t9(t):
    return report.match_coverage(_classified(t))


@query("t10_zoom_extent", "min_lon:d max_lon:d min_lat:d max_lat:d",
       "SELECT min(lon) AS min_lon, max(lon) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat FROM (SELECT lon, lat FROM obs UNION ALL SELECT lon, lat FROM cells UNION ALL SELECT lon, lat FROM points)",
       "obs cells points")
def t10(t):
    return report.zoom_extent([t.obs, t.cells, t.points])


@query("t11_sensing_depths", "line:s",
       """WITH n AS (SELECT DISTINCT CASE p_size % 3 WHEN 0 THEN '5' WHEN 1 THEN '2' ELSE '' END AS d, CASE p_size % 4 WHEN 0 THEN 'L' ELSE 'C' END AS b, p_type AS s FROM part)
--select
SELECT string_agg(s, '/' ORDER BY s) || ' ~' || d || 'cm (' || b || '-band)' AS line FROM n WHERE d <> '' GROUP BY d, b""")
def t11(t):
    k = F.col("p_size")
    nodes = t.part.select(F.when(k % 3 == 0, "5").when(k % 3 == 1, "2").otherwise("").alias("sensing_depth_cm"),
                          F.when(k % 4 == 0, "L").otherwise("C").alias("band"), F.col("p_type").alias("source"))
    return report.sensing_depths(nodes)


@query("t12_land_qa_table", "scene:s land_count:i land_fraction:d land_mean:d", f"SELECT * FROM ({LAND_QA_SQL}) WHERE land_count > 0", "cells")
def t12(t):
    return report.land_qa_table(stats.scene_qa(t.cells, "rvlLandFlag", "rvlRadVel"))


@query("t13_matched_scenes", "sar_scene_name:s", "SELECT DISTINCT sar_scene_name FROM pairs", "pairs")
def t13(t):
    return report.matched_scenes(t.pairs)


@query("t14_colour_limits", "side:s vmin:d vmax:d",
       """SELECT 'pooled' AS side, quantile_cont(x, 0.02) AS vmin, quantile_cont(x, 0.98) AS vmax FROM (SELECT owiWindSpeed AS x FROM cells UNION ALL SELECT WSPD FROM obs)""", "cells obs")
def t14(t):
    return report.colour_limits(t.cells.withColumn("v", F.col("owiWindSpeed")), t.obs.withColumn("v", F.col("WSPD")), "v")


@query("t14_colour_limits_apart", "scene:s side:s vmin:d vmax:d",
       """SELECT scene, 'field' AS side, quantile_cont(rvlRadVel, 0.02) AS vmin, quantile_cont(rvlRadVel, 0.98) AS vmax FROM cells GROUP BY scene
          UNION ALL SELECT scene, 'observed', quantile_cont(rvlHeading, 0.02), quantile_cont(rvlHeading, 0.98) FROM cells GROUP BY scene""", "cells")
def t14_apart(t):
    return report.colour_limits(t.cells.withColumn("v", F.col("rvlRadVel")), t.cells.withColumn("v", F.col("rvlHeading")), "v", ["scene"], separate=True)


@query("t15_density_class", "collocation_type:s n:i per_scene:d dense:b",
       """SELECT collocation_type, count(*) AS n, count(*) * 1e0 / (SELECT count(DISTINCT sar_scene_name) FROM pairs) AS per_scene,
                 count(*) * 1e0 / (SELECT count(DISTINCT sar_scene_name) FROM pairs) > 300 AS dense FROM pairs GROUP BY collocation_type""", "pairs")
def t15(t):
    return report.density_class(t.pairs)


@query("t16_report_sections", "section:s g:s n:i s:d", f"""WITH {RESCALED}
--select
SELECT 'matched' AS section, g, count(*) AS n, avg(s) AS s FROM resc WHERE g <> 'cds_ssm' GROUP BY g
UNION ALL SELECT 'native', val_source, count(*), avg(sar_sarSSM) FROM soil WHERE val_source = 'ascat_ssm' GROUP BY val_source
UNION ALL SELECT 'cds', val_source, count(*), avg(sar_sarSSM) FROM soil WHERE val_source = 'cds_ssm' GROUP BY val_source""", "soil")
def t16(t):
    out = None
    for name, rows in report.report_sections(t.soil, "sar_sarSSM", "val_SOIL_MOISTURE", "%").items():
        part = rows.groupBy(F.col("val_source").alias("g")).agg(F.count("*").alias("n"), F.avg("sar_sarSSM").alias("s")).withColumn("section", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# --- windows, top-1, sampling ----------------------------------------------------------------

@query("w2_top_one_per_key", "platform_id:s obs_id:i", """SELECT platform_id, obs_id FROM (SELECT *, row_number() OVER (PARTITION BY platform_id
       ORDER BY WSPD DESC NULLS LAST, obs_id) AS rn FROM obs) WHERE rn = 1""", "obs")
def w2(t):
    return keep_first(t.obs, ["platform_id"], [F.desc_nulls_last("WSPD"), F.col("obs_id")])


@query("w3_neighbour_difference", "obs_id:i prev_us:i next_us:i",
       """SELECT obs_id, lag(epoch_us(time)) OVER w AS prev_us, lead(epoch_us(time)) OVER w AS next_us FROM obs WINDOW w AS (PARTITION BY platform_type ORDER BY time, obs_id)""", "obs")
def w3(t):
    rows = t.obs.withColumn("us", micros("time"))
    return with_neighbours(rows, ["platform_type"], ["us", "obs_id"], ["us"], "us", 86_400_000_000)


@query("w4_seeded_sample", "obs_id:i", "SELECT obs_id FROM obs ORDER BY md5('7:' || obs_id), obs_id LIMIT 1000", "obs")
def w4(t):
    return report.seeded_sample(t.obs, "obs_id", 1000, seed=7)


@query("w5_stride_decimate", "scene:s y:i x:i", "SELECT scene, y, x FROM cells WHERE y % 3 = 0 AND x % 3 = 0", "cells")
def w5(t):
    return report.stride_decimate(t.cells, 3)


@query("w6_ordered_per_source", "source:s N:i position:i",
       "SELECT val_source AS source, count(*) AS N, row_number() OVER (ORDER BY val_source) AS position FROM pairs GROUP BY val_source", "pairs")
def w6(t):
    rows = report.ordered(t.pairs.groupBy(F.col("val_source").alias("source")).agg(F.count("*").alias("N")), "source")
    # positions over the few sources of the finished table
    return rows.withColumn("position", F.row_number().over(Window.orderBy("source")))
