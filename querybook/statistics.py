"""Agreement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import query
from querybook.tables import mod
from swathmatch.operators import stats
from swathmatch.session import scratch_folder
from swathmatch.sources.readers import read_field_map
from swathmatch.sources.sinks import sink_field_map

METRICS = "source:s N:i bias:d std:d rmse:d correlation:d scatter_index:d"


def linear_sql(rows: str, group: str, extra: str = "") -> str:
    """Metrics of *rows* (columns s, v and *group*)."""
    return f"""SELECT {group} AS source, count(*) AS N, avg(s - v) AS bias, CASE WHEN count(*) > 1 THEN stddev_samp(s - v) END AS std,
       sqrt(avg((s - v) * (s - v))) AS rmse,
       CASE WHEN count(*) >= 10 AND stddev_pop(s) > 0 AND stddev_pop(v) > 0 THEN corr(s, v) END AS correlation,
       CASE WHEN abs(avg(v)) > 1e-10 THEN sqrt(avg((s - v) * (s - v))) / abs(avg(v)) END AS scatter_index{extra}
FROM ({rows}) AS r WHERE s IS NOT NULL AND v IS NOT NULL GROUP BY {group}"""


FAMILY = "CASE WHEN val_source IN ('mooring', 'buoy') THEN 'buoy_family' ELSE val_source END"


@query("a1_linear_metrics", METRICS,
       linear_sql(f"SELECT {FAMILY} AS g, sar_owiWindSpeed AS s, val_WSPD AS v FROM pairs", "g"), "pairs")
def a1(t):
    return stats.linear_metrics(t.pairs, "sar_owiWindSpeed", "val_WSPD")


@query("a5_group_key", METRICS,
       linear_sql(f"SELECT {FAMILY} || ' | ' || kind AS g, sar_owiWindSpeed AS s, val_WSPD AS v FROM pairs", "g"), "pairs")
def a5(t):
    return stats.linear_metrics(t.pairs, "sar_owiWindSpeed", "val_WSPD", ["val_source", "kind"])


@query("a1_small_groups", METRICS,
       linear_sql("SELECT CAST(val_time AS DATE) || '' AS g, sar_owiWindSpeed AS s, val_WSPD AS v FROM pairs", "g"), "pairs")
def a1_small(t):
    rows = t.pairs.withColumn("day", F.date_format("val_time", "yyyy-MM-dd"))
    return stats.linear_metrics(rows, "sar_owiWindSpeed", "val_WSPD", ["day"])


CIRCULAR_LAST = f"""SELECT g AS source, N, {mod('degrees(d0) + 180')} - 180 AS bias, CASE WHEN N > 1 AND len > 0 THEN degrees(sqrt(-2 * ln(len))) END AS std, rmse,
       CASE WHEN N >= 10 AND sqrt(aa * bb) > 1e-12 THEN ab / sqrt(aa * bb) END AS correlation,
       CASE WHEN abs({mod('degrees(b0)')}) > 1e-10 THEN rmse / abs({mod('degrees(b0)')}) END AS scatter_index FROM c JOIN m USING (g)"""


def circular_steps(rows: str, group: str) -> str:
    """Two passes: mean directions per group, then deviations from them."""
    return f"""WITH rows AS (SELECT {group} AS g, s, v, {mod('s - v + 180')} - 180 AS d FROM ({rows}) AS r0 WHERE s IS NOT NULL AND v IS NOT NULL),
    m AS (SELECT g, atan2(avg(sin(radians(s))), avg(cos(radians(s)))) AS a0, atan2(avg(sin(radians(v))), avg(cos(radians(v)))) AS b0,
                 atan2(avg(sin(radians(d))), avg(cos(radians(d)))) AS d0,
                 least(1e0, sqrt(pow(avg(sin(radians(d))), 2) + pow(avg(cos(radians(d))), 2))) AS len FROM rows GROUP BY g),
    c AS (SELECT g, sum(sin(radians(s) - a0) * sin(radians(v) - b0)) AS ab, sum(pow(sin(radians(s) - a0), 2)) AS aa,
                 sum(pow(sin(radians(v) - b0), 2)) AS bb, count(*) AS N, sqrt(avg(d * d)) AS rmse FROM rows JOIN m USING (g) GROUP BY g)"""


def circular_sql(rows: str, group: str) -> str:
    return f"{circular_steps(rows, group)}\n--select\n{CIRCULAR_LAST}"


@query("a2_circular_metrics", METRICS,
       circular_sql("SELECT val_source || ' | ' || kind AS k, sar_owiWindDirection AS s, val_WDIR AS v FROM (SELECT * REPLACE ("
                    + FAMILY + " AS val_source) FROM pairs)", "k"), "pairs")
def a2(t):
    return stats.circular_metrics(t.pairs, "sar_owiWindDirection", "val_WDIR", ["val_source", "kind"])


@query("a3_circular_mean_deg", "platform_type:s mean:d",
       f"SELECT platform_type, {mod('degrees(atan2(avg(sin(radians(WDIR))), avg(cos(radians(WDIR)))))')} AS mean FROM obs GROUP BY platform_type", "obs")
def a3(t):
    return t.obs.groupBy("platform_type").agg(stats.circular_mean(F.col("WDIR")).alias("mean"))


@query("a4_circular_corr", "source:s correlation:d",
       circular_sql("SELECT platform_id AS k, WDIR AS s, (obs_id * 17 % 360) * 1e0 AS v FROM obs", "k"), "obs")
def a4(t):
    rows = t.obs.withColumn("other", (F.col("obs_id") * 17 % 360).cast("double"))
    return stats.circular_metrics(rows, "WDIR", "other", ["platform_id"]).select("source", "correlation")


@query("a6_run_statistics", METRICS,
       linear_sql(f"SELECT {FAMILY} AS g, sar_owiWindSpeed AS s, val_WSPD AS v FROM pairs WHERE val_source <> 'cds_ssm'", "g"), "pairs")
def a6(t):
    return stats.run_statistics(t.pairs, "wind", "owiWindSpeed", "WSPD")


# --- distribution matching: quantiles by the SQL engine's own function ---------------------

def knots_sql(rows: str, name: str = "knots") -> str:
    """Knots per group g of *rows* (g, s, v)."""
    return f"""{name}_n AS (SELECT g, count(*) AS n, greatest(2, least(10, count(*) // 20)) AS nb FROM {rows} WHERE s IS NOT NULL AND v IS NOT NULL GROUP BY g),
    {name}_p AS (SELECT g, n, nb, unnest(range(0, nb + 1)) AS i FROM {name}_n),
    {name}_sorted AS (SELECT g, list_sort(list(s)) AS ls, list_sort(list(v)) AS lv FROM {rows} WHERE s IS NOT NULL AND v IS NOT NULL GROUP BY g),
    {name}_q AS (SELECT g, n, i, (i * 1e0 / nb) * (n - 1) AS pos, ls, lv FROM {name}_p JOIN {name}_sorted USING (g)),
    {name}_x AS (SELECT g, n, ls[CAST(floor(pos) AS BIGINT) + 1] + (ls[CAST(ceil(pos) AS BIGINT) + 1] - ls[CAST(floor(pos) AS BIGINT) + 1]) * (pos - floor(pos)) AS qs,
                        lv[CAST(floor(pos) AS BIGINT) + 1] + (lv[CAST(ceil(pos) AS BIGINT) + 1] - lv[CAST(floor(pos) AS BIGINT) + 1]) * (pos - floor(pos)) AS qv FROM {name}_q),
    {name}_u AS (SELECT g, qs, avg(qv) AS qv FROM {name}_x WHERE n >= 2 GROUP BY g, qs),
    {name} AS (SELECT g, qs AS a, qv AS av, lead(qs) OVER w AS b, lead(qv) OVER w AS bv, lag(qs) OVER w IS NULL AS first_piece,
                      lead(qs, 2) OVER w IS NULL AS last_piece FROM {name}_u WINDOW w AS (PARTITION BY g ORDER BY qs) QUALIFY lead(qs) OVER w IS NOT NULL)"""


def piece(x: str, k: str) -> str:
    return f"({x} >= {k}.a OR {k}.first_piece) AND ({x} < {k}.b OR {k}.last_piece)"


def mapped(x: str, k: str) -> str:
    return f"{k}.av + ({k}.bv - {k}.av) * ({x} - {k}.a) / ({k}.b - {k}.a)"


SOIL = "soil_rows AS (SELECT val_source AS g, sar_sarSSM AS s, val_SOIL_MOISTURE AS v FROM soil)"


@query("a7_cdf_match", "g:s s:d v:d m:d", f"""WITH {SOIL}, {knots_sql('soil_rows')}
--select
SELECT r.g, s, v, {mapped('s', 'k')} AS m FROM soil_rows AS r LEFT JOIN knots AS k ON k.g = r.g AND {piece('s', 'k')} WHERE s IS NOT NULL AND v IS NOT NULL""",
       "soil")
def a7(t):
    rows = t.soil.filter("sar_sarSSM IS NOT NULL AND val_SOIL_MOISTURE IS NOT NULL")
    knots = stats.cdf_fit(rows, "sar_sarSSM", "val_SOIL_MOISTURE", ["val_source"])
    out = stats.with_knots(rows, knots, ["val_source"])
    return out.select(F.col("val_source").alias("g"), F.col("sar_sarSSM").alias("s"), F.col("val_SOIL_MOISTURE").alias("v"),
                      stats.cdf_apply(F.col("sar_sarSSM"), F.col("knots")).alias("m"))


POOLED_MAP = f"""ref AS (SELECT * FROM soil_rows WHERE g = 'ismn'), {knots_sql('ref', 'rk')},
    pool AS (SELECT 0 AS g, r.s, CASE WHEN r.g <> 'ascat_ssm' THEN r.v WHEN r.s IS NOT NULL THEN {mapped('r.v', 'k')} END AS v
             FROM soil_rows AS r LEFT JOIN rk AS k ON r.g = 'ascat_ssm' AND {piece('r.v', 'k')}), {knots_sql('pool', 'pk')}"""


@query("a7_pooled_field_map", "scene:s y:i x:i raw:d mapped:d", f"""WITH {SOIL}, {POOLED_MAP}, field AS (SELECT scene, y, x, owiWindSpeed * 1.5e0 AS raw FROM cells)
--select
SELECT scene, y, x, raw, {mapped('raw', 'k')} AS mapped FROM field LEFT JOIN pk AS k ON {piece('raw', 'k')}""", "soil cells")
def a7_field(t):
    """One map of all harmonised pairs, written, read back and laid over a scene field."""
    path = scratch_folder(t.spark)
    sink_field_map(stats.fit_field_map(t.soil, "sar_sarSSM", "val_SOIL_MOISTURE", "%"), path)
    field = t.cells.select("scene", "y", "x", (F.col("owiWindSpeed") * 1.5).alias("raw"))
    return stats.apply_field_map(field, read_field_map(t.spark, path), "raw", "mapped")


@query("a8_soil_metrics", METRICS + " ubrmsd:d",
       linear_sql("SELECT val_source AS g, sar_sarSSM / 100e0 AS s, val_SOIL_MOISTURE AS v FROM soil", "g",
                  ", CASE WHEN count(*) > 1 THEN stddev_pop(s - v) END AS ubrmsd"), "soil")
def a8(t):
    rows = t.soil.withColumn("s", F.col("sar_sarSSM") / 100)
    return stats.linear_metrics(rows, "s", "val_SOIL_MOISTURE", ubrmsd=True)


_HARMONIZED = f"""{SOIL}, ref AS (SELECT * FROM soil_rows WHERE g = 'ismn'), {knots_sql('ref', 'rk')},
    harm AS (SELECT r.g, CASE WHEN r.g <> 'ascat_ssm' THEN r.s WHEN r.v IS NOT NULL THEN {mapped('r.s', 'k1')} END AS s,
                    CASE WHEN r.g <> 'ascat_ssm' THEN r.v WHEN r.s IS NOT NULL THEN {mapped('r.v', 'k2')} END AS v
             FROM soil_rows AS r LEFT JOIN rk AS k1 ON r.g = 'ascat_ssm' AND {piece('r.s', 'k1')}
             LEFT JOIN rk AS k2 ON r.g = 'ascat_ssm' AND {piece('r.v', 'k2')})"""


@query("a9_harmonize_percent_sources", "g:s s:d v:d harmonized:b", f"""WITH {_HARMONIZED}
--select
SELECT g, s, v, CASE WHEN g = 'ascat_ssm' THEN TRUE END AS harmonized FROM harm""", "soil")
def a9(t):
    out = stats.harmonize(t.soil, "sar_sarSSM", "val_SOIL_MOISTURE", "%")
    return out.select(F.col("val_source").alias("g"), F.col("sar_sarSSM").alias("s"), F.col("val_SOIL_MOISTURE").alias("v"), "harmonized")


RESCALED = f"""{_HARMONIZED}, own AS (SELECT * FROM harm WHERE g <> 'ascat_ssm'), {knots_sql('own', 'ok')},
    resc AS (SELECT h.g, CASE WHEN h.s IS NULL OR h.v IS NULL THEN NULL WHEN h.g = 'ascat_ssm' THEN h.s ELSE {mapped('h.s', 'k')} END AS s, h.v
             FROM harm AS h LEFT JOIN ok AS k ON k.g = h.g AND {piece('h.s', 'k')})"""


@query("a11_rescaled_sar_column", "g:s s:d v:d", f"WITH {RESCALED}\n--select\nSELECT g, s, v FROM resc", "soil")
def a11(t):
    out = stats.rescaled_pairs(t.soil, "sar_sarSSM", "val_SOIL_MOISTURE", "%")
    return out.select(F.col("val_source").alias("g"), F.col("sar_sarSSM").alias("s"), F.col("val_SOIL_MOISTURE").alias("v"))


@query("a10_soil_statistics", METRICS + " ubrmsd:d", f"WITH {RESCALED}\n--select\n"
       + linear_sql("SELECT * FROM resc", "g", ", CASE WHEN count(*) > 1 THEN stddev_pop(s - v) END AS ubrmsd") + " HAVING count(*) >= 2", "soil")
def a10(t):
    return stats.soil_statistics(t.soil, "sar_sarSSM", "val_SOIL_MOISTURE", "%")


@query("a12_native_units_statistics", METRICS,
       linear_sql("SELECT val_source AS g, sar_sarSSM AS s, val_SOIL_MOISTURE AS v FROM soil WHERE val_source = 'ascat_ssm'", "g"), "soil")
def a12(t):
    return stats.native_units_statistics(t.soil, "sar_sarSSM", "val_SOIL_MOISTURE", "%")


@query("a13_cds_statistics", METRICS,
       linear_sql("SELECT val_source AS g, sar_sarSSM AS s, val_SOIL_MOISTURE AS v FROM soil WHERE val_source = 'cds_ssm'", "g"), "soil")
def a13(t):
    return stats.cds_statistics(t.soil, "sar_sarSSM", "val_SOIL_MOISTURE")


LAND_QA_SQL = """SELECT scene, count(*) FILTER (rvlLandFlag = 1) AS land_count, count(*) FILTER (rvlLandFlag = 1) * 1e0 / nullif(count(rvlLandFlag), 0) AS land_fraction,
    avg(rvlRadVel) FILTER (rvlLandFlag = 1) AS land_mean FROM cells GROUP BY scene"""


@query("a14_scene_qa", "scene:s land_count:i land_fraction:d land_mean:d", LAND_QA_SQL, "cells")
def a14(t):
    return stats.scene_qa(t.cells, "rvlLandFlag", "rvlRadVel")


@query("a14_mask_qa", "scene:s land_count:i land_fraction:d quality_count:i quality_fraction:d",
       """SELECT scene, count(*) FILTER (owiMask & 1 <> 0) AS land_count, count(*) FILTER (owiMask & 1 <> 0) * 1e0 / count(*) AS land_fraction,
                 count(*) FILTER (owiWindQuality IN (2, 3)) AS quality_count, count(*) FILTER (owiWindQuality IN (2, 3)) * 1e0 / count(*) AS quality_fraction
          FROM cells GROUP BY scene""", "cells")
def a14_masks(t):
    from swathmatch.functions.decode import label_rejected, land_bit

    rows = t.cells.withColumns({"land": land_bit("owiMask"), "quality": label_rejected("owiWindQuality", [0, 1, 2, 3], "good medium low bad")})
    return stats.mask_qa(rows, ["land", "quality"])
