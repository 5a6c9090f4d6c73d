"""Q1-Q26: cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import query
from querybook.tables import mod
from swathmatch.functions import decode as D
from swathmatch.functions import geo as G
from swathmatch.operators import clean

GOOD = "IN (1, 2, 5, 7, 8)"


@query("q1_qc_whitelist", "obs_id:i WSPD:d WSPD_QC:i WDIR:d WDIR_QC:i",
       f"""SELECT obs_id, CASE WHEN WSPD_QC {GOOD} THEN WSPD END AS WSPD, CASE WHEN WSPD_QC {GOOD} THEN WSPD_QC END AS WSPD_QC,
                  CASE WHEN WDIR_QC {GOOD} THEN WDIR END AS WDIR, CASE WHEN WDIR_QC {GOOD} THEN WDIR_QC END AS WDIR_QC FROM obs""", "obs")
def q1(t):
    return clean.qc_whitelist(t.obs, ["WSPD", "WDIR", "VHM0"])


@query("q2_qc_row_filter", "obs_id:i EWCT:d", f"SELECT obs_id, EWCT FROM obs WHERE WSPD_QC {GOOD} AND (EWCT IS NOT NULL OR WSPD IS NOT NULL)", "obs")
def q2(t):
    return clean.qc_row_filter(t.obs, "WSPD_QC", ["EWCT", "WSPD"])


_MEANINGS = ("not_enough_good_sigma0_for_wind_retrieval monitoring_flag some_portion_of_wvc_is_over_land "
             "wind_inversion_not_successful large_wind_speed")


@query("q3_bitmask_reject", "l_orderkey:i l_linenumber:i flag:i",
       "SELECT l_orderkey, l_linenumber, l_suppkey % 32 AS flag FROM lineitem WHERE ((l_suppkey % 32) & 13) = 0")
def q3(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 32).alias("flag"))
    return clean.bitmask_reject(rows, "flag", D.reject_bits([1, 2, 4, 8, 16], _MEANINGS))


@query("q4_label_reject_mask", "scene:s y:i x:i rejected:b none:b",
       "SELECT scene, y, x, owiWindQuality IN (2, 3) AS rejected, FALSE AS none FROM cells", "cells")
def q4(t):
    rej = D.label_rejected("owiWindQuality", [0, 1, 2, 3], "0:good 1:medium 2:low 3:bad")
    return t.cells.select("scene", "y", "x", rej.alias("rejected"),
                          D.label_rejected("owiWindQuality", [0, 1], "good bad low").alias("none"))


@query("q5_dual_flag_null_reject", "scene:s y:i x:i rejected:b",
       "SELECT scene, y, x, owiInversionQuality IS NULL AND (y + x) % 2 = 0 AS rejected FROM cells", "cells")
def q5(t):
    other = F.when((F.col("y") + F.col("x")) % 2 != 0, F.col("owiWindQuality"))
    return t.cells.select("scene", "y", "x", D.both_missing("owiInversionQuality", other).alias("rejected"))


@query("q6_land_bit_mask", "scene:s y:i x:i owiWindSpeed:d owiWindDirection:d owiHeading:d",
       """SELECT scene, y, x, CASE WHEN owiMask & 1 = 0 THEN owiWindSpeed END AS owiWindSpeed,
                 CASE WHEN owiMask & 1 = 0 THEN owiWindDirection END AS owiWindDirection, rvlHeading AS owiHeading FROM cells""", "cells")
def q6(t):
    return clean.land_bit_mask(t.cells.withColumn("owiHeading", F.col("rvlHeading")), "owiMask", ["owiWindSpeed", "owiWindDirection"])


@query("q7_land_flag_mask", "scene:s y:i x:i rvlRadVel:d rvlRadVelStd:d rvlHeading:d",
       """SELECT scene, y, x, CASE WHEN rvlLandFlag IS DISTINCT FROM 1 THEN rvlRadVel END AS rvlRadVel,
                 CASE WHEN rvlLandFlag IS DISTINCT FROM 1 THEN rvlRadVelStd END AS rvlRadVelStd, rvlHeading FROM cells""", "cells")
def q7(t):
    return clean.land_flag_mask(t.cells, "rvlLandFlag", ["rvlRadVel", "rvlRadVelStd"])


@query("q8_osw_flag_mask", "place_id:i oswTotalHs:d land_masked:b quality_masked:b",
       """SELECT place_id, CASE WHEN oswLandFlag IS DISTINCT FROM 1 AND coalesce(oswQualityFlag, 0) < 2 THEN oswTotalHs END AS oswTotalHs,
                 oswTotalHs IS NOT NULL AND coalesce(oswLandFlag = 1, FALSE) AS land_masked,
                 oswTotalHs IS NOT NULL AND coalesce(oswQualityFlag >= 2, FALSE) AS quality_masked FROM points""", "points")
def q8(t):
    return clean.osw_flag_mask(t.points)


@query("q9_validity_code", "scene:s y:i x:i a:b b:b",
       """SELECT scene, y, x, coalesce(owiWindQuality = 5, FALSE) AS a, coalesce(owiMask - 1 = -1 AND owiInversionQuality = 1, FALSE) AS b FROM cells""",
       "cells")
def q9(t):
    with_flag = t.cells.withColumn("pixel_level_quality_flags", F.col("owiWindQuality"))
    no_flag = with_flag.withColumns({"mask": F.col("owiMask") - 1, "icemask": F.col("owiInversionQuality")})
    return no_flag.select("scene", "y", "x", D.validity_code(with_flag).alias("a"),
                          D.validity_code(no_flag.drop("pixel_level_quality_flags")).alias("b"))


@query("q10_drop_invalid", "obs_id:i WSPD:d", "SELECT obs_id, WSPD FROM obs WHERE WSPD IS NOT NULL AND EWCT IS NOT NULL AND time IS NOT NULL", "obs")
def q10(t):
    return clean.drop_invalid(t.obs, ["WSPD", "EWCT", "time"])


@query("q11_precedence_null_out", "obs_id:i VHM0:d VAVH:d VGHS:d VAVH_QC:i",
       """SELECT obs_id, WSPD AS VHM0, CASE WHEN WSPD IS NULL THEN EWCT END AS VAVH,
                 CASE WHEN WSPD IS NULL AND EWCT IS NULL THEN NSCT END AS VGHS,
                 CASE WHEN WSPD IS NULL OR EWCT IS NULL THEN WDIR_QC END AS VAVH_QC FROM obs""", "obs")
def q11(t):
    rows = t.obs.withColumnsRenamed({"WSPD": "VHM0", "EWCT": "VAVH", "NSCT": "VGHS", "WDIR_QC": "VAVH_QC"})
    return clean.precedence_null_out(rows.drop("WSPD_QC"))


@query("q12_presence_filter", "obs_id:i kind:s",
       """SELECT obs_id, 'wind' AS kind FROM obs WHERE WSPD IS NOT NULL OR EWCT IS NOT NULL
          UNION ALL SELECT obs_id, 'waves' FROM obs WHERE depth IS NOT NULL
          UNION ALL SELECT obs_id, 'currents' FROM obs WHERE WSPD IS NOT NULL AND EWCT IS NOT NULL""", "obs")
def q12(t):
    rows = t.obs.select("obs_id", F.col("WSPD").alias("speed"), F.col("EWCT").alias("direction"), F.col("depth").alias("height"))
    parts = [clean.presence_filter(rows, k).select("obs_id", F.lit(k).alias("kind")) for k in ("wind", "waves", "currents")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("q13_domain_filter", "point_id:i lon:d lat:d",
       """SELECT point_id, lon, lat FROM globe WHERE (lon >= 135 - 110e0 / 55 OR lon <= -120 + 110e0 / 55) AND lat BETWEEN -40 - 2 AND 50 + 2
          AND (point_id % 7 = 0 OR time BETWEEN TIMESTAMP '2024-01-05 00:00:00' - INTERVAL 90 MINUTE AND TIMESTAMP '2024-01-20 00:00:00' + INTERVAL 90 MINUTE)""",
       "globe")
def q13(t):
    rows = t.globe.withColumn("time", F.when(F.col("point_id") % 7 != 0, F.col("time")))
    return clean.domain_filter(rows, 135, -120, -40, 50, "2024-01-05", "2024-01-20", 110, 90)


@query("q14_domain_envelope", "buffer_km:d tolerance_minutes:d",
       "SELECT max(p_size * 0.7e0) AS buffer_km, max(p_partkey % 720) AS tolerance_minutes FROM part")
def q14(t):
    return clean.domain_envelope(t.part.select((F.col("p_size") * 0.7).alias("aggregation_window_km"),
                                               (F.col("p_partkey") % 720).alias("time_tolerance_minutes")))


@query("q16_exclude_platforms", "obs_id:i platform_id:s",
       """SELECT obs_id, platform_id FROM obs WHERE platform_id NOT IN (SELECT CAST(s_suppkey * 3 AS VARCHAR) FROM supplier)""", "obs")
def q16(t):
    return clean.exclude_platforms(t.obs, t.supplier.select((F.col("s_suppkey") * 3).cast("string").alias("platform_id")))


@query("q17_dedupe_overlapping_windows", "product:s o_custkey:i us:i file_name:s",
       """WITH f AS (SELECT 'prod_' || o_orderpriority AS product, o_custkey, epoch_us(o_orderdate) AS us,
            'prod_' || o_orderpriority || '_2024010' || (o_orderkey % 9 + 1) || '_2024020' || (o_orderkey % 7 + 1) || '.nc' AS file_name FROM orders)
--select
SELECT product, o_custkey, us, min(file_name) AS file_name FROM f GROUP BY product, o_custkey, us""")
def q17(t):
    name = F.concat(F.lit("prod_"), "o_orderpriority", F.lit("_2024010"), (F.col("o_orderkey") % 9 + 1).cast("string"),
                    F.lit("_2024020"), (F.col("o_orderkey") % 7 + 1).cast("string"), F.lit(".nc"))
    rows = t.orders.select("o_custkey", F.col("o_orderdate").alias("time"), F.col("o_custkey").alias("lat"), F.lit(0).alias("lon"),
                           name.alias("file_name"))
    return clean.dedupe_overlapping_windows(rows).withColumn("us", F.unix_micros(F.col("time").cast("timestamp")))


@query("q18_shallowest_level", "platform_id:s us:i obs_id:i depth:d",
       """SELECT platform_id, epoch_us(time) AS us, obs_id, depth FROM (SELECT *, row_number() OVER (PARTITION BY platform_id,
          date_trunc('hour', time) ORDER BY depth ASC NULLS LAST, obs_id) AS rn FROM obs) WHERE rn = 1""", "obs")
def q18(t):
    # the readings are an hour apart, so hours play the part of minutes
    hourly = t.obs.withColumns({"us": F.unix_micros(F.col("time").cast("timestamp")), "time": F.date_trunc("hour", "time")})
    return clean.shallowest_level(hourly)


@query("q19_depth_window", "obs_id:i depth:d", "SELECT obs_id, depth FROM obs WHERE depth BETWEEN 0 AND 5", "obs")
def q19(t):
    return clean.depth_window(t.obs, 0.0, 5.0)


@query("q20_dedupe_scene_seam", "lat:d lon:d v:d",
       """WITH n AS (SELECT l_suppkey % 20 AS la, l_partkey % 40 AS lo, l_linenumber % 2 AS part, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3),
          b AS (SELECT la AS lat, 150e0 + lo AS lon, 0 AS p, v FROM n WHERE part = 0
                UNION ALL SELECT la, -190e0 + lo + 360, 1, v FROM n WHERE part = 1)
--select
SELECT lat, lon, v FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY p) AS rn FROM b) WHERE rn = 1""")
def q20(t):
    n = t.lineitem.groupBy((F.col("l_suppkey") % 20).alias("lat"), (F.col("l_partkey") % 40).alias("lo"),
                           (F.col("l_linenumber") % 2).alias("part")).agg(F.avg("l_quantity").alias("v"))
    east = n.filter("part = 0").select("lat", (F.col("lo") + 150.0).alias("lon"), "v")
    west = n.filter("part = 1").select("lat", (F.col("lo") - 190.0).alias("lon"), "v")
    return clean.dedupe_scene_seam(east, west, ["lat"])


@query("q21_drop_nondirectional", "val_source:s n:i",
       """SELECT val_source, count(*) AS n FROM (SELECT CASE WHEN val_WDIR IS NULL THEN 'altimeter' ELSE val_source END AS val_source, val_WDIR FROM pairs)
          GROUP BY val_source HAVING count(val_WDIR) > 0""", "pairs")
def q21(t):
    rows = t.pairs.withColumn("val_source", F.when(F.col("val_WDIR").isNull(), "altimeter").otherwise(F.col("val_source")))
    return clean.drop_nondirectional(rows, "val_WDIR").groupBy("val_source").agg(F.count("*").alias("n"))


@query("q22_scene_filter", "sar_owiWindSpeed:d val_WSPD:d", "SELECT sar_owiWindSpeed, val_WSPD FROM pairs WHERE sar_scene_name = '2'", "pairs")
def q22(t):
    return clean.scene_filter(t.pairs, "2")


@query("q23_variable_relevance", "event_id:i variable:s",
       """SELECT event_id, variable FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'WSPD' WHEN 'view' THEN 'WDIR' WHEN 'error' THEN 'VHM0'
          WHEN 'signup' THEN 'EWCT' ELSE 'TEMP' END AS variable FROM events) WHERE variable IN ('WSPD', 'WDIR')""")
def q23(t):
    e = F.col("event_type")
    v = (F.when(e == "click", "WSPD").when(e == "view", "WDIR").when(e == "error", "VHM0").when(e == "signup", "EWCT").otherwise("TEMP"))
    return clean.variable_relevance(t.events.select("event_id", v.alias("variable")), "wind")


_MISSIONS = """m AS (SELECT n_nationkey AS mission, n_regionkey AS family, TIMESTAMP '1995-01-01' + n_nationkey * INTERVAL 60 DAY AS a,
    CASE WHEN n_nationkey % 3 <> 0 THEN TIMESTAMP '1996-06-01' + n_nationkey * INTERVAL 90 DAY END AS b FROM nation)"""


def _missions(t):
    start = F.timestamp_micros(F.lit(788918400000000) + F.col("n_nationkey") * F.lit(60 * 86_400_000_000))
    end = F.timestamp_micros(F.lit(833587200000000) + F.col("n_nationkey") * F.lit(90 * 86_400_000_000))
    return t.nation.select(F.col("n_nationkey").alias("mission"), F.col("n_regionkey").alias("family"), start.alias("avail_start"),
                           F.when(F.col("n_nationkey") % 3 != 0, end).alias("avail_end"))


@query("q24_availability_clamp", "request_id:i mission:i from_us:i to_us:i", f"""WITH {_MISSIONS},
    r AS (SELECT o_orderkey AS request_id, o_custkey % 5 AS family, o_orderdate AS s, o_orderdate + INTERVAL 30 DAY AS e FROM orders)
--select
SELECT request_id, mission, epoch_us(greatest(s, a)) AS from_us, epoch_us(least(e, coalesce(b, e))) AS to_us
FROM r JOIN m USING (family) WHERE e >= a AND (b IS NULL OR s <= b)""")
def q24(t):
    d = F.col("o_orderdate").cast("timestamp")
    reqs = t.orders.select(F.col("o_orderkey").alias("request_id"), (F.col("o_custkey") % 5).alias("family"), d.alias("start"),
                           (d + F.expr("interval 30 days")).alias("end"))
    out = clean.availability_clamp(reqs, _missions(t))
    return out.select("request_id", "mission", F.unix_micros("start").alias("from_us"), F.unix_micros("end").alias("to_us"))


@query("q24_missions_active_on", "o_orderkey:i mission:i", f"""WITH {_MISSIONS}
--select
SELECT o_orderkey, mission FROM orders JOIN m ON family = o_custkey % 5
WHERE CAST(o_orderdate AS DATE) >= CAST(a AS DATE) AND (b IS NULL OR CAST(o_orderdate AS DATE) <= CAST(b AS DATE))""")
def q24_days(t):
    days = t.orders.select("o_orderkey", (F.col("o_custkey") % 5).alias("family"), F.to_date("o_orderdate").alias("day"))
    return clean.missions_active_on(days, _missions(t))


@query("q25_catalog_dedupe", "product_id:i item:i",
       "SELECT l_orderkey AS product_id, min(l_suppkey * 10 + l_linenumber) AS item FROM lineitem GROUP BY l_orderkey")
def q25(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("product_id"), (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("item"))
    return clean.catalog_dedupe(rows, "product_id", ["item"])


@query("q26_granule_padded_bbox", "point_id:i g_lon:d g_lat:d us:i",
       f"""WITH g AS (SELECT point_id, CASE WHEN point_id % 3 = 0 THEN floor(abs(lon)) * sign(lon) ELSE sign(lon) * (floor(abs(lon)) + 0.5e0) END AS raw,
            CASE WHEN point_id % 3 = 0 THEN floor(abs(lat)) * sign(lat) ELSE sign(lat) * (floor(abs(lat)) + 0.25e0) END AS g_lat,
            date_trunc('second', time) AS ts FROM globe WHERE point_id % 5 <> 4),
          h AS (SELECT point_id, {mod('raw + 180')} - 180 AS g_lon, g_lat, ts FROM g)
--select
SELECT point_id, g_lon, g_lat, epoch_us(ts) AS us FROM h WHERE (g_lon BETWEEN 165 AND 185 OR g_lon <= -175 OR g_lon BETWEEN -185 AND -155 OR g_lon >= 175)
AND g_lat BETWEEN -45 AND 55 AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-25'""", "globe")
def q26(t):
    lon, lat, k = F.col("lon"), F.col("lat"), F.col("point_id")
    ew, ns = F.when(lon >= 0, "E").otherwise("W"), F.when(lat >= 0, "N").otherwise("S")
    whole_lon, whole_lat = F.floor(F.abs(lon)).cast("string"), F.floor(F.abs(lat)).cast("string")
    old = F.concat(F.lit("RSAT2_SCWA_"), F.date_format("time", "yyyy_MM_dd_HH_mm_ss"), F.lit("_0123_"), whole_lon, F.lit(".5"), ew, F.lit("_"),
                   whole_lat, F.lit(".25"), ns, F.lit("_VV_C5_wind_level2_norcs.nc"))
    stamp = F.date_format("time", "yyyyMMddHHmmss")
    new = F.concat(F.lit("SAR-Wind-SCWA-"), whole_lat, ns, F.lit("-"), whole_lon, ew, F.lit("_v01r00_rsat2_s"), stamp, F.lit("0_e"), stamp,
                   F.lit("0_c"), stamp, F.lit("0.nc"))
    name = F.when(k % 5 == 4, "unreadable.nc").when(k % 3 == 0, new).otherwise(old)
    out = clean.granule_padded_bbox(t.globe.select("point_id", name.alias("name")), "name", 170, -160, -40, 50,
                                    "2024-01-03", "2024-01-25", end_exclusive=True)
    return out.withColumn("us", F.unix_micros("g_time"))


@query("q13_box_across_date_line", "point_id:i", "SELECT point_id FROM globe WHERE (lon >= 170 OR lon <= -170) AND lat BETWEEN -30 AND 30", "globe")
def q13_box(t):
    return t.globe.filter(G.in_box("lon", "lat", 170.0, -170.0, -30.0, 30.0))
