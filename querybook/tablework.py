"""Reshaping, scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import query
from swathmatch.operators import reshape, stats
from swathmatch.session import scratch_folder
from swathmatch.sources import readers, sinks
from swathmatch.sources.store import read_store, write_store

TYPES = ("click", "view", "error", "signup", "purchase")


@query("r1_pivot_variables", "user_id:i us:i " + " ".join(f"{c}:d {c}_QC:i" for c in TYPES),
       "SELECT user_id, epoch_us(date_trunc('hour', ts)) AS us, " + ", ".join(
           f"arg_min(value, event_id) FILTER (event_type = '{c}') AS {c}, arg_min(event_id % 10, event_id) FILTER (event_type = '{c}') AS {c}_QC"
           for c in TYPES) + " FROM events GROUP BY 1, 2")
def r1(t):
    long = t.events.select("event_id", "user_id", F.date_trunc("hour", "ts").alias("time"), F.col("event_type").alias("variable"),
                           "value", (F.col("event_id") % 10).cast("int").alias("value_qc"))
    return reshape.pivot_variables(long, ["user_id", "time"], TYPES, "event_id").withColumn("us", F.unix_micros(F.col("time").cast("timestamp")))


@query("s10_melt_to_long", "obs_id:i variable:s value:d value_qc:i",
       """SELECT obs_id, 'WSPD' AS variable, WSPD AS value, WSPD_QC AS value_qc FROM obs WHERE WSPD IS NOT NULL
          UNION ALL SELECT obs_id, 'WDIR', WDIR, WDIR_QC FROM obs UNION ALL SELECT obs_id, 'EWCT', EWCT, NULL FROM obs WHERE EWCT IS NOT NULL""", "obs")
def s10(t):
    return reshape.melt_to_long(t.obs, ["obs_id"], ["WSPD", "WDIR", "EWCT"])


@query("r2_union_sources", "val_source:s val_id:s val_WSPD:d val_SOIL_MOISTURE:d",
       """SELECT val_source, coalesce(val_id, 'unknown') AS val_id, val_WSPD, NULL AS val_SOIL_MOISTURE FROM pairs
          UNION ALL SELECT val_source, 'unknown', NULL, val_SOIL_MOISTURE FROM soil""", "pairs soil")
def r2(t):
    return reshape.union_sources([t.pairs, t.soil])


@query("r3_merge_sibling_nodes", "source:s n:i WSPD:d",
       "SELECT CASE WHEN platform_type IN ('click', 'view') THEN 'smap_ssm' ELSE 'smos_ssm' END AS source, count(*) AS n, avg(WSPD) AS WSPD FROM obs GROUP BY 1", "obs")
def r3(t):
    obs = t.obs.withColumn("source_node", F.col("platform_type"))
    nodes = obs.select("source_node").distinct().withColumn(
        "source_type", F.when(F.col("source_node").isin("click", "view"), "smap_ssm").otherwise("smos_ssm"))
    return reshape.merge_sibling_nodes(obs, nodes).groupBy(F.col("source_node").alias("source")).agg(
        F.count("*").alias("n"), F.avg("WSPD").alias("WSPD"))


@query("r4_merge_wave_columns", "obs_id:i val_SWH:d val_var_code:s",
       """SELECT obs_id, coalesce(WSPD, EWCT, depth) AS val_SWH, CASE WHEN WSPD IS NOT NULL THEN 'VHM0' WHEN EWCT IS NOT NULL THEN 'VAVH'
                 WHEN depth IS NOT NULL THEN 'VGHS' ELSE '' END AS val_var_code FROM obs""", "obs")
def r4(t):
    return reshape.merge_wave_columns(t.obs.select("obs_id", F.col("WSPD").alias("val_VHM0"), F.col("EWCT").alias("val_VAVH"),
                                                   F.col("depth").alias("val_VGHS")))


@query("r5_select_pairs", "quantity:s sar:s val:s n:i",
       """SELECT 'wind' AS quantity, 'owiWindSpeed' AS sar, 'WSPD' AS val, count(*) AS n FROM pairs WHERE sar_owiWindSpeed IS NOT NULL AND val_WSPD IS NOT NULL
          UNION ALL SELECT 'wind', 'owiWindDirection', 'WDIR', count(*) FROM pairs WHERE sar_owiWindDirection IS NOT NULL AND val_WDIR IS NOT NULL
          UNION ALL SELECT 'waves', 'oswHs', 'SWH', count(*) FROM pairs WHERE sar_owiWindSpeed IS NOT NULL AND val_WSPD IS NOT NULL
          UNION ALL SELECT 'waves', 'owiSignificantWaveHeight', 'SWH', count(*) FROM pairs WHERE val_WSPD IS NOT NULL""", "pairs")
def r5(t):
    wind = t.pairs
    waves = t.pairs.withColumnsRenamed({"sar_owiWindSpeed": "sar_oswHs", "val_WSPD": "val_VAVH"}).withColumn(
        "sar_owiSignificantWaveHeight", F.col("sar_lon"))
    out = None
    for quantity, rows in (("wind", wind), ("waves", waves)):
        chosen = reshape.select_pairs(rows, quantity)
        rows = reshape.merge_wave_columns(rows)
        for sar, val in chosen:
            one = rows.filter(F.col(f"sar_{sar}").isNotNull() & F.col(f"val_{val}").isNotNull()).agg(F.count("*").alias("n")).select(
                F.lit(quantity).alias("quantity"), F.lit(sar).alias("sar"), F.lit(val).alias("val"), "n")
            out = one if out is None else out.unionByName(one)
    return out


@query("r6_units_pooling", "val_source:s val_units:s val_long_name:s mixed:b n:i",
       """SELECT val_source, CASE val_source WHEN 'ascat_ssm' THEN '%' WHEN 'cds_ssm' THEN '' ELSE 'm3 m-3' END AS val_units,
                 CASE val_source WHEN 'cds_ssm' THEN '' ELSE 'soil moisture of ' || val_source END AS val_long_name, TRUE AS mixed, count(*) AS n
          FROM soil GROUP BY val_source""", "soil")
def r6(t):
    units = t.soil.filter("val_source <> 'cds_ssm'").select("val_source").distinct().select(
        "val_source", F.when(F.col("val_source") == "ascat_ssm", "%").otherwise("m3 m-3").alias("units"),
        F.concat(F.lit("soil moisture of "), "val_source").alias("long_name"))
    return reshape.units_pooling(t.soil, units).groupBy("val_source", "val_units", "val_long_name", "mixed").agg(F.count("*").alias("n"))


def _windows(t, days):
    d = F.col("o_orderdate").cast("timestamp")
    return t.orders.select(F.col("o_orderkey").alias("request_id"), d.alias("start"), (d + F.expr(f"interval {days} days")).alias("end"))


@query("r7_cutover_split", "request_id:i part:s from_us:i to_us:i",
       """WITH r AS (SELECT o_orderkey AS request_id, o_orderdate AS s, o_orderdate + INTERVAL 20 DAY AS e FROM orders)
--select
SELECT request_id, 'before' AS part, epoch_us(s) AS from_us, epoch_us(CASE WHEN e < TIMESTAMP '1998-03-01' THEN e ELSE TIMESTAMP '1998-02-28 23:59:59' END) AS to_us
FROM r WHERE s < TIMESTAMP '1998-03-01'
UNION ALL SELECT request_id, 'after', epoch_us(greatest(s, TIMESTAMP '1998-03-01')), epoch_us(e) FROM r WHERE e >= TIMESTAMP '1998-03-01'""")
def r7(t):
    out = reshape.cutover_split(_windows(t, 20), "1998-03-01T00:00:00")
    return out.select("request_id", "part", F.unix_micros("start").alias("from_us"), F.unix_micros("end").alias("to_us"))


@query("r7_model_segments", "request_id:i dataset:s from_us:i to_us:i",
       """WITH r0 AS (SELECT o_orderkey AS request_id, o_orderdate + INTERVAL 8900 DAY AS s, o_orderdate + INTERVAL 8920 DAY AS e FROM orders),
          k AS (SELECT TIMESTAMP '2018-12-04' AS f, TIMESTAMP '2024-08-10' AS c),
          r AS (SELECT request_id, greatest(s, f) AS s, e, f, c FROM r0, k WHERE e >= f)
--select
SELECT request_id, 'gofs31_930' AS dataset, epoch_us(greatest(s - INTERVAL 6 HOUR, f)) AS from_us,
       epoch_us(CASE WHEN e > c THEN c - INTERVAL 1 SECOND ELSE e + INTERVAL 6 HOUR END) AS to_us FROM r WHERE s < c OR e <= c
UNION ALL SELECT request_id, 'espc_d_v02', epoch_us(CASE WHEN s < c THEN c ELSE s - INTERVAL 6 HOUR END), epoch_us(e + INTERVAL 6 HOUR) FROM r WHERE e > c""")
def r7_segments(t):
    shift = F.expr("interval 8900 days")
    reqs = _windows(t, 20).withColumns({"start": F.col("start") + shift, "end": F.col("end") + shift})
    out = reshape.model_segments(reqs, 360)
    return out.select("request_id", "dataset", F.unix_micros("start").alias("from_us"), F.unix_micros("end").alias("to_us"))


_KIND = "CASE event_type WHEN 'click' THEN 'hf_radar' WHEN 'view' THEN 'hf_radar_historical' WHEN 'error' THEN 'drifter' WHEN 'signup' THEN 'drifter_historical' ELSE 'altimeter' END"


@query("r8_historical_first", "event_id:i source_type:s window_id:i",
       f"""WITH r AS (SELECT event_id, {_KIND} AS source_type, user_id * 1000 + date_part('day', ts) AS window_id FROM events)
--select
SELECT event_id, source_type, window_id FROM r WHERE NOT EXISTS (SELECT 1 FROM r AS h WHERE h.window_id = r.window_id
AND h.source_type = r.source_type || '_historical')""")
def r8(t):
    rows = t.events.select("event_id", F.expr(_KIND).alias("source_type"), (F.col("user_id") * 1000 + F.dayofmonth("ts")).alias("window_id"))
    return reshape.historical_first(rows)


@query("r9_waterfall_choice", "user_id:i priority:i n:i value:d",
       """WITH r AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS priority, value, date_trunc('day', ts) AS d FROM events)
--select
SELECT user_id, priority, count(*) AS n, avg(value) AS value FROM r JOIN (SELECT user_id, d, min(priority) AS priority FROM r GROUP BY ALL) USING (user_id, d, priority)
GROUP BY user_id, priority""")
def r9(t):
    e = F.col("event_type")
    rows = t.events.select("user_id", F.to_date("ts").alias("d"), "value",
                           F.when(e == "purchase", 0).when(e == "signup", 1).otherwise(2).alias("priority"))
    return reshape.waterfall_choice(rows, ["user_id", "d"]).groupBy("user_id", "priority").agg(
        F.count("*").alias("n"), F.avg("value").alias("value"))


# --- scans ---------------------------------------------------------------------------

@query("s1_scan_obs_long", "obs_id:i platform_id:s lon:d lat:d value:d",
       """SELECT event_id AS obs_id, CAST(6600000 + user_id AS VARCHAR) AS platform_id, event_id % 360 AS lon, event_id % 90 AS lat,
                 CASE WHEN event_id % 11 <> 0 THEN value END AS value FROM events""")
def s1(t):
    raw = t.events.select(F.col("event_id").alias("obs_id"), (F.col("user_id") + 6_600_000).alias("platform_id"),
                          (F.col("event_id") % 360).cast("double").alias("longitude"), (F.col("event_id") % 90).cast("double").alias("latitude"),
                          F.col("ts").alias("time"), F.when(F.col("event_id") % 11 != 0, F.col("value")).otherwise(float("nan")).alias("value"))
    return readers.canonical_obs(raw)


@query("s2_scan_grid_cells", "scene:i y:i x:i lon:d v:d",
       """SELECT o_custkey AS scene, i AS y, j AS x, i * 10 + j + 0.5e0 AS lon, CASE WHEN i <> j THEN o_custkey + i * 2e0 - j END AS v
          FROM (SELECT DISTINCT o_custkey FROM orders) AS s, (VALUES (0), (1), (2)) AS a(i), (VALUES (0), (1)) AS b(j)""")
def s2(t):
    def grid(f):
        return F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(1)), lambda j: f(i, j).cast("double")))

    scenes = t.orders.groupBy(F.col("o_custkey").alias("scene")).agg(F.min("o_orderdate").alias("time")).select(
        "scene", "time", grid(lambda i, j: i * 10 + j + 0.5).alias("lon"), grid(lambda i, j: i + 40).alias("lat"),
        grid(lambda i, j: F.when(i != j, F.col("scene") + i * 2.0 - j).otherwise(float("nan"))).alias("v"))
    return readers.scan_grid_cells(scenes, ["v"])


@query("s5_scan_index", "file_name:s lat_min:d lon_max:d first_us:i n_params:i",
       """SELECT 'GL_TS_' || file_id || '.nc' AS file_name, lat_min, lon_max, epoch_us(time_start) AS first_us, len(string_split(params, ' ')) AS n_params
          FROM platform_index WHERE file_id % 10 NOT IN (3, 7, 9)""", "platform_index")
def s5(t):
    f = t.platform_index
    num = [F.col(c).cast("string") for c in ("lat_min", "lat_max", "lon_min", "lon_max")]
    stamp = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'") for c in ("time_start", "time_end")]
    name = F.concat(F.lit("GL_TS_"), F.col("file_id").cast("string"), F.lit(".nc"))
    k = F.col("file_id") % 10
    good = F.concat_ws(",", name, *num, *stamp, F.lit("inst"), F.col("params"))
    line = (F.when(k == 3, F.concat(F.lit("# "), good)).when(k == 7, F.concat_ws(",", name, *num))
            .when(k == 9, F.concat_ws(",", name, F.lit("n/a"), *num[1:], *stamp, F.lit("inst"), F.col("params"))).otherwise(good))
    rows = readers.parse_index_lines(f.select(line.alias("value")))
    return rows.select("file_name", "lat_min", "lon_max", F.unix_micros("time_start").alias("first_us"), F.size("parameters").alias("n_params"))


_PREFIX = "'/net' || (c.c_custkey % 7) || '/st' || c.c_custkey || '/'"


@query("s6_station_index", "dir_prefix:s network:s station:s lat:d lon:d",
       f"""WITH f AS (SELECT {_PREFIX} AS dir_prefix, 'net' || (c.c_custkey % 7) AS network, 'st' || c.c_custkey AS station, o_orderkey,
             CASE WHEN o_orderkey % 5 <> 0 THEN c.c_custkey % 90 + 0.25e0 END AS lat, CASE WHEN o_orderkey % 5 <> 0 THEN c.c_custkey % 180 + 0.5e0 END AS lon
             FROM orders JOIN customer AS c ON c.c_custkey = o_custkey)
--select
SELECT dir_prefix, network, station, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY dir_prefix ORDER BY 'f' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) AS rn FROM f) WHERE rn = 1""")
def s6(t):
    c, o = F.col("o_custkey"), F.col("o_orderkey")
    prefix = F.concat(F.lit("/net"), (c % 7).cast("string"), F.lit("/st"), c.cast("string"), F.lit("/"))
    path = F.concat(prefix, F.lit("f"), F.lpad(o.cast("string"), 9, "0"), F.lit(".stm"))
    line = F.when(o % 5 != 0, F.concat_ws(" ", F.lit("NET"), F.lit("SUB"), F.lit("ST"), (c % 90 + 0.25).cast("string"), (c % 180 + 0.5).cast("string"),
                                          F.lit("100.0"), F.lit("0.05"), F.lit("0.05"), F.lit("'probe'"))).otherwise("broken header")
    return readers.station_index(t.orders.select(path.alias("path"), line.alias("first_line")))


@query("s7_station_date_ranges", "dir_prefix:s first_us:i last_us:i",
       """SELECT '/st' || user_id || '/' AS dir_prefix, epoch_us(min(date_trunc('minute', ts))) AS first_us, epoch_us(max(date_trunc('minute', ts))) AS last_us
          FROM events WHERE event_id % 6 <> 0 GROUP BY user_id""")
def s7(t):
    path = F.concat(F.lit("/st"), F.col("user_id").cast("string"), F.lit("/a.stm"))
    line = F.when(F.col("event_id") % 6 != 0, F.concat(F.date_format("ts", "yyyy/MM/dd HH:mm"), F.lit("    0.123 G M"))).otherwise("NET SUB ST 1 2")
    out = readers.station_date_ranges(t.events.select(path.alias("path"), line.alias("line")))
    return out.select("dir_prefix", F.unix_micros("first_time").alias("first_us"), F.unix_micros("last_time").alias("last_us"))


@query("s8_platform_ranges", "platform_id:s lat:d lon:d first_time:t last_time:t",
       "SELECT platform_id, arg_min(lat, obs_id) AS lat, arg_min(lon, obs_id) AS lon, min(time) AS first_time, max(time) AS last_time FROM obs GROUP BY platform_id", "obs")
def s8(t):
    return readers.platform_ranges(t.obs)


@query("s9_read_partition_window", "obs_id:i",
       """SELECT obs_id FROM obs WHERE time BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-18' AND lon BETWEEN -10 AND -3
          AND lat BETWEEN 49 AND 54 AND depth BETWEEN -1 AND 8""", "obs")
def s9(t):
    return readers.read_partition_window(t.obs, "2024-01-04", "2024-01-18", -10, -3, 49, 54, -1, 8)


@query("s9_store_window", "obs_id:i WSPD:d timeless:b",
       """SELECT obs_id, WSPD, t IS NULL AS timeless FROM (SELECT *, CASE WHEN obs_id % 17 <> 0 THEN time END AS t FROM obs)
          WHERE (t IS NULL OR t BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-18') AND lon BETWEEN -10 AND -3 AND lat BETWEEN 49 AND 54""", "obs")
def s9_store(t):
    """Observations written by month and place, then read by window and box."""
    path = scratch_folder(t.spark)
    write_store(t.obs.withColumn("time", F.when(F.col("obs_id") % 17 != 0, F.col("time"))), path)
    rows = read_store(t.spark, path, "2024-01-04", "2024-01-18", (-10, -3, 49, 54), timeless=True)
    return rows.withColumn("timeless", F.col("time").isNull())


@query("s12_pairs_store", "method:s val_source:s n:i wind:d",
       """SELECT m.method, val_source, count(*) AS n, avg(val_WSPD) AS wind FROM pairs, (VALUES ('cell-averaging'), ('individual')) AS m(method)
          WHERE val_time BETWEEN TIMESTAMP '1994-03-01' AND TIMESTAMP '1996-08-15' AND sar_lon BETWEEN -9 AND -4 AND sar_lat BETWEEN 50 AND 53 GROUP BY ALL""", "pairs")
def s12_store(t):
    """Matches of two methods side by side, one of them written twice."""
    path = scratch_folder(t.spark)
    for method in ("cell-averaging", "individual", "cell-averaging"):
        write_store(t.pairs.withColumn("method", F.lit(method)), path, "val_time", "sar_lon", "sar_lat", ["method"])
    rows = read_store(t.spark, path, "1994-03-01", "1996-08-15", (-9, -4, 50, 53), "val_time", "sar_lon", "sar_lat")
    return rows.groupBy("method", "val_source").agg(F.count("*").alias("n"), F.avg("val_WSPD").alias("wind"))


@query("s11_union_segments", "source:s n:i u10:d", "SELECT source, count(*) AS n, avg(u10) AS u10 FROM model GROUP BY source", "model")
def s11(t):
    early = t.model.filter(F.col("time") < F.lit("2024-01-15").cast("timestamp"))
    late = t.model.filter(F.col("time") >= F.lit("2024-01-15").cast("timestamp"))
    return readers.union_segments([late, early]).groupBy("source").agg(F.count("*").alias("n"), F.avg("u10").alias("u10"))


@query("s12_sink_pairs", "method:s val_source:s n:i wind:d",
       """SELECT m.method, val_source, count(*) AS n, avg(val_WSPD) AS wind FROM pairs, (VALUES ('cell-averaging'), ('individual')) AS m(method)
          GROUP BY ALL""", "pairs")
def s12(t):
    path = scratch_folder(t.spark)
    for method in ("cell-averaging", "individual", "cell-averaging"):  # a method written again replaces its own part only
        sinks.sink_pairs(t.pairs, path, method)
    return t.spark.read.parquet(path).groupBy("method", "val_source").agg(F.count("*").alias("n"), F.avg("val_WSPD").alias("wind"))


@query("s13_sink_statistics", "form:s source:s N:i bias:d rmse:d",
       """WITH m AS (SELECT CASE WHEN val_source IN ('mooring', 'buoy') THEN 'buoy_family' ELSE val_source END AS source, count(*) AS N, avg(sar_owiWindSpeed - val_WSPD) AS bias, sqrt(avg(pow(sar_owiWindSpeed - val_WSPD, 2))) AS rmse
          FROM pairs WHERE sar_owiWindSpeed IS NOT NULL AND val_WSPD IS NOT NULL GROUP BY 1)
--select
SELECT f.form, m.* FROM m, (VALUES ('csv'), ('parquet')) AS f(form)""", "pairs")
def s13(t):
    path = scratch_folder(t.spark)
    sinks.sink_statistics(stats.linear_metrics(t.pairs, "sar_owiWindSpeed", "val_WSPD"), path)
    parquet = t.spark.read.parquet(f"{path}.parquet").withColumn("form", F.lit("parquet"))
    csv = t.spark.read.schema(parquet.drop("form").schema).option("header", True).csv(f"{path}.csv").withColumn("form", F.lit("csv"))
    return parquet.unionByName(csv)


@query("s14_prediction_json", "source_type:s json:s",
       """SELECT user_id AS source_type, '{"source_type":"' || user_id || '","verdict":"' || (CASE WHEN count(*) % 2 = 0 THEN 'collocated' ELSE 'none-predicted' END)
          || '","first":"' || strftime(min(ts), '%Y-%m-%dT%H:%M:%S') || '"}' AS json FROM events GROUP BY user_id""")
def s14(t):
    p = t.events.groupBy(F.col("user_id").cast("string").alias("source_type")).agg(
        F.when(F.count("*") % 2 == 0, "collocated").otherwise("none-predicted").alias("verdict"), F.min("ts").cast("timestamp").alias("first"))
    return sinks.prediction_json(p)


@query("s15_granule_listing_filter", "event_id:i us:i",
       """SELECT event_id, epoch_us(date_trunc('minute', ts)) AS us FROM events WHERE event_id % 4 IN (0, 1) AND date_trunc('minute', ts) >= TIMESTAMP '2024-01-05'
          AND date_trunc('minute', ts) < TIMESTAMP '2024-01-20'""")
def s15(t):
    k = F.col("event_id") % 4
    minute, full = F.date_format("ts", "yyyyMMddHHmm"), F.date_format("ts", "yyyyMMddHHmmss")
    new = F.concat(F.lit("rtv-uswc-6km-uwls_v1r0_hfr_s"), full, F.lit("0_e"), full, F.lit("0_c"), full, F.lit("0.nc"))
    name = (F.when(k == 0, F.concat(minute, F.lit("_hfr_uswc_6km_rtv_uwls_NDBC.nc"))).when(k == 1, new)
            .when(k == 2, F.concat(minute, F.lit("_hfr_uswc_500m_rtv_uwls_NDBC.nc"))).otherwise("index.html"))
    out = readers.granule_listing(t.events.select("event_id", name.alias("name")), "name", "6km", "2024-01-05", "2024-01-20", end_exclusive=True)
    return out.select("event_id", F.unix_micros("g_time").alias("us"))
