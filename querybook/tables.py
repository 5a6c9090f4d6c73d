"""Engine tables derived from the given ones.

One SQL text per table, valid in both engines but for the function that turns
microseconds into a time.  The mapping is deterministic and keeps every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_US = 1_704_067_200_000_000  # 2024-01-01
HOUR_US = 3_600_000_000

DERIVED: dict[str, str] = {
    # readings of stations and platforms
    "obs": """
        SELECT event_id AS obs_id, CAST(user_id AS STRING) AS platform_id, event_type AS platform_type, ts AS time,
               -12e0 + (event_id * 37 % 2400) / 200e0 AS lon, 48e0 + (event_id * 91 % 1600) / 200e0 AS lat,
               CASE WHEN event_id % 11 <> 0 THEN value END AS WSPD,
               CAST(event_id * 53 % 360 AS DOUBLE) AS WDIR,
               CASE WHEN event_id % 7 <> 0 THEN (event_id * 29 % 200) / 100e0 - 1e0 END AS EWCT,
               (event_id * 31 % 200) / 100e0 - 1e0 AS NSCT,
               CAST(event_id % 10 AS INT) AS WSPD_QC, CAST(event_id * 7 % 9 AS INT) AS WDIR_QC,
               CASE WHEN event_id % 13 <> 0 THEN (event_id * 17 % 120) / 10e0 - 2e0 END AS depth
        FROM {events}""",
    # cells of gridded scenes, 500 order numbers to a scene
    "cells": f"""
        SELECT CAST(sc AS STRING) AS scene, y, x, -12e0 + 0.375e0 * x + 0.0137e0 * y AS lon,
               48e0 + 0.25e0 * y - 0.0071e0 * x AS lat, TS_US({BASE_US} + (sc * 37 % 696) * {HOUR_US}) AS time,
               CASE WHEN (y * 7 + x * 3 + sc) % 17 <> 0 THEN q END AS owiWindSpeed,
               CASE WHEN (y + x) % 5 <> 0 THEN CAST(sk * 13 % 360 AS DOUBLE) END AS owiWindDirection,
               ln % 4 AS owiMask, sk % 5 AS owiWindQuality,
               CASE WHEN (y + x) % 3 <> 0 THEN (sk + y) % 4 END AS owiInversionQuality,
               CASE WHEN (y + x + sc) % 19 <> 0 THEN dc / (n * 5e0) - 1e0 END AS rvlRadVel,
               dc / (n * 50e0) AS rvlRadVelStd, 190e0 + y * 0.5e0 + x * 0.25e0 AS rvlHeading,
               CASE WHEN (y + 2 * x) % 13 <> 0 THEN CASE WHEN ln = 7 THEN 1 ELSE 0 END END AS rvlLandFlag
        FROM (SELECT CAST(floor(l_orderkey / 500e0) AS BIGINT) AS sc, CAST(l_partkey % 32 AS INT) AS y,
                     CAST((l_orderkey * 7 + l_linenumber) % 32 AS INT) AS x, avg(l_quantity) AS q,
                     CAST(sum(l_suppkey) AS BIGINT) AS sk, max(l_linenumber) AS ln,
                     CAST(sum(round(l_discount * 100)) AS BIGINT) AS dc, count(*) AS n
              FROM {{lineitem}} GROUP BY 1, 2, 3) AS g""",
    # sparse scene points, 100 order numbers to a scene
    "points": f"""
        SELECT CAST(CAST(floor(o_orderkey / 100e0) AS BIGINT) AS STRING) AS scene,
               CAST(o_orderkey % 100 AS INT) AS point_idx, o_orderkey AS place_id,
               -12e0 + (o_orderkey * 131 % 2399) / 200e0 AS lon, 48e0 + (o_orderkey * 57 % 1601) / 200e0 AS lat,
               TS_US({BASE_US} + (o_orderkey * 613 % 41760) * 60000000) AS time,
               CASE WHEN o_orderkey % 23 <> 0 THEN o_totalprice / 100000e0 END AS oswTotalHs,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 2 END AS oswLandFlag,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 4 END AS oswQualityFlag,
               o_totalprice / 400000e0 - 0.5e0 AS rvlRadVel,
               CASE WHEN o_orderkey % 9 <> 0 THEN 190e0 + o_orderkey % 40 END AS rvlHeading
        FROM {{orders}}""",
    # matched pairs, one per line item
    "pairs": """
        SELECT CASE l_returnflag WHEN 'A' THEN 'mooring' WHEN 'N' THEN 'buoy' ELSE 'scatterometer' END AS val_source,
               CASE WHEN l_suppkey % 9 <> 0 THEN CAST(l_suppkey AS STRING) END AS val_id,
               l_linestatus AS kind, l_shipdate AS val_time,
               CASE WHEN l_linenumber <> 7 THEN l_quantity END AS sar_owiWindSpeed,
               CASE WHEN l_partkey % 29 <> 0 THEN l_extendedprice / 1000e0 END AS val_WSPD,
               CAST(l_partkey % 360 AS DOUBLE) AS sar_owiWindDirection,
               CASE WHEN l_returnflag <> 'R' OR l_linestatus <> 'O' THEN CAST(l_suppkey * 7 % 360 AS DOUBLE) END AS val_WDIR,
               -12e0 + (l_partkey * 37 % 2400) / 200e0 AS sar_lon, 48e0 + (l_suppkey * 91 % 1600) / 200e0 AS sar_lat,
               -12e0 + (l_suppkey * 37 % 2400) / 200e0 AS val_lon, 48e0 + (l_suppkey * 53 % 1600) / 200e0 AS val_lat,
               CASE WHEN l_returnflag = 'A' THEN 'point_vs_layer' WHEN l_returnflag = 'N' THEN 'layer_vs_layer'
                    ELSE 'model_vs_layer' END AS collocation_type,
               CASE WHEN l_returnflag = 'N' THEN 12.5e0 + l_linenumber END AS aggregation_window_km,
               CASE WHEN l_returnflag = 'R' THEN 10e0 + l_linenumber END AS sar_pixel_spacing_km,
               CAST(CAST(floor(l_orderkey / 500e0) AS BIGINT) AS STRING) AS sar_scene_name
        FROM {lineitem}""",
    # soil-moisture pairs: the scene in percent, sources in either units family
    "soil": """
        SELECT CASE l_suppkey % 5 WHEN 0 THEN 'ismn' WHEN 1 THEN 'ascat_ssm' WHEN 2 THEN 'smap_ssm'
                    WHEN 3 THEN 'smos_ssm' ELSE 'cds_ssm' END AS val_source,
               CASE WHEN l_linenumber <> 7 THEN l_quantity * 1.5e0 + l_tax * 100 END AS sar_sarSSM,
               CASE WHEN l_partkey % 31 <> 0 THEN
                    CASE l_suppkey % 5 WHEN 1 THEN l_quantity + l_discount * 200 ELSE l_quantity / 150e0 + l_discount END
               END AS val_SOIL_MOISTURE
        FROM {lineitem}""",
    # gridded model field, 12-hourly, one degree
    "model": f"""
        SELECT 'era5' AS source, TS_US({BASE_US} - {HOUR_US} * 12 + k * {HOUR_US} * 12) AS time, i AS lat_idx, j AS lon_idx,
               47.25e0 + i AS lat, -12.75e0 + j AS lon, q - 25e0 AS u10, dc / n - 5e0 AS v10
        FROM (SELECT l_orderkey % 62 AS k, CAST(l_partkey % 10 AS INT) AS i, CAST(l_suppkey % 14 AS INT) AS j,
                     avg(l_quantity) AS q, CAST(sum(round(l_discount * 100)) AS DOUBLE) AS dc, count(*) AS n
              FROM {{lineitem}} GROUP BY 1, 2, 3) AS g""",
    "static": """
        SELECT 'era5' AS source, i AS lat_idx, j AS lon_idx, 47.25e0 + i AS lat, -12.75e0 + j AS lon, s / 50e0 AS lsm
        FROM (SELECT CAST(p_partkey % 10 AS INT) AS i, CAST(floor(p_partkey / 10e0) AS BIGINT) % 14 AS j,
                     avg(p_size) AS s FROM {part} GROUP BY 1, 2) AS g""",
    # places all over the globe
    "globe": """
        SELECT event_id AS point_id, -180e0 + (event_id * 7919 % 36000) / 100e0 + 0.003e0 AS lon,
               -80e0 + (event_id * 3571 % 16000) / 100e0 + 0.0017e0 AS lat, ts AS time, event_type
        FROM {events}""",
    # scene footprints: a turned square, some across the date line
    "footprints": f"""
        SELECT c_custkey AS fp_id,
               CASE c_custkey % 4 WHEN 0 THEN 'polygon' WHEN 1 THEN 'wv_points' WHEN 2 THEN 'orbit_swath' ELSE 'polygon' END AS kind,
               c_custkey % 4 = 0 AS has_ring, c_nationkey, clon, clat, r,
               clat + r AS lat1, W180(clon) AS lon1, clat AS lat2, W180(clon + r) AS lon2,
               clat - r AS lat3, W180(clon) AS lon3, clat AS lat4, W180(clon - r) AS lon4,
               CASE WHEN abs(clon) + r <= 180 THEN clon - r ELSE -180e0 END AS min_lon,
               CASE WHEN abs(clon) + r <= 180 THEN clon + r ELSE 180e0 END AS max_lon,
               clat - r AS min_lat, clat + r AS max_lat,
               TS_US(us) AS sensing_start, TS_US(us + 600000000) AS sensing_end
        FROM (SELECT c_custkey, c_nationkey, -180e0 + (c_custkey * 977 % 36000) / 100e0 AS clon,
                     -70e0 + (c_custkey * 613 % 14000) / 100e0 AS clat, 2e0 + c_custkey % 5 AS r,
                     {BASE_US} + (c_custkey * 47 % 41760) * 60000000 AS us FROM {{customer}}) AS c""",
    # catalogue entries and requests
    "catalog": f"""
        SELECT o_orderkey AS item_id, lon0 AS r_min_lon, lon0 + 3e0 AS r_max_lon, lat0 AS r_min_lat, lat0 + 2e0 AS r_max_lat,
               TS_US(us) AS r_start, TS_US(us + 5400000000) AS r_end, o_orderpriority AS collection
        FROM (SELECT o_orderkey, o_orderpriority, -180e0 + (o_orderkey * 389 % 35700) / 100e0 AS lon0,
                     -80e0 + (o_orderkey * 211 % 15000) / 100e0 AS lat0,
                     {BASE_US} + (o_orderkey * 73 % 41760) * 60000000 AS us FROM {{orders}}) AS o""",
    # platform files: box and life of the orders of a customer
    "platform_index": """
        SELECT o_custkey AS file_id, min(-180e0 + (o_orderkey * 977 % 36000) / 100e0) AS lon_min,
               max(CASE WHEN o_custkey % 3 = 0 THEN -180e0 + (o_orderkey * 977 % 36000) / 100e0
                        ELSE -180e0 + (o_orderkey * 977 % 9000) / 100e0 END) AS lon_max,
               min(-60e0 + (o_orderkey * 613 % 8000) / 100e0) AS lat_min,
               max(-60e0 + (o_orderkey * 613 % 12000) / 100e0) AS lat_max,
               min(o_orderdate) AS time_start, max(o_orderdate) AS time_end,
               CASE o_custkey % 4 WHEN 0 THEN 'VHM0 VAVH' WHEN 1 THEN 'WSPD WDIR' WHEN 2 THEN 'EWCT NSCT WSPD' ELSE 'TEMP' END AS params
        FROM {orders} GROUP BY o_custkey""",
    "requests": """
        SELECT s_suppkey AS request_id, w AS r_min_lon, CASE WHEN w + 30 > 180 THEN w - 330 ELSE w + 30 END AS r_max_lon,
               -50e0 + s_suppkey % 60 AS r_min_lat, -40e0 + s_suppkey % 60 AS r_max_lat,
               TS_US(788918400000000 + (s_suppkey * 7919 % 2400) * 86400000000) AS r_start,
               TS_US(788918400000000 + (s_suppkey * 7919 % 2400 + 5) * 86400000000) AS r_end
        FROM (SELECT s_suppkey, -180e0 + (s_suppkey * 37 % 360) AS w FROM {supplier}) AS s""",
    # ground tracks and what they may see
    "samples": f"""
        SELECT event_type AS satellite, ts AS t, 78e0 * sin(m * 0.0647e0) AS lat,
               W180(m * 2.31e0 + 40e0 * sin(m * 0.0129e0)) AS lon
        FROM (SELECT event_type, ts, (US_OF(ts) - {BASE_US}) / 60e6 AS m FROM {{events}}) AS e""",
    "targets": f"""
        SELECT s_suppkey AS target_id,
               CASE s_suppkey % 6 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'error' WHEN 3 THEN 'signup'
                    WHEN 4 THEN 'purchase' ELSE 'unknown' END AS satellite,
               CASE s_suppkey % 3 WHEN 0 THEN 'box' WHEN 1 THEN 'polygon' ELSE 'point' END AS shape,
               TS_US(us) AS "start", TS_US(us + 10800000000) AS "end", lat0, lon0, lon0 - 6 AS min_lon, lon0 + 6 AS max_lon,
               lat0 - 5 AS min_lat, lat0 + 5 AS max_lat
        FROM (SELECT s_suppkey, {BASE_US} + (s_suppkey * 389 % 41000) * 60000000 AS us,
                     -60e0 + (s_suppkey * 613 % 12000) / 100e0 AS lat0,
                     -170e0 + (s_suppkey * 977 % 34000) / 100e0 AS lon0 FROM {{supplier}}) AS s""",
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")
_WRAP = "(((({x}) + 180e0) % 360e0 + 360e0) % 360e0 - 180e0)"


def _call(text: str, name: str, make) -> str:
    """Replace every ``name(...)`` call, brackets balanced."""
    while f"{name}(" in text:
        a = text.index(f"{name}(")
        i = a + len(name) + 1
        depth = 1
        while depth:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            i += 1
        text = text[:a] + make(text[a + len(name) + 1:i - 1]) + text[i:]
    return text


def _dialect(text: str, to_ts: str, of_ts: str) -> str:
    text = _call(text, "W180", lambda x: _WRAP.format(x=x))
    text = _call(text, "US_OF", lambda x: f"{of_ts}({x})" if of_ts == "epoch_us" else f"{of_ts}(CAST({x} AS TIMESTAMP))")
    return _call(text, "TS_US", lambda x: f"{to_ts}({x})")


def duck(sql: str, using: list[str], out: str) -> str:
    """The DuckDB text of a query: derived tables first, then the output columns."""
    parts = []
    for name in using:
        text = _dialect(DERIVED[name], "make_timestamp", "epoch_us")
        for t in BASE_TABLES:
            text = text.replace("{" + t + "}", t)
        parts.append(f"{name} AS MATERIALIZED ({text})")
    body = _dialect(sql, "make_timestamp", "epoch_us").strip()
    if body.upper().startswith("WITH "):
        parts.append(body[5:].rsplit("\n--select\n", 1)[0].rstrip().rstrip(","))
        body = body.rsplit("\n--select\n", 1)[1]
    head = f"WITH {', '.join(parts)} " if parts else ""
    return f"{head}SELECT {out} FROM ({body}) AS final"


class Tables:
    """The given tables and those derived from them, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in DERIVED:
            text = _dialect(DERIVED[name], "timestamp_micros", "unix_micros").replace('"', "`")
            used = {t: self.base(t) for t in BASE_TABLES if "{" + t + "}" in text}
            return self.spark.sql(text, **used)
        if name in BASE_TABLES:
            return self.base(name)
        raise AttributeError(name)

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- shapes both engines write differently ----------------------------------

    def ringed(self) -> DataFrame:
        """Footprints with ``polygon`` and ``points`` arrays."""
        f = self.footprints
        vertex = [F.struct(F.col(f"lat{i}").alias("lat"), F.col(f"lon{i}").alias("lon")) for i in range(1, 5)]
        return f.withColumns({"polygon": F.when(F.col("has_ring"), F.array(*vertex)),
                              "points": F.when(F.col("kind") == "wv_points", F.array(*vertex))})


def hav(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Great-circle distance in DuckDB."""
    return (f"(12742e0 * asin(sqrt(least(1e0, greatest(0e0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
            f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))))")


def mod(x: str, m: str = "360e0") -> str:
    """Floored modulo in DuckDB."""
    return f"((({x}) % {m} + {m}) % {m})"
