"""Functions of single rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import query
from querybook.tables import hav, mod
from swathmatch.functions import decode as D
from swathmatch.functions import geo as G
from swathmatch.operators import reshape
from swathmatch.sources import readers

RAD = "radians({})".format


@query("f1_haversine_km", "point_id:i d:d", f"SELECT point_id, {hav('lon', 'lat', '-5e0', '50e0')} AS d FROM globe", "globe")
def f1(t):
    return t.globe.select("point_id", G.haversine_km("lon", "lat", -5.0, 50.0).alias("d"))


@query("f2_unit_xyz", "point_id:i ux:d uy:d uz:d",
       "SELECT point_id, cos(radians(lat)) * cos(radians(lon)) AS ux, cos(radians(lat)) * sin(radians(lon)) AS uy, sin(radians(lat)) AS uz FROM globe",
       "globe")
def f2(t):
    x, y, z = G.unit_xyz("lon", "lat")
    return t.globe.select("point_id", x.alias("ux"), y.alias("uy"), z.alias("uz"))


def bearing_sql(lat1, lon1, lat2, lon2):
    y = f"sin(radians({lon2} - {lon1})) * cos(radians({lat2}))"
    x = (f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon2} - {lon1}))")
    return mod(f"degrees(atan2({y}, {x}))")


@query("f3_bearing_deg", "point_id:i b:d", f"SELECT point_id, {bearing_sql('lat', 'lon', '50e0', '-5e0')} AS b FROM globe", "globe")
def f3(t):
    return t.globe.select("point_id", G.bearing_deg("lat", "lon", 50.0, -5.0).alias("b"))


def destination_sql(lat, lon, brg, km):
    d = f"({km} / 6371e0)"
    p2 = f"asin(sin(radians({lat})) * cos({d}) + cos(radians({lat})) * sin({d}) * cos(radians({brg})))"
    l2 = (f"degrees(radians({lon}) + atan2(sin(radians({brg})) * sin({d}) * cos(radians({lat})), cos({d}) - sin(radians({lat})) * sin({p2})))")
    return f"degrees({p2})", f"({mod(l2 + ' + 180')} - 180)"


_DLAT, _DLON = destination_sql("lat", "lon", "(point_id * 41 % 360)", "(50e0 + point_id % 900)")


@query("f4_destination_point", "point_id:i lat2:d lon2:d", f"SELECT point_id, {_DLAT} AS lat2, {_DLON} AS lon2 FROM globe", "globe")
def f4(t):
    lat, lon = G.destination_point("lat", "lon", F.col("point_id") * 41 % 360, F.col("point_id") % 900 + 50.0)
    return t.globe.select("point_id", lat.alias("lat2"), lon.alias("lon2"))


def segment_sql(lat, lon, lat1, lon1, lat2, lon2):
    d13, d12, d23 = hav(lon1, lat1, lon, lat), hav(lon1, lat1, lon2, lat2), hav(lon2, lat2, lon, lat)
    turn = f"(radians({bearing_sql(lat1, lon1, lat, lon)}) - radians({bearing_sql(lat1, lon1, lat2, lon2)}))"
    xt = f"(asin(least(1e0, greatest(-1e0, sin({d13} / 6371e0) * sin({turn})))) * 6371e0)"
    at = f"(acos(least(1e0, greatest(-1e0, cos({d13} / 6371e0) / cos({xt} / 6371e0)))) * 6371e0)"
    return f"CASE WHEN {d12} = 0 OR cos({turn}) < 0 THEN {d13} WHEN {at} > {d12} THEN {d23} ELSE abs({xt}) END"


@query("f5_segment_distance_km", "point_id:i d:d",
       f"SELECT point_id, {segment_sql('lat', 'lon', '40e0', '-20e0', '55e0', '10e0')} AS d FROM globe", "globe")
def f5(t):
    return t.globe.select("point_id", G.segment_distance_km("lat", "lon", 40.0, -20.0, 55.0, 10.0).alias("d"))


@query("f6_norm_lon180", "point_id:i lon:d", f"SELECT point_id, {mod('lon * 3 + 180')} - 180 AS lon FROM globe", "globe")
def f6(t):
    return t.globe.select("point_id", G.norm_lon180(F.col("lon") * 3).alias("lon"))


@query("f7_shift_lon_stitched", "point_id:i q:d back:d",
       """SELECT point_id, CASE WHEN point_id % 2 = 0 AND lon < 0 THEN lon + 360 ELSE lon END AS q,
                 CASE WHEN lon + 100 > 180 THEN lon + 100 - 360 ELSE lon + 100 END AS back FROM globe""", "globe")
def f7(t):
    top = F.when(F.col("point_id") % 2 == 0, 200.0).otherwise(180.0)
    return t.globe.select("point_id", G.shift_lon_stitched("lon", top).alias("q"),
                          G.unshift_lon_stitched(F.col("lon") + 100).alias("back"))


@query("f8_circular_diff_deg", "obs_id:i d:d",
       f"SELECT obs_id, {mod('WDIR - (obs_id * 7 % 360) + 180')} - 180 AS d FROM obs", "obs")
def f8(t):
    return t.obs.select("obs_id", G.circular_diff_deg("WDIR", F.col("obs_id") * 7 % 360).alias("d"))


@query("f9_project_radial", "obs_id:i r:d",
       "SELECT obs_id, EWCT * cos(radians(WDIR - 90)) + NSCT * sin(radians(WDIR - 90)) AS r FROM obs", "obs")
def f9(t):
    return t.obs.select("obs_id", G.project_radial("EWCT", "NSCT", "WDIR").alias("r"))


@query("f10_uv_to_speed_dir", "obs_id:i speed:d direction:d",
       f"SELECT obs_id, sqrt(EWCT * EWCT + NSCT * NSCT) AS speed, {mod('270 - degrees(atan2(NSCT, EWCT))')} AS direction FROM obs", "obs")
def f10(t):
    s, d = D.uv_to_speed_dir("EWCT", "NSCT")
    return t.obs.select("obs_id", s.alias("speed"), d.alias("direction"))


@query("f11_speed_dir_to_uv", "obs_id:i e:d n:d",
       "SELECT obs_id, WSPD * sin(radians(WDIR)) AS e, WSPD * cos(radians(WDIR)) AS n FROM obs", "obs")
def f11(t):
    e, n = D.speed_dir_to_uv("WSPD", "WDIR")
    return t.obs.select("obs_id", e.alias("e"), n.alias("n"))


@query("f12_rotate_180", "obs_id:i d:d", "SELECT obs_id, (WDIR + 180) % 360 AS d FROM obs", "obs")
def f12(t):
    return t.obs.select("obs_id", D.rotate_180("WDIR").alias("d"))


@query("f13_decode_dn", "l_orderkey:i l_linenumber:i a:d b:d",
       """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 256 NOT IN (251, 252, 253, 254, 255) THEN (l_partkey % 256) * 0.5e0 - 3 END AS a,
                 CASE WHEN l_suppkey % 256 < 251 THEN (l_suppkey % 256) * 0.2e0 END AS b FROM lineitem""")
def f13(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        D.decode_dn(F.col("l_partkey") % 256, 0.5, -3, reserved=(251, 252, 253, 254, 255)).alias("a"),
        D.decode_dn(F.col("l_suppkey") % 256, 0.2, 0, reserved_from=251).alias("b"))


@query("f14_fill_to_null", "obs_id:i a:d b:d",
       """SELECT obs_id, CASE WHEN obs_id % 17 <> 0 AND obs_id % 19 <> 0 THEN WDIR END AS a,
                 CASE WHEN depth >= 0 THEN depth END AS b FROM obs""", "obs")
def f14(t):
    raw = F.when(F.col("obs_id") % 17 == 0, -9999.0).when(F.col("obs_id") % 19 == 0, -999.0).otherwise(F.col("WDIR"))
    return t.obs.select("obs_id", D.fill_to_null(raw, -9999, -999).alias("a"), D.fill_to_null("depth", negative=True).alias("b"))


@query("f15_epoch_time", "o_orderkey:i a_us:i b_us:i",
       """SELECT o_orderkey, epoch_us(TIMESTAMP '1993-01-01') + (o_orderkey * 86413) * 1000000 AS a_us,
                 epoch_us(TIMESTAMP '2000-01-01') + (o_orderkey % 9000) * 86400000000 + (o_orderkey % 1440) * 60000000 AS b_us FROM orders""")
def f15(t):
    a = D.epoch_time("1993-01-01", seconds=F.col("o_orderkey") * 86413)
    b = D.epoch_time("2000-01-01", days=F.col("o_orderkey") % 9000, seconds=(F.col("o_orderkey") % 1440) * 60)
    return t.orders.select("o_orderkey", F.unix_micros(a).alias("a_us"), F.unix_micros(b).alias("b_us"))


_STAMP = "strftime(time, '%Y%m%dT%H%M%S')"


@query("f16_parse_time_coerce", "obs_id:i us:i",
       "SELECT obs_id, CASE WHEN obs_id % 5 <> 0 THEN epoch_us(date_trunc('second', time)) END AS us FROM obs", "obs")
def f16(t):
    text = F.date_format("time", "yyyyMMdd'T'HHmmss")
    broken = F.when(F.col("obs_id") % 5 == 0, F.concat(F.substring(text, 1, 13), F.lit("25.***Z"))).otherwise(text)
    return t.obs.select("obs_id", F.unix_micros(D.parse_time_coerce(broken, "yyyyMMdd'T'HHmmss")).alias("us"))


@query("f17_acq_time_coalesce", "obs_id:i attr_first:i name_first:i token:i",
       """SELECT obs_id, CASE WHEN obs_id % 3 <> 0 THEN epoch_us(date_trunc('minute', time)) WHEN obs_id % 4 <> 0
                    THEN epoch_us(date_trunc('second', time)) END AS attr_first,
                 CASE WHEN obs_id % 4 <> 0 THEN epoch_us(date_trunc('second', time)) WHEN obs_id % 3 <> 0
                    THEN epoch_us(date_trunc('minute', time)) END AS name_first,
                 CASE WHEN obs_id % 2 = 0 THEN epoch_us(date_trunc('minute', time)) ELSE epoch_us(date_trunc('day', time)) END AS token
          FROM obs""", "obs")
def f17(t):
    stamp = F.lower(F.date_format("time", "yyyyMMdd'T'HHmmss"))
    name = F.when(F.col("obs_id") % 4 != 0, F.concat(F.lit("s1a-iw-ocn-vv-"), stamp, F.lit("-001.nc"))).otherwise("s1a-iw.nc")
    attr = F.when(F.col("obs_id") % 3 != 0, F.date_format("time", "yyyy-MM-dd'T'HH:mm:00'Z'"))
    token = F.when(F.col("obs_id") % 2 == 0, F.date_format("time", "yyyyMMddHHmm")).otherwise(F.date_format("time", "yyyyMMdd"))
    file = F.concat(F.lit("c_gls_SSM1km_"), token, F.lit("_CEURO_V1.tif"))
    return t.obs.select("obs_id", F.unix_micros(D.acquisition_time(attr, name)).alias("attr_first"),
                        F.unix_micros(D.acquisition_time(attr, name, prefer_name=True)).alias("name_first"),
                        F.unix_micros(D.name_date_token(file)).alias("token"))


@query("f18_normalize_datetime", "obs_id:i iso:s",
       """SELECT obs_id, CASE obs_id % 6 WHEN 0 THEN strftime(time, '%Y-%m-%dT00:00:00') ELSE strftime(time, '%Y-%m-%dT%H:%M:%S') END AS iso
          FROM obs""", "obs")
def f18(t):
    def fmt(p):
        return F.date_format("time", p)

    k = F.col("obs_id") % 6
    text = (F.when(k == 0, fmt("yyyy-MM-dd")).when(k == 1, fmt("yyyy-MM-dd'T'HH:mm:ss")).when(k == 2, fmt("yyyy-MM-dd HH:mm:ss.SSS"))
            .when(k == 3, fmt("yyyy-MM-dd HHmmss")).when(k == 4, fmt("yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .otherwise(F.concat(fmt("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))))
    return t.obs.select("obs_id", D.normalize_datetime(text).alias("iso"))


@query("f19_decode_flag_labels", "obs_id:i label:s",
       """SELECT obs_id, CASE WSPD_QC WHEN 0 THEN 'good' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 5 THEN 'bad' ELSE 'unknown' END AS label
          FROM obs""", "obs")
def f19(t):
    return t.obs.select("obs_id", D.decode_flag_labels("WSPD_QC", D.paired_labels([0, 1, 2, 5], "good medium low bad")).alias("label"))


@query("f20_resolution_from_name", "p_partkey:i km:d",
       """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 12.5e0 WHEN 1 THEN 6.25e0 + p_partkey % 7 ELSE 12.5e0 END AS km FROM part""")
def f20(t):
    km = (F.col("p_partkey") % 7 + 6.25).cast("string")
    name = F.when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("W_IT-HSAF-SSM-"), km, F.lit("km-H122.nc"))).otherwise("SOMO12_2024.nat")
    return t.part.select("p_partkey", D.resolution_from_name(name).alias("km"))


@query("f21_gdop", "obs_id:i g:d", "SELECT obs_id, coalesce(sqrt(EWCT * EWCT + NSCT * NSCT), WSPD) AS g FROM obs", "obs")
def f21(t):
    return t.obs.select("obs_id", D.gdop("EWCT", "NSCT", "WSPD").alias("g"))


@query("f22_first_available_column", "event_id:i wind:d", "SELECT event_id, value AS wind FROM events")
def f22(t):
    chosen = D.first_available(t.events, ["wind_speed_LF", "wind_speed_MF", "wind_speed_AW", "value"])
    return t.events.select("event_id", F.col(chosen).alias("wind"))


@query("f23_canonical_rename", "event_id:i lon:d WSPD:d", "SELECT event_id, event_id % 360 AS lon, value AS WSPD FROM events")
def f23(t):
    raw = t.events.withColumn("longitude", F.col("event_id") % 360)
    return D.canonical_rename(raw, {"longitude": "lon", "value": "WSPD", "absent": "WDIR"})


@query("f24_platform_label", "event_id:i label:s",
       """SELECT event_id, CASE user_id % 6 WHEN 0 THEN 'mooring' WHEN 1 THEN 'buoy' WHEN 2 THEN 'ferrybox' WHEN 3 THEN 'tidal_gauge'
                 WHEN 4 THEN 'drifter' ELSE event_type END AS label FROM events""")
def f24(t):
    k = F.col("user_id") % 6
    code = F.when(k == 0, "MO").when(k == 1, "DB").when(k == 2, "FB").when(k == 3, "TG").when(k == 4, "AD").otherwise("XX")
    return t.events.select("event_id", D.platform_label(code, "event_type").alias("label"))


@query("f25_wmo_platform_class", "event_id:i class:s",
       "SELECT event_id, CASE WHEN event_id % 13 <> 0 AND event_id % 1000 < 500 THEN 'mooring' ELSE 'buoy' END AS class FROM events")
def f25(t):
    wmo = F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("D"), F.col("event_id").cast("string"))).otherwise(
        (F.col("event_id") + 6_600_000).cast("string"))
    return t.events.select("event_id", D.wmo_platform_class(wmo).alias("class"))


@query("f26_mean_valid_partitions", "obs_id:i hs:d",
       """SELECT obs_id, coalesce(WSPD, (SELECT avg(v) FROM (VALUES (EWCT), (NSCT), (depth)) AS x(v) WHERE v > 0)) AS hs FROM obs""", "obs")
def f26(t):
    return t.obs.select("obs_id", D.mean_valid_partitions("WSPD", F.array("EWCT", "NSCT", "depth")).alias("hs"))


@query("f27_swath_to_columns", "l_orderkey:i l_linenumber:i y:i x:i",
       "SELECT l_orderkey, l_linenumber, l_partkey % 50 AS y, (l_suppkey % 3) * 40 + l_orderkey % 40 AS x FROM lineitem")
def f27(t):
    cells = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 50).alias("y"),
                              (F.col("l_orderkey") % 40).alias("x"), (F.col("l_suppkey") % 3).alias("k"), F.lit(40).alias("nx"))
    return reshape.swath_to_columns(cells)


@query("f29_snap_to_grid", "point_id:i lon:d lat:d",
       "SELECT point_id, round_even(lon / 0.25e0, 0) * 0.25e0 AS lon, round_even(lat / 0.1e0, 0) * 0.1e0 AS lat FROM globe", "globe")
def f29(t):
    return t.globe.select("point_id", G.snap_to_grid("lon", 0.25).alias("lon"), G.snap_to_grid("lat", 0.1).alias("lat"))


# request boxes and region boxes, both from the given tables
_REQUEST = "request_id, CASE WHEN r_min_lon < 150 THEN r_min_lon ELSE -180 END AS a, r_min_lat AS c"
_REGION = "'N' || c_custkey AS region"


def _requests(t):
    w = F.when(F.col("r_min_lon") < 150, F.col("r_min_lon")).otherwise(-180.0)
    return t.requests.select("request_id", w.alias("min_lon"), (w + 30).alias("max_lon"),
                             F.col("r_min_lat").alias("min_lat"), F.col("r_max_lat").alias("max_lat"))


def _regions(t):
    return t.footprints.select(F.concat(F.lit("N"), F.col("fp_id").cast("string")).alias("region"), F.col("fp_id").alias("region_order"),
                               "min_lon", "max_lon", "min_lat", "max_lat")


_BOXES = f"""WITH rq AS (SELECT {_REQUEST}, r_max_lat AS d FROM requests),
    rg AS (SELECT 'N' || CAST(fp_id AS VARCHAR) AS region, fp_id AS ord, min_lon, max_lon, min_lat, max_lat FROM footprints)"""


@query("f30_region_assign_largest", "request_id:i region:s area:d", _BOXES + """
--select
SELECT request_id, region, area FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY area DESC, ord) AS rn FROM (
    SELECT request_id, region, ord, (least(a + 30, max_lon) - greatest(a, min_lon)) * (least(d, max_lat) - greatest(c, min_lat)) AS area
    FROM rq JOIN rg ON least(a + 30, max_lon) > greatest(a, min_lon) AND least(d, max_lat) > greatest(c, min_lat))) WHERE rn = 1""",
       "requests footprints")
def f30(t):
    return reshape.largest_overlap(_requests(t), _regions(t))


@query("f30_region_assign_centre", "request_id:i region:s", _BOXES + """
--select
SELECT request_id, arg_min(region, ord) AS region FROM rq JOIN rg ON a + 15 BETWEEN min_lon AND max_lon
    AND (c + d) / 2 BETWEEN min_lat AND max_lat GROUP BY request_id""", "requests footprints")
def f30_centre(t):
    return reshape.centre_region(_requests(t), _regions(t))


@query("f31_finest_resolution", "p_partkey:i km:d",
       """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 1e0 + p_partkey % 3 ELSE least(1e0 + p_partkey % 3, 0.5e0 + p_partkey % 5) END AS km
          FROM part""")
def f31(t):
    one = F.array((F.col("p_partkey") % 3 + 1.0), F.lit(6.0))
    two = F.when(F.col("p_partkey") % 4 != 0, F.array(F.col("p_partkey") % 5 + 0.5))
    return t.part.select("p_partkey", reshape.finest_resolution(one, two).alias("km"))


@query("s3_regular_grid_axes", "p_partkey:i lat:d lon:d",
       """SELECT p_partkey, 90 - (p_partkey % 584 + 0.5e0) * 180e0 / 584 AS lat, -180 + (p_partkey * 7 % 1388 + 0.5e0) * 360e0 / 1388 AS lon FROM part""")
def s3(t):
    lat, lon = readers.regular_grid_axes(F.col("p_partkey") % 584, F.col("p_partkey") * 7 % 1388, 584, 1388)
    return t.part.select("p_partkey", lat.alias("lat"), lon.alias("lon"))


@query("s4_mesh_axes", "l_orderkey:i l_linenumber:i lat:d lon:d",
       "SELECT l_orderkey, l_linenumber, n.n_nationkey * 2e0 - 10 AS lat, s.s_suppkey * 0.5e0 AS lon FROM lineitem JOIN nation AS n ON n_nationkey = l_partkey % 25 JOIN supplier AS s ON s_suppkey = l_suppkey")
def s4(t):
    values = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 25).alias("lat_idx"), F.col("l_suppkey").alias("lon_idx"))
    lats = t.nation.select(F.col("n_nationkey").cast("bigint").alias("lat_idx"), (F.col("n_nationkey") * 2.0 - 10).alias("lat"))
    lons = t.supplier.select(F.col("s_suppkey").alias("lon_idx"), (F.col("s_suppkey") * 0.5).alias("lon"))
    return readers.mesh_axes(values, lats, lons)


@query("q15_split_antimeridian", "request_id:i w:d e:d",
       """SELECT request_id, r_min_lon AS w, r_max_lon AS e FROM requests WHERE r_min_lon <= r_max_lon
          UNION ALL SELECT request_id, r_min_lon, 180 FROM requests WHERE r_min_lon > r_max_lon
          UNION ALL SELECT request_id, -180, r_max_lon FROM requests WHERE r_min_lon > r_max_lon""", "requests")
def q15(t):
    return t.requests.select("request_id", F.explode(G.lon_ranges("r_min_lon", "r_max_lon")).alias("r")).select("request_id", "r.w", "r.e")
