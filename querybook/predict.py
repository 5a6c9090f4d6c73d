"""Prediction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import query
from querybook.scalar import destination_sql, bearing_sql, segment_sql
from querybook.tables import BASE_US, hav
from swathmatch.operators import predict
from swathmatch.operators.ordered import micros


def edges_sql(lat: str, lon: str, prefix: str = "") -> str:
    """Even-odd rule over the four edges of a ring, unwrapped where it crosses the date line."""
    p = prefix
    wraps = (f"(greatest({p}lon1, {p}lon2, {p}lon3, {p}lon4) - least({p}lon1, {p}lon2, {p}lon3, {p}lon4) > 180)")

    def up(x):
        return f"(CASE WHEN {wraps} AND {x} < 0 THEN {x} + 360 ELSE {x} END)"

    out = []
    for a, b in ((1, 4), (2, 1), (3, 2), (4, 3)):
        la, lb, oa, ob = f"{p}lat{a}", f"{p}lat{b}", up(f"{p}lon{a}"), up(f"{p}lon{b}")
        out.append(f"(CASE WHEN ({la} > {lat}) <> ({lb} > {lat}) AND {up(lon)} < ({ob} - {oa}) * ({lat} - {la}) / nullif({lb} - {la}, 0) + {oa} THEN 1 ELSE 0 END)")
    return f"(({' + '.join(out)}) % 2 = 1)"


@query("j12_point_in_polygon_join", "point_id:i fp_id:i",
       f"SELECT point_id, fp_id FROM globe AS g JOIN footprints AS f ON g.lat BETWEEN f.min_lat AND f.max_lat AND {edges_sql('g.lat', 'g.lon', 'f.')}", "globe footprints")
def j12(t):
    rings = t.footprints.select("fp_id", F.array(*[F.struct(F.col(f"lat{i}").alias("lat"), F.col(f"lon{i}").alias("lon")) for i in range(1, 5)]).alias("polygon"))
    return predict.point_in_polygon_join(t.globe, rings)


@query("j12_rings_below_three_vertices", "point_id:i fp_id:i",
       f"""SELECT point_id, fp_id FROM globe AS g JOIN footprints AS f ON CASE WHEN fp_id % 50 = 0 THEN TRUE
           ELSE g.lat BETWEEN f.min_lat AND f.max_lat AND {edges_sql('g.lat', 'g.lon', 'f.')} END""", "globe footprints")
def j12_vague(t):
    ring = F.array(*[F.struct(F.col(f"lat{i}").alias("lat"), F.col(f"lon{i}").alias("lon")) for i in range(1, 5)])
    size = F.when(F.col("fp_id") % 50 == 0, (F.col("fp_id") / 50 % 3).cast("int")).otherwise(4)
    return predict.point_in_polygon_join(t.globe, t.footprints.select("fp_id", F.slice(ring, F.lit(1), size).alias("polygon")))


@query("j13_bbox_overlap_join", "fp_id:i item_id:i",
       """SELECT fp_id, item_id FROM footprints JOIN catalog ON max_lon >= r_min_lon AND min_lon <= r_max_lon AND max_lat >= r_min_lat AND min_lat <= r_max_lat""",
       "footprints catalog")
def j13(t):
    return predict.box_overlap_join(t.footprints, t.catalog)


FOOTPRINT_HIT = f"""hit AS (SELECT point_id, fp_id FROM globe AS g JOIN footprints AS f ON kind = 'polygon' AND has_ring AND g.lat BETWEEN min_lat AND max_lat AND {edges_sql('g.lat', 'g.lon', 'f.')}
    UNION ALL SELECT point_id, fp_id FROM globe AS g JOIN footprints AS f ON kind = 'wv_points' AND g.lat BETWEEN min_lat - 1 AND max_lat + 1 AND (
        {' OR '.join(f"{hav(f'f.lon{i}', f'f.lat{i}', 'g.lon', 'g.lat')} <= 60e0" for i in range(1, 5))})
    UNION ALL SELECT point_id, fp_id FROM globe AS g JOIN footprints AS f ON kind <> 'wv_points' AND NOT has_ring AND g.lat BETWEEN min_lat AND max_lat AND g.lon BETWEEN min_lon AND max_lon)"""


@query("j14_point_in_footprint_join", "point_id:i fp_id:i", f"WITH {FOOTPRINT_HIT}\n--select\nSELECT * FROM hit", "globe footprints")
def j14(t):
    return predict.point_in_footprint_join(t.globe, t.ringed(), 60.0)


@query("j15_interval_overlap_join", "fp_id:i item_id:i",
       """SELECT fp_id, item_id FROM footprints JOIN catalog ON sensing_start <= r_end AND r_start <= sensing_end AND c_nationkey = item_id % 25""", "footprints catalog")
def j15(t):
    left = t.footprints.select("fp_id", F.col("c_nationkey").cast("bigint").alias("k"), F.col("sensing_start").alias("start"), F.col("sensing_end").alias("end"))
    right = t.catalog.select("item_id", (F.col("item_id") % 25).alias("k"), "r_start", "r_end")
    return predict.interval_overlap_join(left, right, by=["k"])


@query("j15_open_windows", "fp_id:i item_id:i",
       """WITH c AS (SELECT item_id, CASE WHEN item_id % 101 <> 0 THEN r_start END AS r_start, CASE WHEN item_id % 103 <> 0 THEN r_end END AS r_end FROM catalog)
--select
SELECT fp_id, item_id FROM footprints JOIN c ON c_nationkey = item_id % 25 AND coalesce(sensing_start <= r_end, TRUE) AND coalesce(r_start <= sensing_end, TRUE)
WHERE NOT coalesce(r_end < r_start, FALSE)""", "footprints catalog")
def j15_open(t):
    left = t.footprints.select("fp_id", F.col("c_nationkey").cast("bigint").alias("k"), F.col("sensing_start").alias("start"), F.col("sensing_end").alias("end"))
    right = t.catalog.select("item_id", (F.col("item_id") % 25).alias("k"), F.when(F.col("item_id") % 101 != 0, F.col("r_start")).alias("r_start"),
                             F.when(F.col("item_id") % 103 != 0, F.col("r_end")).alias("r_end"))
    return predict.interval_overlap_join(left, right, by=["k"])


@query("j16_index_match", "file_id:i request_id:i",
       """SELECT file_id, request_id FROM platform_index JOIN requests ON time_start <= r_end AND r_start <= time_end AND lat_max >= r_min_lat AND lat_min <= r_max_lat
          AND (lon_max - lon_min > 180 OR CASE WHEN r_min_lon <= r_max_lon THEN lon_max >= r_min_lon AND lon_min <= r_max_lon
               ELSE lon_max >= r_min_lon OR lon_min <= r_max_lon END)
          AND list_has_any(string_split(params, ' '), ['WSPD', 'VAVH'])""", "platform_index requests")
def j16(t):
    index = t.platform_index.withColumn("parameters", F.split("params", " "))
    return predict.index_match(index, t.requests.withColumn("wanted", F.array(F.lit("WSPD"), F.lit("VAVH"))))


# --- ground tracks ---------------------------------------------------------------------------

_MARGIN = 1500.0


def _shapes(t):
    targets = t.targets
    ring = F.array(*[F.struct(la.alias("lat"), lo.alias("lon")) for la, lo in (
        (F.col("lat0") + 5, F.col("lon0")), (F.col("lat0"), F.col("lon0") + 6), (F.col("lat0") - 5, F.col("lon0")), (F.col("lat0"), F.col("lon0") - 6))])
    return targets.withColumn("polygon", ring)


def _swaths(t):
    return t.events.select(F.col("event_type").alias("satellite")).distinct().withColumn("swath_half_width_km", F.length("satellite") * 10.0)


def _inside(lat: str, lon: str) -> str:
    box = f"({lon} BETWEEN tmin_lon AND tmax_lon AND {lat} BETWEEN tmin_lat AND tmax_lat)"
    ring = edges_sql(lat, lon, "q")
    return f"CASE WHEN shape = 'polygon' THEN {box} AND {ring} ELSE {box} END"


def _swept(side: str) -> str:
    return destination_sql("n.lat", "n.lon", f"(heading + {side})", "(off * i / steps)")


DIAMOND = ("lat0 + 5 AS qlat1, lon0 AS qlon1, lat0 AS qlat2, lon0 + 6 AS qlon2, lat0 - 5 AS qlat3, lon0 AS qlon3, lat0 AS qlat4, lon0 - 6 AS qlon4")


def track_sql(ring: str = DIAMOND) -> str:
    (pla, plo), (mla, mlo) = _swept("90"), _swept("-90")
    return f"""WITH nb AS (SELECT *, lead(lat) OVER w AS nla, lead(lon) OVER w AS nlo, lag(lat) OVER w AS pla, lag(lon) OVER w AS plo, lead(t) OVER w AS nt, lag(t) OVER w AS pt
         FROM samples WINDOW w AS (PARTITION BY satellite ORDER BY t)),
    n AS (SELECT *, coalesce({bearing_sql('lat', 'lon', 'nla', 'nlo')}, {bearing_sql('pla', 'plo', 'lat', 'lon')}) AS heading FROM nb),
    tg AS (SELECT target_id, satellite, shape, "start" AS ts, "end" AS te, lat0, lon0, min_lon AS tmin_lon, max_lon AS tmax_lon, min_lat AS tmin_lat, max_lat AS tmax_lat,
                  {ring} FROM targets),
    known AS (SELECT tg.*, length(satellite) * 10e0 + {_MARGIN}e0 AS off FROM tg WHERE satellite IN (SELECT satellite FROM samples)),
    j AS (SELECT k.*, n.t, n.pt, n.lat, n.lon, n.nla, n.nlo, n.pla, n.plo, n.heading, greatest(1, ceil(k.off / 50e0)) AS steps
          FROM known AS k JOIN n ON n.satellite = k.satellite AND n.t BETWEEN k.ts AND k.te),
    sweep AS (SELECT j.*, unnest(range(0, CAST(steps AS BIGINT) + 1)) AS i FROM j WHERE shape <> 'point'),
    sw AS (SELECT target_id, t, i, {pla.replace('n.lat', 'lat').replace('n.lon', 'lon')} AS la, {plo.replace('n.lat', 'lat').replace('n.lon', 'lon')} AS lo,
                  {mla.replace('n.lat', 'lat').replace('n.lon', 'lon')} AS lb, {mlo.replace('n.lat', 'lat').replace('n.lon', 'lon')} AS lob,
                  lat, lon, shape, tmin_lon, tmax_lon, tmin_lat, tmax_lat, qlat1, qlat2, qlat3, qlat4, qlon1, qlon2, qlon3, qlon4 FROM sweep),
    area AS (SELECT DISTINCT target_id, t FROM sw WHERE (i = 0 AND {_inside('lat', 'lon')}) OR (i > 0 AND ({_inside('la', 'lo')} OR {_inside('lb', 'lob')}))),
    dots AS (SELECT DISTINCT target_id, t FROM j WHERE shape = 'point' AND ({hav('lon', 'lat', 'lon0', 'lat0')} <= off
             OR coalesce({segment_sql('lat0', 'lon0', 'lat', 'lon', 'nla', 'nlo')} <= off, FALSE)
             OR coalesce({segment_sql('lat0', 'lon0', 'pla', 'plo', 'lat', 'lon')} <= off, FALSE))),
    seen AS (SELECT j.target_id, j.t, j.pt, j.ts, j.te FROM j JOIN (SELECT * FROM area UNION ALL SELECT * FROM dots) AS m ON m.target_id = j.target_id AND m.t = j.t),
    runs AS (SELECT *, sum(fresh) OVER (PARTITION BY target_id ORDER BY t) AS run FROM (SELECT *, CASE WHEN lag(t) OVER (PARTITION BY target_id ORDER BY t) = pt THEN 0 ELSE 1 END AS fresh FROM seen)),
    wins AS (SELECT target_id, greatest(min(ts), min(t) - INTERVAL 15 SECOND) AS a, least(max(te), max(t) + INTERVAL 15 SECOND) AS b FROM runs GROUP BY target_id, run),
    cnt AS (SELECT k.target_id, k.ts, k.te, (SELECT count(*) FROM nb WHERE nb.satellite = k.satellite AND coalesce(nb.nt, nb.t) >= k.ts AND coalesce(nb.pt, nb.t) <= k.te) AS c FROM known AS k),
    track AS (SELECT target_id, epoch_us(a) AS from_us, epoch_us(b) AS to_us FROM wins
              UNION ALL SELECT target_id, epoch_us(ts), epoch_us(te) FROM tg WHERE satellite NOT IN (SELECT satellite FROM samples)
              UNION ALL SELECT target_id, epoch_us(ts), epoch_us(te) FROM cnt WHERE c < 2)"""


@query("j17_track_match", "target_id:i from_us:i to_us:i", track_sql() + "\n--select\nSELECT * FROM track", "samples targets")
def j17(t):
    return predict.track_match(t.samples, _shapes(t), _swaths(t), _MARGIN)


@query("j23_track_prefilter", "file_name:i", track_sql() + """
--select
SELECT DISTINCT target_id AS file_name FROM track WHERE target_id % 7 <> 0 UNION ALL SELECT target_id FROM tg WHERE target_id % 7 = 0""", "samples targets")
def j23(t):
    shapes = _shapes(t).withColumn("satellite", F.when(F.col("target_id") % 7 != 0, F.col("satellite")))
    files = shapes.select(F.col("target_id").alias("file_name"))
    return predict.track_prefilter(files, shapes, t.samples, _swaths(t), _MARGIN)


@query("j18_station_window_match", "station_id:i fp_id:i", f"""WITH {FOOTPRINT_HIT},
    st AS (SELECT point_id, time AS a, time + INTERVAL 6 DAY AS b FROM globe)
--select
SELECT point_id AS station_id, fp_id FROM st JOIN (SELECT * FROM hit WHERE point_id % 50 <> 0) AS h USING (point_id) JOIN footprints USING (fp_id)
WHERE a <= sensing_end + INTERVAL 60 MINUTE AND sensing_start - INTERVAL 60 MINUTE <= b
UNION ALL SELECT point_id, fp_id FROM st JOIN footprints ON a <= sensing_end + INTERVAL 60 MINUTE AND sensing_start - INTERVAL 60 MINUTE <= b WHERE point_id % 50 = 0""",
       "globe footprints")
def j18(t):
    placed = F.col("point_id") % 50 != 0
    when = F.col("time").cast("timestamp")
    stations = t.globe.select(F.col("point_id").alias("station_id"), F.when(placed, F.col("lon")).alias("lon"), F.when(placed, F.col("lat")).alias("lat"),
                              when.alias("start"), (when + F.expr("interval 6 days")).alias("end"))
    return predict.station_window_match(stations, t.ringed(), 60, 60.0)


@query("j19_semi_exists", "o_orderkey:i", "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40)")
def j19(t):
    return predict.semi_exists(t.orders, t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("j21_granule_day_exists", "window_id:i source:s",
       """WITH g AS (SELECT DISTINCT o_orderpriority AS source, CAST(o_orderdate AS DATE) AS day FROM orders),
          w AS (SELECT l_orderkey * 10 + l_linenumber AS window_id, CASE l_returnflag WHEN 'A' THEN '5-LOW' ELSE '1-URGENT' END AS source, l_shipdate AS s FROM lineitem)
--select
SELECT DISTINCT window_id, w.source FROM w JOIN g ON g.source = w.source AND g.day BETWEEN CAST(s - INTERVAL 90 MINUTE AS DATE) AND CAST(s + INTERVAL 90 MINUTE AS DATE)""")
def j21(t):
    g = t.orders.select(F.col("o_orderpriority").alias("source"), F.to_date("o_orderdate").alias("day"))
    s = F.col("l_shipdate").cast("timestamp")
    w = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("window_id"),
                          F.when(F.col("l_returnflag") == "A", "5-LOW").otherwise("1-URGENT").alias("source"), s.alias("start"), s.alias("end"))
    return predict.granule_day_exists(w, g, 90)


CATALOG_HIT = f"""pads AS (SELECT fp_id, sensing_start - INTERVAL 720 MINUTE AS s, sensing_end + INTERVAL 720 MINUTE AS e, min_lon AS w1, max_lon AS e1, min_lat AS s1, max_lat AS n1
         FROM footprints WHERE kind <> 'wv_points'
         {' '.join(f"UNION ALL SELECT fp_id, sensing_start - INTERVAL 720 MINUTE, sensing_end + INTERVAL 720 MINUTE, lon{i}, lon{i}, lat{i}, lat{i} FROM footprints WHERE kind = 'wv_points'" for i in range(1, 5))}),
    hit AS (SELECT fp_id, item_id, collection FROM pads JOIN catalog ON e1 >= r_min_lon AND w1 <= r_max_lon AND n1 >= r_min_lat AND s1 <= r_max_lat AND s <= r_end AND r_start <= e)"""


@query("j22_catalog_window_match", "fp_id:i item_id:i", f"WITH {CATALOG_HIT}\n--select\nSELECT fp_id, item_id FROM hit", "footprints catalog")
def j22(t):
    return predict.catalog_window_match(t.ringed(), t.catalog, 720)


# --- islands, clusters, footprints, verdicts -----------------------------------------------------

@query("a17_cluster_scene_times", "platform_type:s from_us:i to_us:i n_times:i",
       """WITH d AS (SELECT DISTINCT platform_type, epoch_us(time) AS u FROM obs),
          f AS (SELECT *, CASE WHEN u - lag(u) OVER (PARTITION BY platform_type ORDER BY u) <= 3600000000 THEN 0 ELSE 1 END AS fresh FROM d),
          c AS (SELECT *, sum(fresh) OVER (PARTITION BY platform_type ORDER BY u) AS k FROM f),
          w AS (SELECT platform_type, k, greatest(epoch_us(TIMESTAMP '2024-01-03') - 1800000000, min(u) - 1800000000) AS from_us,
                       least(epoch_us(TIMESTAMP '2024-01-28') + 1800000000, max(u) + 1800000000) AS to_us, count(*) AS n_times FROM c GROUP BY platform_type, k)
--select
SELECT platform_type, from_us, to_us, n_times FROM w WHERE from_us <= to_us""", "obs")
def a17(t):
    return predict.cluster_times(t.obs, ["platform_type"], 30, "2024-01-03", "2024-01-28")


@query("a18_islands", "user_id:i lo:i hi:i n:i",
       """WITH o AS (SELECT user_id, epoch_us(ts) AS u, event_id, value > 50 AS m, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
          k AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY u, event_id) AS g FROM o WHERE m)
--select
SELECT user_id, min(u) - 15000000 AS lo, max(u) + 15000000 AS hi, count(*) AS n FROM k GROUP BY user_id, g""")
def a18(t):
    rows = t.events.withColumn("us", micros("ts"))
    return predict.islands(rows, ["user_id"], F.col("value") > 50, "us", "event_id", 15_000_000)


@query("a19_footprint_from_cells", "scene:s min_lon:d max_lon:d min_lat:d max_lat:d sensing_start:t n_cells:i",
       """SELECT scene, min(lon) AS min_lon, max(lon) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat, min(time) AS sensing_start, count(*) AS n_cells
          FROM cells WHERE owiWindSpeed IS NOT NULL GROUP BY scene""", "cells")
def a19(t):
    return predict.footprint_from_cells(t.cells, "owiWindSpeed")


@query("a20_footprint_union_bbox", "kind:s min_lon:d max_lon:d min_lat:d max_lat:d",
       """SELECT kind, min(min_lon) - 14e0 / 111 AS min_lon, max(max_lon) + 14e0 / 111 AS max_lon, min(min_lat) - 14e0 / 111 AS min_lat, max(max_lat) + 14e0 / 111 AS max_lat
          FROM footprints GROUP BY kind""", "footprints")
def a20(t):
    return predict.footprint_union_bbox(t.footprints, by=["kind"])


@query("a20_wrap_aware_bounds", "fp_id:i w:d e:d",
       """WITH v AS (SELECT fp_id, unnest([lon1, lon2, lon3, lon4]) AS lon FROM footprints), a AS (SELECT fp_id, min(lon) AS mn, max(lon) AS mx,
             min(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) AS sn, max(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) AS sx FROM v GROUP BY fp_id)
--select
SELECT fp_id, CASE WHEN mx - mn <= 180 THEN mn WHEN sn > 180 THEN sn - 360 ELSE sn END AS w, CASE WHEN mx - mn <= 180 THEN mx WHEN sx > 180 THEN sx - 360 ELSE sx END AS e FROM a""",
       "footprints")
def a20_wrap(t):
    rows = t.footprints.select("fp_id", F.explode(F.array("lon1", "lon2", "lon3", "lon4")).alias("lon"))
    w, e = predict.wrap_aware_lon_bounds("lon")
    return rows.groupBy("fp_id").agg(w.alias("w"), e.alias("e"))


@query("a21_centroids", "fp_id:i c_lon:d c_lat:d",
       """SELECT fp_id, (lon1 + lon2 + lon3 + lon4) / 4 AS c_lon, (lat1 + lat2 + lat3 + lat4) / 4 AS c_lat FROM footprints
          WHERE (lon1 + lon2 + lon3 + lon4) / 4 BETWEEN -60 AND 60 AND (lat1 + lat2 + lat3 + lat4) / 4 BETWEEN -30 AND 45""", "footprints")
def a21(t):
    v = [F.struct(F.col(f"lon{i}").alias("lon"), F.col(f"lat{i}").alias("lat")) for i in (1, 2, 3, 4, 1)]
    return predict.centroids(t.footprints.select("fp_id", F.array(*v).alias("ring")), (-60, 60, -30, 45))


_VERDICT = f"""WITH {CATALOG_HIT},
    src AS (SELECT DISTINCT o_orderpriority AS source_type FROM orders UNION ALL SELECT 'r' || r_regionkey FROM region),
    per AS (SELECT collection AS source_type, count(DISTINCT fp_id) AS nf, count(*) AS nw FROM hit GROUP BY collection),
    v AS (SELECT source_type, CASE WHEN source_type = 'r0' THEN 'unknown' WHEN coalesce(nw, 0) > 0 THEN 'collocated' ELSE 'none-predicted' END AS verdict,
                 coalesce(nf, 0) AS n_footprints, coalesce(nw, 0) AS n_windows FROM src LEFT JOIN per USING (source_type))"""


def _verdicts(t):
    hits = predict.catalog_window_counts(t.ringed(), t.catalog, 720, "collection").withColumnRenamed("collection", "source_type")
    sources = t.orders.select(F.col("o_orderpriority").alias("source_type")).distinct().unionByName(
        t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("source_type")))
    sources = sources.withColumns({"bucket": F.lit("catalog-precise"), "listing_failed": F.col("source_type") == "r0"})
    return predict.verdict(sources, hits, t.footprints.agg(F.count("*").alias("n")))


@query("a22_verdict", "source_type:s verdict:s n_footprints:i n_windows:i", _VERDICT + "\n--select\nSELECT * FROM v", "footprints catalog")
def a22(t):
    return _verdicts(t)


@query("a22_combined_verdict", "source_type:s verdict:s n_windows:i", _VERDICT + """
--select
SELECT CASE WHEN source_type LIKE 'r%' THEN 'region' ELSE 'order' END AS source_type,
       CASE WHEN bool_or(verdict = 'collocated') THEN 'collocated' WHEN bool_or(verdict = 'unknown') THEN 'unknown' ELSE 'none-predicted' END AS verdict, sum(n_windows) AS n_windows
FROM v GROUP BY 1""", "footprints catalog")
def a22_combined(t):
    merged = _verdicts(t).withColumn("source_type", F.when(F.col("source_type").startswith("r"), "region").otherwise("order"))
    return predict.combined_verdict(merged)


@query("a22_model_coverage", "source_type:i verdict:s n_footprints:i",
       f"""WITH c AS (SELECT n_nationkey AS source_type, CASE WHEN n_nationkey % 3 <> 0 THEN TIMESTAMP '2023-12-01' + n_nationkey * INTERVAL 3 DAY END AS a,
            CASE WHEN n_nationkey % 4 <> 0 THEN TIMESTAMP '2023-12-20' + n_nationkey * INTERVAL 2 DAY END AS b FROM nation)
--select
SELECT source_type, CASE WHEN count(fp_id) > 0 THEN 'collocated' ELSE 'none-predicted' END AS verdict, count(fp_id) AS n_footprints
FROM c LEFT JOIN footprints ON (a IS NULL OR sensing_end >= a) AND (b IS NULL OR sensing_start <= b) GROUP BY source_type""", "footprints")
def a22_model(t):
    n = F.col("n_nationkey")
    day = 86_400_000_000
    cov = t.nation.select(n.alias("source_type"), F.when(n % 3 != 0, F.timestamp_micros(F.lit(BASE_US - 31 * day) + n * F.lit(3 * day))).alias("coverage_start"),
                          F.when(n % 4 != 0, F.timestamp_micros(F.lit(BASE_US - 12 * day) + n * F.lit(2 * day))).alias("coverage_end"))
    return predict.model_coverage(t.footprints, cov)


@query("a23_skip_gate", "source_type:s verdict:s", _VERDICT + "\n--select\nSELECT source_type, verdict FROM v WHERE verdict <> 'none-predicted'", "footprints catalog")
def a23(t):
    return predict.skip_gate(_verdicts(t))


@query("a24_resolve_tolerance", "event_id:i minutes:d",
       """SELECT event_id, CASE event_type WHEN 'click' THEN 720 WHEN 'view' THEN 45 WHEN 'error' THEN 30 WHEN 'signup' THEN 360 ELSE 720 END AS minutes FROM events""")
def a24(t):
    from swathmatch.plans.recipe import Recipe, Source

    r = Recipe("r", "wind", sources=(Source("altimeter_1hz", collocation_kwargs={"time_tolerance_minutes": 45}),))
    names = {"click": ("ascat_ssm",), "view": ("altimeter_1hz",), "error": ("mooring",), "signup": ("hycom", "scatterometer"), "purchase": ("ascat_ssm", "era5")}
    table = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return r.with_tolerance(t.events.select("event_id", F.try_element_at(table, F.col("event_type")).alias("sources")))


@query("a25_day_footprint", "record_id:i sensing_start:t sensing_end:t n_windows:i",
       """SELECT c_nationkey * 100 + date_part('day', sensing_start) AS record_id, min(sensing_start) AS sensing_start, max(sensing_end) AS sensing_end, count(*) AS n_windows
          FROM footprints GROUP BY 1""", "footprints")
def a25(t):
    rows = t.footprints.select((F.col("c_nationkey") * 100 + F.dayofmonth("sensing_start")).alias("record_id"), F.col("sensing_start").alias("start"), F.col("sensing_end").alias("end"))
    return predict.day_footprint(rows)
