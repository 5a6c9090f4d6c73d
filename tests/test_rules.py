"""Statistics, quantiles, prediction, cleaning, recipes and sinks on small cases."""

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swathmatch.functions import decode as D
from swathmatch.functions import geo as G
from swathmatch.operators import clean, predict, report, reshape, stats
from swathmatch.operators.quantiles import exact_quantiles
from swathmatch.plans.recipe import Recipe, Source, is_layer, layer_type_of, safe_model_tolerance
from swathmatch.plans.validate import Scenes, SourceTable, validate
from swathmatch.sources import readers, sinks


def pairs(spark, n=40, seed=42):
    rnd = random.Random(seed)
    rows = [("mooring" if i < n // 2 else "buoy", 8 + rnd.gauss(0, 2), 8 + rnd.gauss(0, 2)) for i in range(n)]
    return spark.createDataFrame(rows, "val_source string, sar_owiWindSpeed double, val_WSPD double"), rows


def test_moorings_and_buoys_are_one_family(spark):
    df, rows = pairs(spark)
    m = stats.metrics(df, "owiWindSpeed", "WSPD").collect()
    assert len(m) == 1 and m[0].source == "buoy_family" and m[0].N == 40
    s, v = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    assert m[0].bias == pytest.approx((s - v).mean()) and m[0].std == pytest.approx((s - v).std(ddof=1))
    assert m[0].correlation == pytest.approx(np.corrcoef(s, v)[0, 1])


def test_small_groups_have_no_correlation(spark):
    df, _ = pairs(spark, 9)
    m = stats.linear_metrics(df, "sar_owiWindSpeed", "val_WSPD").first()
    assert m.N == 9 and m.correlation is None and m.rmse is not None
    one = stats.linear_metrics(df.limit(1), "sar_owiWindSpeed", "val_WSPD").first()
    assert one.std is None
    flat = stats.linear_metrics(spark.range(20).select(F.lit("x").alias("val_source"), F.lit(1.0).alias("s"), F.lit(0.0).alias("v")), "s", "v").first()
    assert flat.correlation is None and flat.scatter_index is None


def test_circular_differences_and_metrics(spark):
    df = spark.createDataFrame([(359.0, 1.0), (0.0, 180.0), (180.0, 0.0), (10.0, 10.0)], "a double, b double")
    assert [r.d for r in df.select(G.circular_diff_deg("a", "b").alias("d")).collect()] == [-2.0, -180.0, -180.0, 0.0]
    rnd = random.Random(2)
    rows = [("s", (350 + rnd.gauss(0, 20)) % 360, (352 + rnd.gauss(0, 25)) % 360) for _ in range(50)]
    m = stats.circular_metrics(spark.createDataFrame(rows, "val_source string, a double, b double"), "a", "b").first()
    a, b = np.radians([r[1] for r in rows]), np.radians([r[2] for r in rows])
    d = (np.degrees(a - b) + 180) % 360 - 180
    a0, b0 = (np.arctan2(np.sin(x).mean(), np.cos(x).mean()) for x in (a, b))
    sa, sb = np.sin(a - a0), np.sin(b - b0)
    assert m.correlation == pytest.approx((sa * sb).sum() / np.sqrt((sa**2).sum() * (sb**2).sum()), abs=1e-9)
    assert m.rmse == pytest.approx(np.sqrt((d**2).mean()))
    same = stats.circular_metrics(spark.range(20).select(F.lit("x").alias("val_source"), F.lit(90.0).alias("a"), F.lit(80.0).alias("b")), "a", "b").first()
    assert same.correlation is None and same.bias == pytest.approx(10.0)


@pytest.mark.parametrize("bins", [1, 3, 4096])
def test_quantiles_are_exact(spark, bins):
    rnd = random.Random(bins)
    rows = [("a", rnd.paretovariate(0.5)) for _ in range(301)] + [("b", 7.0)] * 40 + [("c", float(i % 3)) for i in range(50)] + [("d", 1.0), ("d", None)]
    probs = [0.0, 0.02, 0.25, 0.5, 0.98, 1.0]
    got = {r.k: r for r in exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", probs, bins).collect()}
    for k in "abcd":
        vals = [v for q, v in rows if q == k and v is not None]
        assert got[k].n == len(vals) and got[k].q == pytest.approx(list(np.quantile(vals, probs)))
    every = exact_quantiles(spark.createDataFrame(rows, "k string, v double"), [], "v", [0.5]).first()
    assert every.q[0] == pytest.approx(np.quantile([v for _, v in rows if v is not None], 0.5))


def test_cdf_map_is_monotone_and_degenerate_groups_have_none(spark):
    rows = [("g", float(i), math.sqrt(i)) for i in range(200)] + [("flat", 5.0, float(i)) for i in range(30)] + [("one", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "val_source string, s double, v double")
    knots = stats.cdf_fit(df, "s", "v", ["val_source"])
    assert [r.val_source for r in knots.collect()] == ["g"]
    out = [(r.s, r.m) for r in stats.with_knots(df.filter("val_source = 'g'"), knots, ["val_source"]).select(
        "s", stats.cdf_apply(F.col("s"), F.col("knots")).alias("m")).orderBy("s").collect()]
    assert all(a[1] <= b[1] for a, b in zip(out, out[1:])) and out[0][1] == pytest.approx(0.0) and out[-1][1] == pytest.approx(math.sqrt(199))


def test_harmonising_without_a_reference_drops_the_source(spark):
    rows = [("ascat_ssm", float(i), float(i)) for i in range(40)] + [("smap_ssm", float(i), i / 100) for i in range(40)]
    df = spark.createDataFrame(rows, "val_source string, sar_sarSSM double, val_SOIL_MOISTURE double")
    out = stats.rescaled_pairs(df, "sar_sarSSM", "val_SOIL_MOISTURE", "%").collect()
    assert all(r.sar_sarSSM is None and r.val_SOIL_MOISTURE is None and r.harmonized is False for r in out if r.val_source == "ascat_ssm")
    assert all(r.sar_sarSSM is not None for r in out if r.val_source == "smap_ssm")
    by_two = stats.rescaled_pairs(df.withColumn("k", F.lit("a")), "sar_sarSSM", "val_SOIL_MOISTURE", "%", ["val_source", "k"])
    assert sorted(map(str, by_two.select("sar_sarSSM").collect())) == sorted(str(r) for r in spark.createDataFrame([(x.sar_sarSSM,) for x in out], "sar_sarSSM double").collect())


def test_polygons_across_the_date_line(spark):
    ring = [(10.0, 175.0), (10.0, -175.0), (-10.0, -175.0), (-10.0, 175.0)]
    shapes = spark.createDataFrame([(1, [{"lat": a, "lon": o} for a, o in ring])], "fp_id int, polygon array<struct<lat double, lon double>>")
    pts = spark.createDataFrame([(1, 179.0, 0.0), (2, -179.0, 5.0), (3, 170.0, 0.0), (4, 0.0, 0.0)], "point_id int, lon double, lat double")
    assert sorted(r.point_id for r in predict.point_in_polygon_join(pts, shapes).collect()) == [1, 2]
    two = pts.select(G.point_in_polygon("lat", "lon", F.array(F.struct(F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon")))).alias("p"))
    assert all(r.p for r in two.collect())


def test_windows_and_splits(spark):
    assert G.split_antimeridian(135, -120) == [(135, 180.0), (-180.0, -120)]
    t0 = dt.datetime(2026, 1, 1)
    times = spark.createDataFrame([("r", t0 + dt.timedelta(minutes=m)) for m in (0, 60, 121, 122)], "k string, time timestamp")
    w = predict.cluster_times(times, ["k"], 30, "2026-01-01", "2026-01-02").orderBy("from_us").collect()
    assert [r.n_times for r in w] == [2, 2]  # a gap of exactly twice the padding stays together
    rows = spark.createDataFrame([("s", i, i in (1, 2, 5)) for i in range(8)], "k string, u long, m boolean")
    got = sorted((r.lo, r.hi) for r in predict.islands(rows, ["k"], F.col("m"), "u", "u", 1, 3).collect())
    assert got == [(0, 3), (4, 6)]


def test_cleaning_rules(spark):
    df = spark.createDataFrame([(1.0, 1, 2.0, None), (1.0, 3, None, 4), (None, 1, 2.0, 4), (1.0, None, 2.0, 9)], "VHM0 double, VHM0_QC int, VAVH double, VAVH_QC int")
    out = clean.qc_whitelist(df, ["VHM0"]).collect()
    assert [r.VHM0 for r in out] == [1.0, None, None, None] and [r.VHM0_QC for r in out] == [1, None, 1, None]
    assert [r.VAVH for r in clean.precedence_null_out(df).collect()] == [None, None, 2.0, None]
    assert D.reject_bits([1, 2, 4], "a some_portion_of_wvc_is_over_land distance_to_gmf_too_large") == 6
    assert D.paired_labels([0, 1], "only_one") is None and D.paired_labels([0, 2], "a b") == {0: "a", 2: "b"}
    with pytest.raises(ValueError, match="required column"):
        readers.canonical_obs(df)


def test_choosing_pairs_and_waves(spark):
    df = spark.createDataFrame([(1.0, None, 3.0)], "sar_oswHs double, sar_owiSignificantWaveHeight double, val_VAVH double")
    assert reshape.select_pairs(df, "waves") == [("oswHs", "SWH")]
    assert reshape.select_pairs(df.withColumn("sar_owiSignificantWaveHeight", F.lit(2.0)), "waves")[1][0] == "owiSignificantWaveHeight"
    with pytest.raises(KeyError):
        reshape.select_pairs(df, "ice")


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0)] * 5, "val_source string, s double, v double")
    r = report.residual_histogram(df, "s", "v").collect()
    assert len(r) == 1 and r[0].bin == 15 and r[0].density == pytest.approx(30.0)


# --- recipes -------------------------------------------------------------------------------------

def test_precedence_differs_by_path():
    own = {"time_tolerance_minutes": 10, "aggregation_window_km": 1.0}
    r = Recipe("r", "wind", sources=(Source("scatterometer_ascat", collocation_kwargs=own), Source("era5", collocation_kwargs=own), Source("buoy_waterfall", collocation_kwargs=own)))
    layer = r.layer_spec("scatterometer_ascat", "scatterometer")
    assert (layer.time_tolerance_minutes, layer.aggregation_window_km) == (180, 12.5)
    model, _, temporal = r.model_spec("era5", "era5_wind", "cell-averaging")
    assert (model.time_tolerance_minutes, model.aggregation_window_km, temporal) == (10, 1.0, "hyperbolic")
    assert r.point_spec("buoy_gts").time_tolerance_minutes == 10
    assert r.tolerance_minutes("era5", "ascat_ssm") == 720 and r.tolerance_minutes("era5") == 10 and r.tolerance_minutes() == 30
    assert safe_model_tolerance("hycom") == 360 and safe_model_tolerance("scatterometer") is None


def test_node_resolution_and_layer_types():
    r = Recipe("r", "currents")
    assert r.layer_spec("hf_radar_us", "hf_radar_grid", {"hfr_resolution_km": 2.0}).aggregation_window_km == 2.0
    named = Recipe("r", "currents", layers={"hf_radar_grid": {"aggregation_window_km": 9.0}})
    assert named.layer_spec("hf_radar_us", "hf_radar_grid", {"hfr_resolution_km": 2.0}).aggregation_window_km == 9.0
    specs = r.layer_specs()
    assert len(specs) == 26
    assert layer_type_of({"data_type": "altimeter", "frequency": "5Hz"}, specs) == "altimeter_5hz"
    assert layer_type_of({"data_type": "radiometer", "sensor": "AMSR2"}, specs) == "radiometer_amsr2"
    assert layer_type_of({"data_type": "radiometer_ssm", "sensor": "smap"}, specs) == "smap_ssm"
    assert layer_type_of({"data_type": "scatterometer", "source_node": "scatterometer_hy2b/f1"}, specs) == "scatterometer_hy2b"
    assert layer_type_of({"source_node": "osi_saf_winds/x"}, specs) == "scatterometer"
    assert is_layer({"source_node": "hfr_noaa/a"}) and not is_layer({"data_type": "", "source_node": "buoy"})


@pytest.mark.parametrize("variable, source, kinds", [
    ("currents", "sentinel1_l2_ocn", ["era5"]), ("wind", "sentinel1_l2_ocn", ["hycom"]), ("wind", "sentinel1_l2_ocn", ["mooring"]),
    ("waves", "sentinel1_l2_ocn", ["ship_gts"]), ("wind", "sentinel1_l2_ocn", ["buoy_gts", "buoy_cmems_family"]),
    ("wind", "sentinel1_l2_ocn", ["ship_gts", "ship_cmems_family"]), ("waves", "radarsat2", []), ("wind", "nowhere", []),
])
def test_refused_recipes(variable, source, kinds):
    with pytest.raises(ValueError):
        Recipe.from_dict({"name": "r", "variable": variable, "sar_data": {"source": source}, "validation_sources": [{"source_type": k} for k in kinds]})


def test_recipe_file(tmp_path):
    f = tmp_path / "r.json"
    f.write_text(json.dumps({"name": "r", "variable": "wind", "geographic_bounds": {"min_lon": 1}, "validation_sources": [{"source_type": "era5"}],
                             "collocation": {"point_vs_layer": {"aggregation_window_km": 3}, "sar_footprint_radius_km": 9}}))
    r = Recipe.from_file(f)
    assert r.bounds.min_lon == 1 and r.footprint_radius_km == 9 and r.point_spec("x").aggregation_window_km == 3


# --- end to end and sinks ----------------------------------------------------------------------------

def test_validate_end_to_end(spark, tmp_path):
    noon = dt.datetime(2026, 1, 1, 12)
    cells = spark.createDataFrame([("S", y, x, 0.1 * x, 50 + 0.1 * y, noon, 5.0 + y) for y in range(8) for x in range(8)],
                                  "scene string, y int, x int, lon double, lat double, time timestamp, owiWindSpeed double")
    obs = spark.createDataFrame([(i, f"p{i}", "mooring", noon, 0.05 * i, 50.0 + 0.05 * i, 6.0 + i) for i in range(12)],
                                "obs_id long, platform_id string, platform_type string, time timestamp, lon double, lat double, WSPD double")
    model = spark.createDataFrame([("era5_wind", noon + dt.timedelta(hours=h), i, j, 49.9 + 0.3 * i, -0.1 + 0.3 * j, 3.0, 4.0)
                                   for h in (-1, 0, 1) for i in range(4) for j in range(4)],
                                  "source string, time timestamp, lat_idx int, lon_idx int, lat double, lon double, u10 double, v10 double")
    sources = [SourceTable({"source_node": "insitu"}, obs, ["WSPD"], "buoy_cmems_family"),
               SourceTable({"source_node": "scat", "data_type": "scatterometer", "platform_type": "scatterometer"},
                           obs.withColumn("platform_type", F.lit(None).cast("string")), ["WSPD"], "scatterometer_ascat"),
               SourceTable({"source_node": "era5/era5", "data_type": "era5_wind", "platform_type": "era5_wind"}, model, ["u10", "v10"], "era5")]
    for method in ("cell-averaging", "individual"):
        out = validate(Recipe("r", "wind"), Scenes(cells, ["owiWindSpeed"]), sources, method, cut_lineage=method == "individual")
        m = {r.source: r for r in out.statistics["owiWindSpeed_vs_WSPD"].collect()}
        # every other reading sits on a cell; the ones in between are 6.6 km from the
        # next cell, beyond the 5 km of point sources, within the 12.5 km of the layer
        assert set(m) == {"buoy_family", "scatterometer", "era5_wind"} and m["buoy_family"].N == 6
        assert method == "individual" or m["scatterometer"].N == 12
        assert all(r.val_WSPD == pytest.approx(5.0) for r in out.pairs.filter("val_source = 'era5_wind'").collect())
        sinks.sink_pairs(out.pairs, str(tmp_path / "pairs"), method)
    assert sorted(r.method for r in spark.read.parquet(str(tmp_path / "pairs")).select("method").distinct().collect()) == ["cell-averaging", "individual"]
    sinks.sink_statistics(out.statistics["owiWindSpeed_vs_WSPD"], str(tmp_path / "stats"))
    assert spark.read.parquet(str(tmp_path / "stats.parquet")).count() == spark.read.option("header", True).csv(str(tmp_path / "stats.csv")).count() == 3
    sinks.sink_prediction_json(spark.createDataFrame([("a", "collocated")], "source_type string, verdict string"), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).first().verdict == "collocated"


def test_long_csv_keeps_ids_as_text(spark, tmp_path):
    (tmp_path / "o.csv").write_text("platform_id,platform_type,time,longitude,latitude,depth,variable,value,value_qc,institution\n"
                                    "6600021,MO,2026-01-01T00:00:00,1.5,50.0,0.0,WSPD,NaN,1,x\n")
    r = readers.scan_obs_long(spark, str(tmp_path / "o.csv")).first()
    assert r.platform_id == "6600021" and r.value is None and r.lon == 1.5


def test_index_and_station_files_are_read_from_disk(spark, tmp_path):
    index = tmp_path / "index.txt"
    index.write_text("# comment\nMO/a.nc,40,41,-3,-2,2024-01-01T00:00:00Z,2024-02-01T00:00:00Z,inst,WSPD  WDIR\nbad,line\n")
    row = readers.scan_index(spark, str(index)).collect()
    assert [(r.file_name, r.lat_min, r.lon_max, r.parameters) for r in row] == [("MO/a.nc", 40.0, -2.0, ["WSPD", "WDIR"])]
    for station, lines in {"s1": ["head", "2024/01/02 03:00 0.1 U", "2024/01/05 00:00 0.2 G"], "s2": ["head", "no time here"]}.items():
        folder = tmp_path / "stations" / "net" / station
        folder.mkdir(parents=True)
        (folder / "depth1.stm").write_text("\n".join(lines))
    lines = readers.station_files(spark, str(tmp_path / "stations"))
    assert lines.count() == 5
    got = {r.dir_prefix.rstrip("/").split("/")[-1]: r for r in readers.station_date_ranges(lines).collect()}
    assert [str(v)[:10] for v in list(got["s1"].asDict().values())[1:3]] == ["2024-01-02", "2024-01-05"]


def test_epoch_time_is_exact_far_from_its_epoch(spark):
    rows = spark.createDataFrame([(9_000_001 * 86413, 0.25), (-3, -1.5)], "s bigint, d double")
    at = rows.select(F.unix_micros(D.epoch_time("1970-01-01", seconds=F.col("s"))).alias("s"),
                     F.unix_micros(D.epoch_time("1970-01-01", days=F.col("d"))).alias("d")).collect()
    assert [r.s for r in at] == [9_000_001 * 86413 * 1_000_000, -3_000_000]
    assert [r.d for r in at] == [21_600_000_000, -129_600_000_000]


def test_difference_grid_does_not_depend_on_row_order(spark):
    rnd = random.Random(5)
    rows = [("buoy", "layer_vs_layer", 5.0, 4.0, -12 + rnd.randrange(2400) / 200, 48 + rnd.randrange(1600) / 200, 15.5, None) for _ in range(400)]
    schema = ("val_source string, collocation_type string, sar_v double, val_v double, sar_lon double, sar_lat double, "
              "aggregation_window_km double, sar_pixel_spacing_km double")
    seen = set()
    for i in range(12):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, schema).coalesce(1 + i % 3)
        seen.add(tuple(sorted(map(tuple, report.difference_grid(df, "sar_v", "val_v")[0].collect()))))
    assert len(seen) == 1
