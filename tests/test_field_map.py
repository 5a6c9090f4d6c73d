"""The pooled map of a scene field, and predictions over all kinds of listings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from swathmatch.operators import stats
from swathmatch.plans.prediction import Listing, predictions, to_fetch
from swathmatch.sources.readers import read_field_map
from swathmatch.sources.sinks import sink_field_map

PAIRS = "val_source string, sar_sarSSM double, val_SOIL_MOISTURE double"


def percent_and_volumes(n_ismn, n_ascat):
    """Stations in volumes, a scatterometer in percent, the scene in percent."""
    rng, rows = random.Random(7), []
    for _ in range(n_ismn):
        v = rng.uniform(0.05, 0.35)
        rows.append(("ismn", v * 150 + rng.gauss(0, 1), v))
    for _ in range(n_ascat):
        v = rng.uniform(10, 90)
        rows.append(("ascat_ssm", v + rng.gauss(0, 1), v))
    return rows


def mapped(spark, rows, values):
    field_map = stats.fit_field_map(spark.createDataFrame(rows, PAIRS), "sar_sarSSM", "val_SOIL_MOISTURE", "%")
    field = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double")
    return [r.y for r in stats.apply_field_map(field, field_map, "x", "y").orderBy("id").collect()]


def test_percent_becomes_a_volume(spark):
    assert 0 < mapped(spark, percent_and_volumes(15, 15), [50.0])[0] < 1


def test_the_scene_side_stays_raw(spark):
    """Many converted scatterometer pairs must not pull the stations' own range away."""
    low, high = mapped(spark, percent_and_volumes(18, 300), [15.0, 45.0])
    assert 0 < low < high < 0.6


def test_missing_values_and_no_map(spark):
    rows = percent_and_volumes(30, 0) + [("ismn", None, 0.1), ("ismn", 10.0, None), (None, None, None)]
    assert mapped(spark, rows, [None, float("nan"), float("inf"), 20.0])[:3] == [None, None, None]
    assert mapped(spark, [("ismn", 1.0, 0.1)], [1.0]) == [None]
    assert mapped(spark, [], [1.0]) == [None]
    # without stations what is due for converting takes no part
    assert mapped(spark, percent_and_volumes(0, 50), [50.0]) == [None]


def test_written_and_read_back(spark, tmp_path):
    made = stats.fit_field_map(spark.createDataFrame(percent_and_volumes(40, 40), PAIRS), "sar_sarSSM", "val_SOIL_MOISTURE", "%")
    sink_field_map(made, str(tmp_path / "map"))
    again = read_field_map(spark, str(tmp_path / "map"))
    assert again.collect() == made.collect() and again.count() == 1 and again.first().n == 80


T0 = dt.datetime(2024, 1, 10, 12)


def footprints(spark, n=1):
    point = "array<struct<lat:double,lon:double>>"
    rows = [(i, "orbit_swath", None, None, T0, T0 + dt.timedelta(minutes=10), 0.0, 4.0, 50.0, 54.0) for i in range(n)]
    return spark.createDataFrame(rows, f"fp_id long, kind string, polygon {point}, points {point}, sensing_start timestamp, sensing_end timestamp,"
                                       " min_lon double, max_lon double, min_lat double, max_lat double")


def catalogue(spark, hours, lon=1.0):
    t = T0 + dt.timedelta(hours=hours)
    return spark.createDataFrame([(1, t, t, lon, lon + 1, 51.0, 52.0)],
                                 "item_id long, r_start timestamp, r_end timestamp, r_min_lon double, r_max_lon double, r_min_lat double, r_max_lat double")


def test_verdicts(spark):
    spans = spark.createDataFrame([(None, T0 - dt.timedelta(days=1))], "coverage_start timestamp, coverage_end timestamp")
    days = spark.createDataFrame([(dt.date(2024, 1, 10),), (dt.date(2024, 2, 1),)], "day date")
    listings = [
        Listing("hit", "catalog-precise", catalogue(spark, 1), 60), Listing("late", "catalog-precise", catalogue(spark, 2), 60),
        Listing("east", "catalog-precise", catalogue(spark, 0, 30.0), 60), Listing("broken", "catalog-precise", catalogue(spark, 0), 60, failed=True),
        Listing("daily", "global-composite", days, 0), Listing("era5", "model", spans)]
    got = {r.source_type: r for r in predictions(spark, footprints(spark), listings).collect()}
    assert {k: r.verdict for k, r in got.items()} == {"hit": "collocated", "late": "none-predicted", "east": "none-predicted",
                                                      "broken": "unknown", "daily": "collocated", "era5": "none-predicted"}
    assert got["hit"].n_windows == 1 and got["daily"].n_footprints == 1
    assert {r.source_type for r in to_fetch(spark, footprints(spark), listings).collect()} == {"hit", "broken", "daily"}
    # without a footprint nothing can be judged, so everything is fetched
    nothing = to_fetch(spark, footprints(spark).filter(F.lit(False)), listings).collect()
    assert len(nothing) == 6 and {r.verdict for r in nothing} == {"unknown"}


def test_unknown_buckets_and_missing_tracks(spark):
    with pytest.raises(ValueError, match="unknown bucket"):
        predictions(spark, footprints(spark), [Listing("x", "nowhere", catalogue(spark, 0))])
    with pytest.raises(ValueError, match="ground tracks"):
        predictions(spark, footprints(spark), [Listing("x", "orbit-corridor", catalogue(spark, 0))])
