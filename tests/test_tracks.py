"""Ground tracks and targets: the cheap test ahead of the sweep loses nothing, repeated samples change nothing."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from swathmatch.operators import predict

T0 = dt.datetime(2024, 1, 1)
SAMPLES = "satellite string, t timestamp, lat double, lon double"
TARGETS = ("target_id long, satellite string, shape string, start timestamp, end timestamp, lat0 double, lon0 double, "
           "min_lon double, max_lon double, min_lat double, max_lat double, polygon array<struct<lat double, lon double>>")


def _samples(n, copies=1, seconds=40):
    rows = []
    for i in range(n):
        m = i * seconds / 60
        lon = (m * 2.31 + 40 * math.sin(m * 0.0129) + 180) % 360 - 180
        rows += [("a", T0 + dt.timedelta(minutes=m), 86 * math.sin(m * 0.0647), lon)] * copies
    return rows


def _targets(n, seed, shapes=("box", "polygon", "point")):
    rng, out = random.Random(seed), []
    for i in range(n):
        lat, lon, w, h = rng.uniform(-88, 88), rng.uniform(-180, 180), rng.choice((0.0, 2.0, 6.0, 95.0)), rng.choice((0.0, 1.0, 5.0, 30.0))
        box = (lon - w, lon + w, lat - h, lat + h)
        if rng.random() < 0.15:
            box = (178.0, -178.0 + w / 10, *box[2:])
        elif rng.random() < 0.05:
            box = (None, *box[1:])
        ring = [(lat + h, lon), (lat, lon + w), (lat - h, lon), (lat, lon - w)]
        start = T0 + dt.timedelta(minutes=rng.randint(0, 500))
        out.append((i, "a", shapes[i % len(shapes)], start, start + dt.timedelta(hours=3), lat, lon, *box, ring))
    return out


def _all_steps(pairs):
    steps = predict._steps(F.col("offset_km"))
    return pairs.withColumn("_w", F.struct((-steps).alias("least"), steps.alias("most")))


def _windows(spark, samples, targets, half, margin):
    swaths = spark.createDataFrame([("a", half)], "satellite string, swath_half_width_km double")
    got = predict.track_match(spark.createDataFrame(samples, SAMPLES), spark.createDataFrame(targets, TARGETS), swaths, margin)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("margin", [60.0, 1500.0])
def test_the_cheap_test_loses_nothing(spark, monkeypatch, margin):
    samples, targets = _samples(150, seconds=120), _targets(60, 5)
    got = _windows(spark, samples, targets, 20.0, margin)
    monkeypatch.setattr(predict, "_in_strip", _all_steps)
    assert got and got == _windows(spark, samples, targets, 20.0, margin)


def test_repeated_samples_change_no_window(spark):
    targets = _targets(90, 6, ("point",))
    once = _windows(spark, _samples(200, seconds=90), targets, 20.0, 900.0)
    assert len(once) > 20 and _windows(spark, _samples(200, copies=4, seconds=90), targets, 20.0, 900.0) == once


def test_few_pairs_are_swept(spark, monkeypatch):
    """Of the areas' pairs only those along the sweep reach the costly test, with a part of its steps."""
    seen = []
    strip = predict._in_strip

    def watched(pairs):
        out = strip(pairs)
        steps = F.col("_w.most") - F.col("_w.least") + 1
        seen.append((pairs.count(), out.agg(F.count("*"), F.avg(steps / (2 * predict._steps(F.col("offset_km"))))).first()))
        return out

    monkeypatch.setattr(predict, "_in_strip", watched)
    targets = [x for x in _targets(200, 7, ("box",)) if None not in x and x[7] < x[8] < x[7] + 20 and x[10] < x[9] + 20 and abs(x[5]) < 50]
    _windows(spark, _samples(300, seconds=90), targets, 20.0, 1500.0)
    pairs, (left, share) = seen[0]
    assert 0 < left < pairs / 4 and share < 0.6


def test_sweeps_in_arrays_see_what_the_formulas_say(spark):
    """Every step as a row, by the plain formulas, against the sweep worked out in arrays."""
    from swathmatch.functions.geo import destination_point, in_box, point_in_polygon

    rng, rows = random.Random(11), []
    for k, (i, sat, shape, _, _, lat0, lon0, w, e, s, n, ring) in enumerate(_targets(1200, 9)):
        ring = {1: ring[:2], 2: None, 3: [], 4: [(s, 179.0), (n, 179.0), (n, -179.0), (s, -179.0)], 5: [*ring[:2], (None, 3.0)]}.get(rng.randint(0, 9), ring)
        box = (178.0, -178.0, s, n) if ring and len(ring) == 4 and ring[0][1] == 179.0 else (w, e, s, n)
        lat, lon = rng.uniform(-89, 89), rng.uniform(-180, 180)
        if rng.random() < 0.6:
            lat, lon = max(-89.0, min(89.0, lat0 + rng.uniform(-12, 12))), (lon0 + rng.uniform(-12, 12) + 180) % 360 - 180
        rows.append((k, 10 * k, rng.choice((None, 10 * k - 5)), 0, 99, shape, lat, lon, rng.choice((None, *[rng.uniform(0, 360)] * 7)), 700.0,
                     lat0, lon0, *box, ring, lat + 0.5, lon, lat - 0.5, lon, (-14, rng.randint(-15, 14))))
    pairs = spark.createDataFrame(rows, "target_id long, t_us long, before_us long, start_us long, end_us long, shape string, lat double, lon double, "
                                  "heading double, offset_km double, lat0 double, lon0 double, min_lon double, max_lon double, min_lat double, max_lat double, "
                                  "polygon array<struct<lat double, lon double>>, next_lat double, next_lon double, prev_lat double, prev_lon double, "
                                  "_w struct<least int, most int>")
    areas = pairs.filter("shape <> 'point'")
    places = areas.withColumn("i", F.explode(F.sequence(F.lit(-14), F.lit(14)))).filter("i = 0 OR i BETWEEN _w.least AND _w.most")
    y, x = destination_point("lat", "lon", F.col("heading") + F.when(F.col("i") > 0, 90.0).otherwise(-90.0), F.col("offset_km") * F.abs("i") / 14)
    y, x = (F.when(F.col("i") == 0, F.col(own)).otherwise(v) for own, v in (("lat", y), ("lon", x)))
    places = places.withColumns({"y": y, "x": x})
    box = in_box("x", "y", "min_lon", "max_lon", "min_lat", "max_lat")
    expected = places.filter(F.when(F.col("shape") == "polygon", box & point_in_polygon("y", "x", "polygon")).otherwise(box)).select("target_id").distinct()
    columns = ["target_id", "t_us", "before_us", "start_us", "end_us"]
    got = predict._seen(areas)
    assert got.columns == columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, areas.join(expected, "target_id").select(*columns).collect()))
    by_shape = dict(areas.join(expected, "target_id").groupBy("shape").count().collect())
    assert min(by_shape["box"], by_shape["polygon"]) > 15, by_shape
    assert predict._seen(pairs.filter("shape = 'point'")).count() > 15
