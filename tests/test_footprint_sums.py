"""The footprint join against brute force, and that no pair of point and reading becomes a row."""

import datetime as dt
import math
import random

import pytest

from swathmatch.operators import overlap, spatial

NOON = dt.datetime(2026, 1, 1, 12)
POINTS = "scene string, point_idx int, lon double, lat double, time timestamp, oswTotalHs double"
OBS = "obs_id long, platform_id string, platform_type string, time timestamp, lon double, lat double, WSPD double, EWCT double"


def hav(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, a)))


def weight(method, d):
    return {"equal": 1.0, "linear": max(0.0, 1 - d / 28), "gaussian": math.exp(-d * d / 50), "inverse_distance": 1 / max(d, 1e-6) ** 2}[method]


def some_points(rng, n):
    return [(f"S{i % 7}", i, rng.choice((179.95, -179.9, 179.8)), 10 + rng.random() / 3, NOON + dt.timedelta(minutes=rng.randint(-2000, 2000)), 1.0)
            for i in range(n)]


def readings(rng, n):
    """Half of them at two places, the others anywhere."""
    places = [(179.99, 10.1), (-179.97, 10.2)]
    out = []
    for i in range(n):
        lon, lat = rng.choice(places) if i % 2 else (rng.choice((1, -1)) * (179.7 + 0.3 * rng.random()), 10 + rng.random() / 3)
        t = NOON + dt.timedelta(minutes=rng.randint(-2100, 2100), microseconds=rng.randint(0, 2))
        out.append((i, f"p{i}", "buoy", t, lon, lat, None if i % 5 == 0 else rng.random(), None if i % 3 else float(i)))
    return out


@pytest.mark.parametrize(("method", "rows"), [("equal", 20_000), ("linear", 7), ("gaussian", 20_000), ("inverse_distance", 20_000)])
def test_footprints_against_brute_force(spark, monkeypatch, method, rows):
    monkeypatch.setattr(overlap, "GROUP_ROWS", rows)
    rng = random.Random(4)
    pts, obs = some_points(rng, 60), readings(rng, 300)
    got = {r.sar_x_idx: r for r in spatial.footprint_join(spark.createDataFrame(pts, POINTS), spark.createDataFrame(obs, OBS), ["oswTotalHs"],
                                                          ["WSPD", "EWCT"], 28.0, 180.0, method).collect()}
    found = 0
    for _, k, lon, lat, t, _ in pts:
        near = [(hav(lon, lat, o[4], o[5]), abs(o[3] - t), o) for o in obs]
        near = [x for x in near if x[0] <= 28 and x[1] <= dt.timedelta(minutes=180)]
        if not any(o[c] is not None for _, _, o in near for c in (6, 7)):
            assert k not in got
            continue
        found += 1
        r = got[k]
        for c, v in ((6, r.val_WSPD), (7, r.val_EWCT)):
            known = [(weight(method, d), o[c]) for d, _, o in near if o[c] is not None]
            if known:
                assert v == pytest.approx(sum(w * x for w, x in known) / sum(w for w, _ in known), rel=1e-9)
            else:
                assert v is None
        assert r.spatial_distance_km == pytest.approx(min(d for d, _, _ in near), abs=1e-9)
        assert r.temporal_distance_minutes == pytest.approx(min(x for _, x, _ in near).total_seconds() / 60, abs=1e-9)
        assert r.val_id == min(near, key=lambda x: (round(x[0] * 1e6), x[2][0]))[2][1]
    assert found > 20


def test_readings_of_a_place_are_not_paired(spark):
    pts = [("S", i, 5.0, 10.0, NOON, 1.0) for i in range(300)]
    obs = [(i, "p", "buoy", NOON + dt.timedelta(seconds=i), 5.0, 10.0, float(i), 1.0) for i in range(500)]
    r = spatial.footprint_join(spark.createDataFrame(pts, POINTS), spark.createDataFrame(obs, OBS), ["oswTotalHs"], ["WSPD"], 28.0, 180.0)
    rows = r.collect()
    assert len(rows) == 300 and {(x.val_WSPD, x.val_id, x.temporal_distance_minutes) for x in rows} == {(249.5, "p", 0.0)}
    # 150,000 pairs; they meet in a cogroup and not in a join on the bins
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_empty_sides(spark):
    no_pts, no_obs = spark.createDataFrame([], POINTS), spark.createDataFrame([], OBS)
    pts = spark.createDataFrame([("S", 0, 5.0, 10.0, NOON, 1.0)], POINTS)
    assert spatial.footprint_join(pts, no_obs, ["oswTotalHs"], ["WSPD"], 28.0, 180.0).count() == 0
    assert spatial.footprint_join(no_pts, no_obs, ["oswTotalHs"], ["WSPD"], 28.0, 180.0).count() == 0
