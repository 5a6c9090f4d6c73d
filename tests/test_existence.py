"""Matched and unmatched observations, neighbours on the time axis of a model."""

import random
from datetime import datetime, timedelta

import pytest

from swathmatch.operators import predict
from swathmatch.operators.model import time_lookup

T0 = datetime(2024, 3, 1)
OBS = "obs_id long, lon double, lat double, time timestamp, platform_type string, tolerance_us long, other int"
PAIRS = "val_source string, val_lon double, val_lat double"
WINDOWS = "scene string, start timestamp, end timestamp"


def minutes(n):
    return None if n is None else T0 + timedelta(minutes=n)


def expected(obs, pairs, windows):
    """Row by row: an observation against every pair and every window."""
    kind = {"hf_radar": "Hf_Radar"}
    places = {(kind.get(s, "In-situ"), round(x, 6), round(y, 6)) for s, x, y in pairs if x is not None and y is not None}
    known = [(a, b) for a, b in windows if a is not None and b is not None]
    out = []
    for i, x, y, t, p, tol in obs:
        cat = kind.get(p, "In-situ")
        hit = x is not None and y is not None and (cat, round(x, 6), round(y, 6)) in places
        if hit or t is None or not known or (tol is not None and any(a <= b and a <= t + tol and b >= t - tol for a, b in known)):
            out.append((i, x, y, hit))
    return sorted(out, key=repr)


def classified(spark, obs, pairs, windows):
    o = spark.createDataFrame([(i, x, y, minutes(t), p, None if tol is None else tol * 60_000_000, 1) for i, x, y, t, p, tol in obs], OBS)
    w = spark.createDataFrame([("s", minutes(a), minutes(b)) for a, b in windows], WINDOWS)
    return predict.matched_unmatched(o, spark.createDataFrame(pairs, PAIRS), w)


@pytest.mark.parametrize("seed", range(4))
def test_equals_row_by_row(spark, seed):
    rnd = random.Random(seed)
    day = 24 * 60
    starts = [rnd.randrange(-5 * day, 40 * day) for _ in range(9)]
    # short ones, one over several days, one that ends before it begins, unknown ends
    windows = [(a, a + rnd.choice([0, 7, 300])) for a in starts] + [(12 * day, 15 * day + 5), (50 * day, 49 * day), (None, 3), (4, None)]
    spots = [(round(rnd.uniform(-9, 9), 3), round(rnd.uniform(-9, 9), 3)) for _ in range(12)]
    obs = []
    for n in range(400):
        x, y = rnd.choice(spots) if rnd.random() < 0.9 else (None, 1.0)
        t = rnd.choice([rnd.randrange(-20 * day, 60 * day), rnd.choice(starts) + rnd.randrange(-400, 700), None])
        # ids repeat, and some are unknown
        obs.append((rnd.choice([n, 5, None]), x, y, t, rnd.choice(["mooring", "hf_radar", None]), rnd.choice([0, 60, 180, 3 * day, None])))
    pairs = [(rnd.choice(["mooring", "hf_radar"]), *s) for s in spots[:5]] * 2 + [(None, None, None)]
    got = sorted(((r.obs_id, r.lon, r.lat, r.matched) for r in classified(spark, obs, pairs, windows).collect()), key=repr)
    assert got == expected(obs, pairs, windows)
    none = [(None, 5), (5, None)]
    got = sorted(((r.obs_id, r.lon, r.lat, r.matched) for r in classified(spark, obs, pairs, none).collect()), key=repr)
    assert got == expected(obs, pairs, none)


def test_empty_tables(spark):
    one = [(1, 2.0, 3.0, 0, "mooring", 60)]
    assert classified(spark, [], [], []).count() == 0
    assert [tuple(r) for r in classified(spark, one, [], []).select("obs_id", "matched").collect()] == [(1, False)]
    assert classified(spark, one, [], [(9999, 9998)]).count() == 0


def test_observations_are_read_once(spark, tmp_path):
    obs = [(i, float(i), 0.0, i, "mooring", 60) for i in range(50)]
    spark.createDataFrame([(i, x, y, minutes(t), p, tol, 1) for i, x, y, t, p, tol in obs], OBS).write.parquet(str(tmp_path / "observations"))
    pairs = spark.createDataFrame([("mooring", 3.0, 0.0)], PAIRS)
    w = spark.createDataFrame([("s", minutes(0), minutes(9))], WINDOWS)
    out = predict.matched_unmatched(spark.read.parquet(str(tmp_path / "observations")), pairs, w)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_time_axis_over_chunk_borders(spark):
    """Neighbours many chunks away, and chunks of one time, give what a sorted list gives."""
    rnd = random.Random(9)
    hours = sorted({rnd.randrange(24 * 400) for _ in range(60)} | set(range(24 * 29, 24 * 31)))
    model = spark.createDataFrame([(s, T0 + timedelta(hours=h)) for h in hours for s in "ab" if s == "a" or h % 2], "source string, time timestamp")
    asked = [rnd.randrange(24 * 420 * 60) for _ in range(300)]
    times = spark.createDataFrame([(minutes(m),) for m in asked], "time timestamp")
    zero = spark.createDataFrame([(T0,)], "t timestamp").selectExpr("unix_micros(t)").first()[0]
    got = {(r.source, (r.t_us - zero) // 60_000_000): (r.m_us - zero) // 3_600_000_000 for r in time_lookup(times, model, "nearest").collect()}
    for s in "ab":
        own = [h for h in hours if s == "a" or h % 2]
        for m in asked:
            assert got[(s, m)] == min(own, key=lambda h: (abs(h * 60 - m), h))
    hit = {(r.source, (r.t_us - zero) // 60_000_000): (r.m_us - zero) // 3_600_000_000 for r in time_lookup(times, model).collect()}
    want = {}
    for s in "ab":
        own = [h for h in hours if s == "a" or h % 2]
        for m in asked:
            k = max((i for i, h in enumerate(own) if h <= m // 60), default=None)
            if k and k + 1 < len(own) and own[k + 1] - own[k] == own[k] - own[k - 1]:
                want[(s, m)] = own[k]
    assert hit == want
