"""Tiny hand-checked cases and brute force for the matching joins."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swathmatch.operators import spatial
from swathmatch.operators.asof import asof_nearest, average_to_scenes
from swathmatch.operators.model import individual_join, temporal_bracket
from swathmatch.operators.ordered import micros, next_valid, run_numbers, with_neighbours
from swathmatch.operators.spatial import MatchSpec, radius_pairs

NOON = dt.datetime(2026, 1, 1, 12)
OBS = "obs_id long, platform_id string, platform_type string, time timestamp, lon double, lat double, WSPD double"


def hav(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, a)))


def grid(spark, speed=8.0, direction=225.0, mask=1.0):
    rows = [("S", y, x, -1 + 0.5 * x, 51 + 2 * y / 3, NOON, speed, direction, mask) for y in range(4) for x in range(5)]
    return spark.createDataFrame(rows, "scene string, y int, x int, lon double, lat double, time timestamp, owiWindSpeed double, "
                                       "owiWindDirection double, owiMask double")


def observations(spark, rows):
    return spark.createDataFrame(rows, OBS)


SAR = ["owiWindSpeed", "owiWindDirection", "owiMask"]


@pytest.mark.parametrize("weighting", ["gaussian", "inverse_distance", "linear", "equal"])
def test_constant_field_is_kept_by_any_weighting(spark, weighting):
    obs = observations(spark, [(1, "a", "mooring", NOON, 0.1, 52.1, 7.0)])
    r = spatial.radius_join(grid(spark), obs, SAR, ["WSPD"], MatchSpec(30, 25, 60, weighting, 20.0)).collect()
    assert len(r) == 1
    assert r[0].sar_owiWindSpeed == pytest.approx(8.0) and r[0].sar_owiWindDirection == pytest.approx(225.0)
    assert r[0].val_WSPD == 7.0 and r[0].val_source == "mooring" and r[0].temporal_distance_minutes == 0


def test_auxiliary_variables_alone_make_no_match(spark):
    obs = observations(spark, [(1, "a", "mooring", NOON, 0.0, 52.0, 7.0)])
    empty = grid(spark, None, None)
    assert spatial.radius_join(empty, obs, SAR, ["WSPD"], MatchSpec(30, 25, 60, "equal")).count() == 0
    assert spatial.nearest_join(empty, obs, SAR, ["WSPD"], MatchSpec(30, 60, 60, "equal"), "x").count() == 0


def test_empty_observations(spark):
    obs = observations(spark, [])
    assert spatial.radius_join(grid(spark), obs, SAR, ["WSPD"], MatchSpec()).count() == 0


def test_fill_never_borrows_from_another_platform(spark):
    later = NOON + dt.timedelta(minutes=5)
    obs = observations(spark, [(1, "a", "tidal_gauge", NOON, 0.0, 52.0, None), (2, "b", "mooring", later, 0.0, 52.0, 9.0),
                               (3, None, "buoy", NOON, 0.0, 52.0, None), (4, None, "buoy", later, 0.0, 52.0, 3.0)])
    r = spatial.radius_join(grid(spark), obs, SAR, ["WSPD"], MatchSpec(30, 25, 60, "equal")).collect()
    assert sorted((x.val_source, x.val_WSPD) for x in r) == [("buoy", 3.0), ("mooring", 9.0)]


def test_fill_takes_the_first_later_value_within_tolerance(spark):
    def at(m):
        return NOON + dt.timedelta(minutes=m)

    rows = [(1, "a", "m", at(0), 0.0, 0.0, None), (2, "a", "m", at(0), 0.0, 0.0, 5.0), (3, "a", "m", at(10), 0.0, 0.0, 6.0),
            (4, "a", "m", at(11), 0.0, 0.0, None), (5, "a", "m", at(60), 0.0, 0.0, 7.0), (6, "b", "m", at(20), 0.0, 0.0, None),
            (7, "b", "m", at(51), 0.0, 0.0, 1.0)]
    for pieces in (1, 3, 16, 1000):
        out = next_valid(observations(spark, rows).withColumn("us", micros("time")), ["platform_id"], "us", "obs_id", ["WSPD"],
                         30 * spatial.MINUTE, pieces)
        got = {r.obs_id: r.WSPD for r in out.collect()}
        # equal times are not "later"; 49 and 31 minutes are too far
        assert got == {1: 6.0, 2: 5.0, 3: 6.0, 4: None, 5: 7.0, 6: None, 7: 1.0}


def test_dedup_keeps_the_reading_closest_in_time(spark):
    obs = observations(spark, [(i, "a", "hf", NOON + dt.timedelta(minutes=m), 0.0, 52.0, float(i)) for i, m in ((1, -20), (2, 5), (3, -5), (4, 9))])
    spec = MatchSpec(30, 25, 60, "equal", dedup_nearest_in_time=True)
    r = spatial.radius_join(grid(spark), obs, SAR, ["WSPD"], spec).collect()
    assert [x.val_WSPD for x in r] == [2.0]  # a tie goes to the earlier row


def test_linear_weight_at_the_rim_leaves_the_variable_missing(spark):
    one = spark.createDataFrame([("S", 0, 0, 0.0, 0.0, NOON, 8.0)], "scene string, y int, x int, lon double, lat double, time timestamp, owiWindSpeed double")
    d = hav(0, 0, 0.1, 0)
    obs = observations(spark, [(1, "a", "m", NOON, 0.1, 0.0, 1.0)])
    assert spatial.radius_join(one, obs, ["owiWindSpeed"], ["WSPD"], MatchSpec(30, 25, d, "linear")).count() == 0


@pytest.mark.parametrize("radius", [3.0, 40.0, 700.0])
def test_bins_find_every_pair_of_a_brute_force_search(spark, radius):
    rnd = random.Random(int(radius))
    centres = [(0.0, 0.0), (179.95, 10.0), (-179.95, -20.0), (12.0, 80.0), (-100.0, 89.7), (50.0, -89.9), (179.99, 88.0)]
    km = radius / 111.0

    def cloud(n):
        out = []
        for i in range(n):
            lon, lat = centres[i % len(centres)]
            lat = max(-90.0, min(90.0, lat + rnd.uniform(-1.5, 1.5) * km))
            stretch = min(180.0, 1.5 * km / max(math.cos(math.radians(lat)), 1e-3))
            out.append((i, (lon + rnd.uniform(-1, 1) * stretch + 180) % 360 - 180, lat))
        return out

    a, t = cloud(140), cloud(210)
    want = {(i, j) for i, x, y in a for j, u, v in t if hav(x, y, u, v) <= radius}
    left = spark.createDataFrame(a, "a long, a_lon double, a_lat double").withColumn("scene", F.lit("s"))
    right = spark.createDataFrame(t, "t long, t_lon double, t_lat double").withColumn("scene", F.lit("s"))
    rows = [(r.a, r.t) for r in radius_pairs(left, right, radius).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 50


def test_nearest_join_equals_brute_force(spark):
    rnd = random.Random(5)
    cells = [("S", i // 12, i % 12, rnd.uniform(178.5, 179.9), rnd.uniform(70, 71), NOON, 1.0 + i) for i in range(144)]
    obs = [(i, "p", "m", NOON, rnd.uniform(178.5, 179.9), rnd.uniform(70, 71), float(i)) for i in range(60)]
    obs += [(100 + i, *o[1:]) for i, o in enumerate(obs[:20])]  # copies at the same place
    want = {}
    for _, y, x, lon, lat, _, _ in cells:
        d, k = min((round(hav(lon, lat, o[4], o[5]) * 1e6), o[0]) for o in obs)
        if d <= 9e6:
            want[(y, x)] = k
    table = spark.createDataFrame(cells, "scene string, y int, x int, lon double, lat double, time timestamp, owiWindSpeed double")
    r = spatial.nearest_join(table, observations(spark, obs), ["owiWindSpeed"], ["WSPD"], MatchSpec(30, 9, 5, "equal"), "x").collect()
    assert {(q.sar_y_idx, q.sar_x_idx): int(q.val_WSPD) % 100 for q in r} == {k: v % 100 for k, v in want.items()}


def test_result_does_not_depend_on_partitions(spark):
    rnd = random.Random(1)
    obs = observations(spark, [(i, "a", "m", NOON, rnd.uniform(-1, 1), rnd.uniform(51, 53), float(i)) for i in range(200)])
    seen = []
    for n in (1, 3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        r = spatial.radius_join(grid(spark).repartition(n), obs.repartition(n), SAR, ["WSPD"], MatchSpec(30, 25, 40, "gaussian", 15.0))
        seen.append(sorted((x.val_WSPD, round(x.sar_owiWindSpeed, 9), x.sar_y_idx, x.sar_x_idx) for x in r.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] == seen[2] and seen[0]


def test_one_hot_position_keeps_every_reading(spark):
    obs = spark.range(30_000).select(
        F.col("id").alias("obs_id"), F.lit("hot").alias("platform_id"), F.lit("mooring").alias("platform_type"),
        F.timestamp_micros(F.lit(1767268800000000) + F.col("id") * 1000).alias("time"), F.lit(0.0).alias("lon"), F.lit(52.0).alias("lat"),
        F.col("id").cast("double").alias("WSPD"))
    r = spatial.radius_join(grid(spark), obs, SAR, ["WSPD"], MatchSpec(30, 25, 60, "equal"))
    assert r.agg(F.count("*"), F.sum("val_WSPD")).first() == (30_000, sum(range(30_000)))


def test_no_cross_product_in_the_plans(spark):
    obs = observations(spark, [(1, "a", "mooring", NOON, 0.1, 52.1, 7.0)])
    for df in (spatial.radius_join(grid(spark), obs, SAR, ["WSPD"], MatchSpec()),
               spatial.nearest_join(grid(spark), obs, SAR, ["WSPD"], MatchSpec(), "x")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_footprint_join_aggregates_on_the_point(spark):
    pts = spark.createDataFrame([("W", 0, 0.0, 10.0, NOON, 2.0), ("W", 1, 5.0, 10.0, NOON, None)],
                                "scene string, point_idx int, lon double, lat double, time timestamp, oswTotalHs double")
    m = dt.timedelta(minutes=1)
    obs = observations(spark, [(1, "a", "buoy", NOON + 9 * m, 0.01, 10.0, 4.0), (2, "b", "", NOON - 3 * m, 0.08, 10.0, 8.0),
                               (3, "c", "buoy", NOON + 99 * m, 0.0, 10.0, 50.0)])
    r = spatial.footprint_join(pts, obs, ["oswTotalHs"], ["WSPD"], 14.0, 30.0).collect()
    assert len(r) == 1
    assert r[0].val_WSPD == 6.0 and r[0].val_id == "a" and r[0].temporal_distance_minutes == 3.0 and r[0].sar_x_idx == 0


def test_asof_ties_go_to_the_earlier_scene(spark):
    def at(m):
        return NOON + dt.timedelta(minutes=m)

    obs = observations(spark, [(1, "a", "m", at(30), 0.0, 0.0, 1.0), (2, "a", "m", at(31), 0.0, 0.0, 2.0), (3, "a", "m", at(-40), 0.0, 0.0, 3.0),
                               (4, "a", "m", None, 0.0, 0.0, 4.0), (5, "a", "m", at(101), 0.0, 0.0, 5.0)])
    scenes = spark.createDataFrame([(at(0),), (at(60),), (at(0),)], "time timestamp")
    got = {r.obs_id: (r.scene_us - 1767268800000000) // spatial.MINUTE for r in asof_nearest(obs, scenes, 40).collect()}
    assert got == {1: 0, 2: 60, 3: 0}
    mean = {r.time: r.WSPD for r in average_to_scenes(obs, scenes, ["platform_id"], ["WSPD"], 40).collect()}
    assert mean == {at(0): 2.0, at(60): 2.0}


# --- models ---------------------------------------------------------------------------------

def field(spark, hours, f, n=4):
    rows = [("m", dt.datetime(2026, 1, 1, 0) + dt.timedelta(hours=h), i, j, 50.0 + i, 0.0 + 2 * j, float(f(50 + i, 2 * j, h)[0]), float(f(50 + i, 2 * j, h)[1]))
            for h in hours for i in range(n) for j in range(n)]
    return spark.createDataFrame(rows, "source string, time timestamp, lat_idx int, lon_idx int, lat double, lon double, u10 double, v10 double")


def cells_at(spark, places, hour):
    t = dt.datetime(2026, 1, 1) + dt.timedelta(hours=hour)
    return spark.createDataFrame([("S", 0, k, x, y, t, 1.0) for k, (x, y) in enumerate(places)],
                                 "scene string, y int, x int, lon double, lat double, time timestamp, owiWindSpeed double")


def test_bilinear_and_parabola_are_exact_for_their_polynomials(spark):
    def f(lat, lon, h):
        return lat + 0.5 * lon + 0.1 * lat * lon + h * h - 3 * h, 4.0

    places = [(0.3, 50.2), (5.9, 52.99), (6.0, 53.0), (0.0, 50.0), (6.1, 51.0), (3.0, 49.9)]
    r = individual_join(cells_at(spark, places, 4.5), field(spark, range(8), f), ["owiWindSpeed"], ["u10", "v10"], "m").collect()
    got = {x.x: x.WSPD for x in r}
    assert set(got) == {0, 1, 2, 3}  # the last two are outside
    for k, v in got.items():
        u = f(places[k][1], places[k][0], 4.5)[0]
        assert v == pytest.approx(math.hypot(u, 4.0), abs=1e-9)


def test_direction_follows_the_vector_through_the_whole_circle(spark):
    for deg in range(0, 360, 60):
        rad = math.radians(deg)
        r = individual_join(cells_at(spark, [(1.0, 51.0)], 3.25), field(spark, range(8), lambda *_: (-5 * math.sin(rad), -5 * math.cos(rad))),
                            ["owiWindSpeed"], ["u10", "v10"], "m").first()
        assert (r.WDIR - deg + 180) % 360 - 180 == pytest.approx(0, abs=1e-6) and 0 <= r.WDIR < 360 and r.WSPD == pytest.approx(5)


def test_irregular_or_missing_model_times_give_nothing(spark):
    model = field(spark, [0, 3, 9], lambda *_: (1.0, 1.0))
    for hour in (1.0, 4.0, 9.5):
        assert individual_join(cells_at(spark, [(1.0, 51.0)], hour), model, ["owiWindSpeed"], ["u10", "v10"], "m").count() == 0
    times = spark.createDataFrame([(dt.datetime(2026, 1, 1, 4, 30),)], "time timestamp")
    regular = field(spark, [0, 3, 6], lambda *_: (1.0, 1.0)).select("source", "time")
    assert temporal_bracket(times, regular).agg(F.sum("factor")).first()[0] == pytest.approx(1.0)


def test_land_hides_model_values_above_one_half_only(spark):
    static = spark.createDataFrame([("m", i, j, 50.0 + i, 2.0 * j, 0.5 if j < 2 else 0.51) for i in range(4) for j in range(4)],
                                   "source string, lat_idx int, lon_idx int, lat double, lon double, lsm double")
    r = individual_join(cells_at(spark, [(1.0, 51.0), (5.0, 51.0)], 3.0), field(spark, range(8), lambda *_: (1.0, 1.0)),
                        ["owiWindSpeed"], ["u10", "v10"], "m", static=static).collect()
    assert [x.x for x in r] == [0]


# --- ordered helpers ---------------------------------------------------------------------------

def test_neighbours_and_runs_do_not_depend_on_the_chunk(spark):
    rnd = random.Random(3)
    rows = sorted({(g, rnd.randrange(10_000)) for g in "ab" for _ in range(150)})
    df = spark.createDataFrame(rows, "g string, u long")
    for chunk in (1, 37, 10**9):
        near = {(r.g, r.u): (r.prev_u, r.next_u) for r in with_neighbours(df, ["g"], ["u"], ["u"], "u", chunk).collect()}
        for g in "ab":
            us = [u for k, u in rows if k == g]
            assert all(near[(g, u)] == (us[i - 1] if i else None, us[i + 1] if i + 1 < len(us) else None) for i, u in enumerate(us))
        runs = run_numbers(df, ["g"], ["u"], F.col("u") % 7 == 0, "u", chunk).collect()
        for g in "ab":
            n = 0
            for r in sorted((r for r in runs if r.g == g), key=lambda r: r.u):
                n += r.u % 7 == 0
                assert r.run == n


def test_quantiles_survive_outliers(spark):
    from swathmatch.operators.quantiles import exact_quantiles, value_bins

    rows = [("g", i / 1e4) for i in range(100_000)] + [("g", 9.97e36), ("g", -1e20), ("g", 5.0), ("h", 7.0), ("n", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    binned, _ = value_bins(df, ["k"], "v")
    assert binned.groupBy("k", "_bin").agg(F.sum("_c").alias("n")).agg(F.max("n")).first()[0] < 1000
    got = {r.k: r.q for r in exact_quantiles(df, ["k"], "v", [0.0, 0.5, 0.9, 1.0]).collect()}
    want = np.quantile([v for k, v in rows if k == "g"], [0.0, 0.5, 0.9, 1.0])
    assert np.allclose(got["g"], want) and got["h"] == [7.0] * 4 and "n" not in got


def test_hot_keys_and_equal_rows_spread_over_lanes(spark):
    from swathmatch.operators.skew import salted_join

    big = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("k"), F.lit(1).alias("x"))
    small = spark.createDataFrame([("hot", 5), ("cold", 6)], "k string, y int")
    out = salted_join(big, small, ["k"], salts=None)
    assert out.count() == 4000 and {r.y for r in out.distinct().collect()} == {5}


def shuffled_rows(spark, df):
    """Most rows any stage writes to the shuffle while *df* is computed."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()

    def stages():
        found = store.stageList(gateway.jvm.java.util.ArrayList(), False, False, gateway.new_array(gateway.jvm.double, 0),
                                gateway.jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (found.apply(i) for i in range(found.size()))}

    before = stages()
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return max(n for k, n in stages().items() if k not in before)


def many_scenes(spark, scenes):
    return grid(spark).filter("y < 2").drop("scene").crossJoin(spark.range(scenes).select(F.col("id").cast("string").alias("scene")))


def readings_at_noon(spark, n):
    return spark.range(n).select(
        F.col("id").alias("obs_id"), F.col("id").cast("string").alias("platform_id"), F.lit("mooring").alias("platform_type"),
        F.timestamp_micros(F.lit(1767268800000000) + F.col("id") * 1000).alias("time"), F.lit(0.1).alias("lon"), F.lit(51.1).alias("lat"),
        F.when(F.col("id") % 11 != 0, F.col("id").cast("double")).alias("WSPD"))


def test_pairs_of_reading_and_scene_are_not_shuffled(spark):
    cells, obs = many_scenes(spark, 60), readings_at_noon(spark, 600)
    pairs = spatial.radius_join(cells, obs, SAR, ["WSPD"], MatchSpec(30, 25, 60, "equal"))
    assert pairs.count() == 60 * (600 - 55)
    assert shuffled_rows(spark, pairs) < 10_000
    nearest = spatial.nearest_join(cells, obs, SAR, ["WSPD"], MatchSpec(30, 60, 60, "equal"), "x")
    assert shuffled_rows(spark, nearest) < 25_000


@pytest.mark.parametrize("platform", ["a", None])
def test_gap_is_filled_from_a_candidate_of_the_scene(spark, platform):
    # seven valid readings beside the scene come ahead of the one inside, more than an observation carries
    at = [NOON + dt.timedelta(minutes=m) for m in range(12)]
    rows = [(0, platform, "m", at[0], 0.1, 52.1, None)]
    rows += [(i, platform, "m", at[i], 40.0, 52.1, 100.0 + i) for i in range(1, 8)]
    rows += [(9, platform, "m", at[9], 0.1, 52.1, 9.0), (8, platform, "m", at[9], 0.1, 52.1, 8.0)]
    obs = observations(spark, rows)
    spec = MatchSpec(30, 25, 60, "equal")
    r = spatial.radius_join(grid(spark), obs if platform else obs.drop("platform_id"), SAR, ["WSPD"], spec).collect()
    assert sorted(x.val_WSPD for x in r) == [8.0, 8.0, 9.0]
    # a row without a platform keeps its gap
    if platform is None:
        assert sorted(x.val_WSPD for x in spatial.radius_join(grid(spark), obs, SAR, ["WSPD"], spec).collect()) == [8.0, 9.0]


def test_gaps_agree_with_a_fill_inside_each_scene(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("ab"), "m", NOON + dt.timedelta(minutes=rnd.randrange(-35, 36)), rnd.uniform(-2.5, 2.5), 52.1,
             float(i) if rnd.random() < 0.4 else None) for i in range(150)]
    obs, cells = observations(spark, rows), grid(spark)
    spec = MatchSpec(30, 25, 60, "equal")
    pool = spatial.candidates(obs, spatial.scene_extents(cells), 25 / spatial.K.KM_PER_DEG_RADIUS_BUFFER, spec.tolerance_us)
    want = next_valid(pool, ["scene"], "obs_us", "obs_id", ["WSPD"], spec.tolerance_us)
    near = {(round(x.val_lon, 9), round(x.val_lat, 9)) for x in spatial.radius_join(cells, obs.fillna(1.0, ["WSPD"]), SAR, ["WSPD"], spec).collect()}
    r = spatial.radius_join(cells, obs, SAR, ["WSPD"], spec).collect()
    assert sorted((round(x.val_lon, 9), x.val_WSPD) for x in r) == sorted(
        (round(x.lon, 9), x.WSPD) for x in want.collect() if x.WSPD is not None and (round(x.lon, 9), round(x.lat, 9)) in near)
