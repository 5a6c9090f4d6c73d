"""Joins and counts of intervals and boxes of mixed sizes against all pairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from swathmatch.operators import overlap, predict
from swathmatch.operators.overlap import Axis, overlap_counts, overlap_join

T0 = dt.datetime(2024, 1, 1)
TIMES = "id long, start timestamp, end timestamp, k int"
R_TIMES = "rid long, r_start timestamp, r_end timestamp, k int"
LENGTHS = (0, 1, 60, 3600, 86_400, 40 * 86_400, 900 * 86_400)


def windows(rng, n, strange=True):
    out = []
    for i in range(n):
        a = T0 + dt.timedelta(seconds=rng.randint(0, 1000 * 86_400))
        b = a + dt.timedelta(seconds=rng.choice(LENGTHS), microseconds=rng.randint(0, 3))
        if strange:
            a, b = rng.choice([(a, b)] * 12 + [(None, b), (a, None), (None, None), (b, a)])
        out.append((i, a, b, i % 3))
    return out


def meets(a, b, c, d):
    if (a and b and b < a) or (c and d and d < c):
        return False
    return not (b and c and b < c) and not (a and d and d < a)


def test_windows_of_all_lengths(spark):
    rng = random.Random(1)
    left, right = windows(rng, 250), windows(rng, 250)
    lhs, rhs = spark.createDataFrame(left, TIMES), spark.createDataFrame(right, R_TIMES)
    want = sorted((x[0], y[0]) for x in left for y in right if meets(*x[1:3], *y[1:3]))
    got = predict.interval_overlap_join(lhs, rhs.drop("k"))
    assert sorted((r.id, r.rid) for r in got.collect()) == want
    assert got.columns == ["id", "start", "end", "k", "rid", "r_start", "r_end"]
    within = predict.interval_overlap_join(lhs, rhs, by=["k"])
    assert sorted((r.id, r.rid) for r in within.collect()) == [(i, j) for i, j in want if left[i][3] == right[j][3]]
    # the columns come back as they were
    assert {(r.id, r.start, r.end) for r in within.collect()} <= {x[:3] for x in left}


def test_all_open_and_empty(spark):
    nothing = spark.createDataFrame([], R_TIMES).drop("k")
    some = spark.createDataFrame([(1, None, None, 0), (2, T0, T0, 0)], TIMES)
    assert predict.interval_overlap_join(some, nothing).count() == 0
    both = spark.createDataFrame([(1, None, None, 0), (2, T0, None, 0)], R_TIMES).drop("k")
    assert predict.interval_overlap_join(some, both).count() == 4


def boxes(rng, n, p):
    out = []
    for i in range(n):
        w, h = (rng.choice((0.0, 0.01, 1.5, 20.0, 150.0)) for _ in range(2))
        x, y = rng.uniform(-180, 180), rng.choice((-90.0, 0.0, rng.uniform(-90, 90)))
        ends = (x, x + w) if rng.random() < 0.95 else (x + w, x)
        out.append((i, *ends, y, y + h))
    names = [f"{p}{c}" for c in ("min_lon", "max_lon", "min_lat", "max_lat")]
    return out, ", ".join([f"{p}id long", *[f"{c} double" for c in names]])


def box_meets(a, b):
    return a[2] >= b[1] and a[1] <= b[2] and a[4] >= b[3] and a[3] <= b[4]


def test_boxes_of_all_sizes(spark):
    rng = random.Random(2)
    (left, ls), (right, rs) = boxes(rng, 300, ""), boxes(rng, 300, "r_")
    right[0] = (0, *left[0][2:3], left[0][2] + 1, *left[0][3:5])  # touches at an edge
    lhs, rhs = spark.createDataFrame([*left, (None, None, 1.0, 1.0, 1.0)], ls), spark.createDataFrame(right, rs)
    want = sorted((a[0], b[0]) for a in left for b in right if box_meets(a, b))
    assert sorted(map(tuple, predict.box_overlap_join(lhs, rhs).select("id", "r_id").collect())) == want


def test_boxes_in_time(spark):
    rng = random.Random(3)
    (left, ls), (right, rs) = boxes(rng, 200, ""), boxes(rng, 200, "r_")
    lt, rt = windows(rng, 200), windows(rng, 200)
    lhs = spark.createDataFrame([(*b, *w[1:3]) for b, w in zip(left, lt)], f"{ls}, start timestamp, end timestamp")
    rhs = spark.createDataFrame([(*b, *w[1:3]) for b, w in zip(right, rt)], f"{rs}, r_start timestamp, r_end timestamp")
    want = sorted((a[0], b[0]) for a in left for b in right if box_meets(a, b) and meets(*lt[a[0]][1:3], *rt[b[0]][1:3]))
    assert sorted(map(tuple, predict.box_overlap_join(lhs, rhs, times=True).select("id", "r_id").collect())) == want


def test_no_key_gathers_the_rows(spark):
    """Windows of mixed lengths, some of them open: no key holds a hundredth of the rows."""
    rng = random.Random(4)
    lhs = spark.createDataFrame(windows(rng, 4000), TIMES)
    rhs = spark.createDataFrame(windows(rng, 4000), R_TIMES).drop("k")
    axes = ((predict.WINDOW,),)
    in_use = overlap.cells_in_use(lhs, rhs, axes)
    for side, df in (("l", lhs), ("r", rhs)):
        rows = overlap.listed(df, in_use, axes, side)
        total, most = rows.groupBy("_level0", "_cell0").count().agg(F.sum("count"), F.max("count")).first()
        assert most < total / 100


def test_short_windows_are_listed_seldom(spark):
    """A window touches two cells of its own level; long partners add a level each."""
    lhs = spark.createDataFrame([(i, T0 + dt.timedelta(hours=i), T0 + dt.timedelta(hours=i, minutes=5), 0) for i in range(500)], TIMES)
    rhs = spark.createDataFrame([(0, T0, T0 + dt.timedelta(days=20), 0), (1, T0, T0 + dt.timedelta(minutes=7), 0)], R_TIMES)
    axes = ((predict.WINDOW,),)
    in_use = overlap.cells_in_use(lhs, rhs, axes)
    assert overlap.listed(lhs, in_use, axes, "l").groupBy("id").count().agg(F.max("count")).first()[0] <= 6


@pytest.mark.parametrize("seed", [5, 6])
def test_counts_equal_the_pairs(spark, seed):
    rng = random.Random(seed)
    asked, there = windows(rng, 120), windows(rng, 400)
    asked += [(500, *asked[3][1:]), (501, *there[0][1:3], 0)]
    got = overlap_counts(spark.createDataFrame(asked, TIMES), spark.createDataFrame(there, TIMES))
    assert got.columns == ["id", "start", "end", "k", "n"]
    assert {r.id: r.n for r in got.collect()} == {x[0]: sum(meets(*x[1:3], *y[1:3]) for y in there) for x in asked}


def test_counts_make_no_pairs(spark):
    """Every window meets every other; the rows of the plan stay at a few for each."""
    n = 3000
    same = spark.range(n).select(F.lit(T0).alias("start"), F.lit(T0 + dt.timedelta(days=300)).alias("end"))
    got = overlap_counts(same, same)
    assert got.agg(F.min("n"), F.max("n"), F.count("*")).first() == (n, n, n)
    none = same.limit(0)
    assert overlap_counts(none, same).count() == 0
    assert overlap_counts(same.limit(2), none).agg(F.sum("n")).first()[0] == 0


def test_axis_of_numbers_alone(spark):
    lhs = spark.createDataFrame([(1, 0.0, 1.0), (2, 5.0, 5.0), (3, None, 2.0)], "id int, a double, b double")
    rhs = spark.createDataFrame([(1, 1.0, 5.0), (2, 6.0, 7.0)], "rid int, c double, d double")
    got = overlap_join(lhs, rhs, [[Axis("a", "b", "c", "d")]]).select("id", "rid").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1)]


@pytest.mark.parametrize("swapped", [False, True])
def test_the_smaller_side_waits_in_the_lanes(spark, swapped):
    """A row of the larger side goes through the shuffle once per cell, whichever side it is on."""
    many = [(i, T0 + dt.timedelta(hours=i), T0 + dt.timedelta(hours=i, minutes=5), 0) for i in range(400)]
    few = many[:40]
    left, right = (many, few) if swapped else (few, many)
    lhs, rhs = spark.createDataFrame(left, TIMES), spark.createDataFrame(right, R_TIMES).drop("k")
    axes = ((predict.WINDOW,),)
    in_use = overlap.cells_in_use(lhs, rhs, axes)
    for side, df, large in (("l", lhs, swapped), ("r", rhs, not swapped)):
        rows = overlap._laned(df, in_use, axes, side, F.lit(0)).count()
        assert rows == overlap.listed(df, in_use, axes, side).count() * (1 if large else overlap.LANES)
    assert predict.interval_overlap_join(lhs, rhs).count() == 40


def test_pair_counts_equal_the_pairs(spark, monkeypatch):
    """Counts by group equal those of the joined pairs, with cells cut into pieces, and make no pair."""
    rng = random.Random(5)
    left, right = [], []
    for i in range(160):
        a = T0 + dt.timedelta(minutes=rng.choice((0, 7, rng.randint(0, 40_000))))
        x, y, size = rng.uniform(-180, 180), rng.uniform(-80, 80), rng.choice((0.0, 0.01, 3.0, 40.0))
        box = (x, x + size, y, y + size) if i % 9 else rng.choice([(x, None, y, y), (x + 1, x, y, y + 2), (-180.0, 180.0, -90.0, 90.0)])
        start, end = rng.choice([(a, a + dt.timedelta(minutes=rng.choice((0, 90, 1500))))] * 9 + [(None, a), (a, None)])
        left.append((i // 2, start, end, *box))
        right.append((rng.choice(("a", "b", None)), start, end, *box))
    kind = "start timestamp, end timestamp, min_lon double, max_lon double, min_lat double, max_lat double"
    lhs = spark.createDataFrame(left, "fp_id long, " + kind)
    rhs = spark.createDataFrame(right, "source string, " + ", ".join("r_" + c for c in kind.split(", ")))
    spaces = ((predict.WINDOW,), predict.BOX)
    want = overlap_join(lhs, rhs, spaces).groupBy("fp_id", "source").count()
    want = {(r[0], r[1]): r[2] for r in want.collect()}
    for rows in (20_000, 20):
        monkeypatch.setattr(overlap, "GROUP_ROWS", rows)
        parts = overlap.overlap_pair_counts(lhs, rhs, spaces, "fp_id", "source")
        got = {(r[0], r[1]): r[2] for r in parts.groupBy("fp_id", "source").agg(F.sum("n")).collect()}
        assert got == want


def test_verdict_takes_counts_for_windows(spark):
    """A verdict sums the numbers of windows instead of counting rows."""
    sources = spark.createDataFrame([("s", "catalog-precise", False), ("t", "catalog-precise", False)], "source_type string, bucket string, listing_failed boolean")
    found = spark.createDataFrame([("s", 1, 5), ("s", 1, 2), ("s", 4, 1)], "source_type string, fp_id long, n_windows long")
    rows = predict.verdict(sources, found, spark.createDataFrame([(9,)], "n long")).orderBy("source_type").collect()
    assert [tuple(r) for r in rows] == [("s", "catalog-precise", "collocated", 2, 8), ("t", "catalog-precise", "none-predicted", 0, 0)]
