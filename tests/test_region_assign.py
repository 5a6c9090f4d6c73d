"""Regions of requests: equal boxes are judged once, ties go to the first listed."""

import random

from swathmatch.operators import reshape

REQUESTS = "request_id long, min_lon double, max_lon double, min_lat double, max_lat double"
REGIONS = "region string, region_order long, min_lon double, max_lon double, min_lat double, max_lat double"


def _tables(spark):
    rng = random.Random(11)
    spots = [(x, x + 30.0, y, y + 10.0) for x in (-180.0, -20.0, 55.5) for y in (-40.0, 3.0)]
    requests = [(i, *spots[i % len(spots)]) for i in range(60)]
    regions = []
    for i in range(80):
        w, s, r = rng.choice((-185.0, -30.0, 0.0, 60.0)), rng.choice((-50.0, -5.0, 5.0)), rng.choice((4.0, 9.0, 25.0))
        regions.append((f"R{80 - i}", i, w, w + r, s, s + r))
    return requests, regions, spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(regions, REGIONS)


def test_regions_against_all_pairs(spark):
    requests, regions, rq, rg = _tables(spark)
    largest, centre = {}, {}
    for i, w, e, s, n in requests:
        sized = [(-(min(e, b) - max(w, a)) * (min(n, d) - max(s, c)), order, name) for name, order, a, b, c, d in regions
                 if min(e, b) > max(w, a) and min(n, d) > max(s, c)]
        held = [(order, name) for name, order, a, b, c, d in regions if a <= (w + e) / 2 <= b and c <= (s + n) / 2 <= d]
        if sized:
            largest[i] = (min(sized)[2], -min(sized)[0])
        if held:
            centre[i] = min(held)[1]
    assert {r.request_id: (r.region, r.area) for r in reshape.largest_overlap(rq, rg).collect()} == largest
    assert {r.request_id: r.region for r in reshape.centre_region(rq, rg).collect()} == centre


def test_equal_boxes_are_judged_once(spark, monkeypatch):
    _, _, rq, rg = _tables(spark)
    given, hits = [], reshape._tile_hits
    monkeypatch.setattr(reshape, "_tile_hits", lambda a, b, *more: given.append((a.count(), b.count())) or hits(a, b, *more))
    reshape.largest_overlap(rq, rg.unionByName(rg)).collect()
    reshape.centre_region(rq, rg.unionByName(rg)).collect()
    assert all(asked <= 6 and listed <= 36 for asked, listed in given)


def test_pairs_are_counted_without_sorting(spark):
    """Only rows of requests and regions are sorted, a name never goes through the pairs' sums."""
    _, _, rq, rg = _tables(spark)
    plan = reshape.centre_region(rq, rg)._jdf.queryExecution().executedPlan().toString()
    assert "min_by" not in plan
