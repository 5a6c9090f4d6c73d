"""Pairs of soil moisture are many: they are not shuffled for the maps of their sources."""

import re

from swathmatch.operators import stats


def test_maps_come_to_the_pairs_without_a_shuffle(spark):
    rows = [(s, float(i), 2.0 * i + 1) for s in ("ismn", "smap_ssm") for i in range(60)] + [("ascat_ssm", 5.0, 7.0), (None, 1.0, 2.0), ("smos_ssm", 1.0, 2.0)]
    pairs = spark.createDataFrame(rows, "val_source string, sar_s double, val_v double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = stats.rescaled_pairs(pairs, "sar_s", "val_v", "%")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.search(r"hashpartitioning\(_map#\d+, _lane#", plan)
    assert out.columns == ["val_source", "sar_s", "val_v", "harmonized"]
    mapped = {r["val_source"]: r["sar_s"] for r in got if r["val_v"] in (7.0, 2.0) or r["val_source"] is None}
    # no map of its own, or no name: no value
    assert mapped["smos_ssm"] is None and mapped[None] is None
    assert all(abs(r["sar_s"] - r["val_v"]) < 1e-6 for r in got if r["val_source"] == "smap_ssm")
