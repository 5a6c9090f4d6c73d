"""Points in polygons and footprints: positions are judged once, pairs are made last."""

from pyspark.sql import functions as F

from swathmatch.operators import predict
from swathmatch.session import tune
from test_joins import shuffled_rows

RING = "array(named_struct('lat', 0D, 'lon', 0D), named_struct('lat', 4D, 'lon', 0D), named_struct('lat', 4D, 'lon', 4D), named_struct('lat', 0D, 'lon', 4D))"


def footprints(spark, n):
    return spark.range(n).selectExpr(
        "id AS fp_id", "'polygon' AS kind", f"CASE WHEN id = 0 THEN slice({RING}, 1, 2) ELSE {RING} END AS polygon",
        "CAST(NULL AS ARRAY<STRUCT<lat: DOUBLE, lon: DOUBLE>>) AS points", "0D AS min_lon", "4D AS max_lon", "0D AS min_lat", "4D AS max_lat",
        "timestamp'2026-01-01 00:00:00' AS sensing_start", "timestamp'2026-01-01 00:10:00' AS sensing_end")


def points(spark, n):
    return spark.range(n).select(F.col("id").alias("point_id"), F.when(F.col("id") % 2 == 0, F.lit(1.5)).otherwise(F.lit(9.0)).alias("lon"), F.lit(2.0).alias("lat"))


def test_pairs_of_point_and_shape_are_not_shuffled(spark):
    stations = points(spark, 400).select(
        F.col("point_id").alias("station_id"), "lon", "lat", F.expr("timestamp'2026-01-01 00:00:00'").alias("start"),
        F.expr("timestamp'2026-01-02 00:00:00'").alias("end"))
    found = predict.station_window_match(stations, footprints(spark, 101), 60, 60.0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    # half of the stations are inside the 100 rings, all of them in the one without a shape
    try:
        assert found.count() == 200 * 100 + 400
        assert shuffled_rows(spark, found) < 10_000
    finally:
        tune(spark)


def test_rings_below_three_vertices_match_all_points(spark):
    pts = points(spark, 10).unionByName(points(spark, 1).select(F.lit(10).cast("long").alias("point_id"), F.lit(None).cast("double").alias("lon"), "lat"))
    r = predict.point_in_footprint_join(pts, footprints(spark, 2), 60.0).collect()
    assert sorted((x.fp_id, x.point_id) for x in r) == [(0, i) for i in range(11)] + [(1, i) for i in range(0, 10, 2)]
    whole = predict.point_in_polygon_join(pts, footprints(spark, 2).select("fp_id", "polygon")).collect()
    assert sorted((x.fp_id, x.point_id) for x in whole) == [(0, i) for i in range(11)] + [(1, i) for i in range(0, 10, 2)]


def test_all_points_for_a_shape_are_dealt_to_several_tasks(spark):
    shapes = footprints(spark, 1).select("fp_id", "polygon")
    spread = predict.point_in_polygon_join(points(spark, 4000), shapes).withColumn("task", F.spark_partition_id())
    assert spread.select("task").distinct().count() > 1
