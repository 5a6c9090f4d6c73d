"""The store by month and place: what is read, and what is left unread."""

import datetime as dt
import glob

from swathmatch.sources.store import read_store, write_store

ROWS = "id long, time timestamp, lon double, lat double, v double"


def rows(n=4000):
    out = []
    for i in range(n):
        t = dt.datetime(2024, 1 + i % 6, 1 + i % 28, i % 24) if i % 50 else None
        out.append((i, t, -179.0 + (i * 37 % 3580) / 10, -80.0 + (i * 91 % 1600) / 10, float(i)))
    return out


def inside(r, start, end, box):
    west, east, south, north = box
    across = west <= r[2] <= east if west <= east else r[2] >= west or r[2] <= east
    return r[1] is not None and start <= r[1] <= end and across and south <= r[3] <= north


def files_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numFiles").value()


def test_window_and_box(spark, tmp_path):
    data = rows()
    write_store(spark.createDataFrame(data, ROWS), str(tmp_path / "s"))
    for box in ((-20.0, 40.0, 0.0, 60.0), (170.0, -170.0, -80.0, 80.0)):
        got = read_store(spark, str(tmp_path / "s"), "2024-02-03", "2024-04-09", box)
        want = [r[0] for r in data if inside(r, dt.datetime(2024, 2, 3), dt.datetime(2024, 4, 9), box)]
        assert sorted(r.id for r in got.collect()) == want and len(want) > 20
    assert got.columns == ["id", "time", "lon", "lat", "v"]


def test_rows_without_time_or_place(spark, tmp_path):
    data = [(1, None, 1.0, 1.0, 0.0), (2, dt.datetime(2024, 1, 5), None, 1.0, 0.0), (3, dt.datetime(2024, 1, 5), 1.0, 1.0, 0.0)]
    write_store(spark.createDataFrame(data, ROWS), str(tmp_path / "s"))
    whole = dict(start="2024-01-01", end="2024-12-31")
    assert {r.id for r in read_store(spark, str(tmp_path / "s"), **whole).collect()} == {2, 3}
    assert {r.id for r in read_store(spark, str(tmp_path / "s"), **whole, timeless=True).collect()} == {1, 2, 3}
    assert {r.id for r in read_store(spark, str(tmp_path / "s"), **whole, box=(0, 2, 0, 2), timeless=True).collect()} == {1, 3}


def test_other_months_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "s")
    write_store(spark.createDataFrame(rows(), ROWS), path)
    every = len(glob.glob(f"{path}/month=*/*.parquet"))
    april = len(glob.glob(f"{path}/month=2024-04/*.parquet"))
    assert 0 < april < every
    one = read_store(spark, path, "2024-04-01", "2024-04-20", (0.0, 30.0, 0.0, 30.0))
    assert files_read(one) == april
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert "month" in scan.partitionFilters().toString()
    assert all(c in scan.dataFilters().toString() for c in ("time", "lon", "lat"))


def test_rows_of_a_file_lie_together(spark, tmp_path):
    """A month over several files: each has its own part of the globe."""
    import pyarrow.parquet as pq
    path = str(tmp_path / "s")
    one_month = [(i, dt.datetime(2024, 5, 2), *r[2:]) for i, r in enumerate(rows())]
    # so few rows would otherwise go into one file
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_store(spark.createDataFrame(one_month, ROWS), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{path}/month=2024-05/*.parquet")
    assert len(files) > 1
    spans = [pq.read_table(f, columns=["lat"]).column("lat") for f in files]
    assert any(max(x.to_pylist()) - min(x.to_pylist()) < 150 for x in spans)


def test_a_part_written_again_replaces_itself_only(spark, tmp_path):
    path, df = str(tmp_path / "s"), spark.createDataFrame(rows(500), ROWS)
    for month, v in (("all", 1.0), ("march", 2.0)):
        part = df if month == "all" else df.filter("month(time) = 3")
        write_store(part.selectExpr("id", "time", "lon", "lat", f"{v}D AS v"), path)
    got = {r.id: r.v for r in read_store(spark, path, "2024-01-01", "2024-12-31").collect()}
    assert {v for i, v in got.items() if i % 6 == 2} == {2.0} and {v for i, v in got.items() if i % 6 != 2} == {1.0}
