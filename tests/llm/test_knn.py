import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from swathmatch.llm import knn
from swathmatch.llm.queries import QUERIES, SQL
from swathmatch.llm.shared import ship

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=10, every=100):
    ok = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    out = []
    seen = set()
    for i, v in ok:
        if i % every == 0 and i not in seen:
            seen.add(i)
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in ok if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def got(spark, rows, **more):
    ship(spark)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("clash")).withColumn("group", F.lit(1))
    return sorted(tuple(r) for r in knn.top_k(df, F.col("vec_id") % 100 == 0, **more).collect())


@pytest.mark.parametrize("together", [512, 2])
def test_equals_all_pairs(spark, monkeypatch, together):
    monkeypatch.setattr(knn, "PIVOTS", 24)
    monkeypatch.setattr(knn, "TOGETHER", together)
    monkeypatch.setattr(knn, "SLICE", 150)
    rng = np.random.default_rng(together)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=8)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(400)]  # a common vector, with queries among its copies
    rows += [(2000, None), (2100, [1.0, None]), (2200, [float("nan")] * 8), (2201, [float("inf")] * 8), (2300, []), (2301, [0.5]),
             (None, [1.0] * 8), (-100, [0.25] * 8), (2302, [3e9, -1.0]), (2400, [1e30, 2.0])]
    want = brute(rows)
    have = got(spark, rows)
    big = {2400}
    assert [r for r in have if r[0] not in big and r[3] < 2**63 - 1] == [r for r in want if r[0] not in big and abs(r[3]) < 2**63 - 1]
    assert len(have) == len(want)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, -1.0])]
    assert got(spark, rows) == [(0, 1, 1, 5 * 1024**2), (0, 2, 1, 5 * 1024**2), (0, 3, 2, -2 * 1024**2)]
    assert got(spark, rows[:1]) == [] and got(spark, []) == [] and got(spark, rows[1:]) == []


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = sorted(con.execute(SQL["op1_knn"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op1_knn"](spark, folder).collect()) == want and len(want) == 50
