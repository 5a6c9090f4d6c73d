"""Exact top-k search by inner product: a Voronoi kNN join.

Pivots are rows of the data, so a query's scores with them bound its k-th best
score from below.  Queries and data fall into the cells of the pivots.  A cell of
queries is summed up by its centre, radius and least bound, a cell of data by its
radius; cells that cannot hold an answer for each other are ruled out by these
alone, and of the others only rows which may be an answer are sent to a group of
queries.  Each task solves one group of queries against one slice of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathmatch.llm.shared import settle

SCALE = 1024
# pivots (rows of the data), queries solved together, data rows in a slice
PIVOTS, TOGETHER, SLICE = 256, 512, 20_000


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v: floor(1024 x) of each component, packed; rows whose vector is NULL
    or holds a NULL or a component that is not finite are left out."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & ~bad & F.col("vec_id").isNotNull())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            packed, wide = [], []
            for x in frame["v"]:
                y = np.floor(SCALE * np.asarray(x, dtype=np.float64))
                wide.append(bool(len(y) and np.abs(y).max() >= 2**31))
                packed.append(y.astype("<f8" if wide[-1] else "<i4").tobytes())
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": packed, "wide": wide})

    return good.mapInPandas(run, "vec_id long, v binary, wide boolean")


def matrix(frame: pd.DataFrame, dim: int) -> np.ndarray:
    """The vectors of a frame, short ones filled up with zeros."""
    out = np.zeros((len(frame), dim))
    for i, (v, wide) in enumerate(zip(frame["v"], frame["wide"], strict=True)):
        x = np.frombuffer(v, "<f8" if wide else "<i4")
        out[i, : len(x)] = x
    return out


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, cut to the range of 64 bits."""
    if len(q) and len(x) and q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) < 2**53:
        return (q @ x.T).astype(np.int64)
    big = np.array([[int(c) for c in row] for row in q], dtype=object) @ np.array([[int(c) for c in row] for row in x], dtype=object).T
    return np.clip(big, -(2**63), 2**63 - 1).astype(np.int64)


@dataclass
class Cells:
    """What is known of the cells that hold queries; all of bounded size."""

    dim: int
    pivots: np.ndarray
    centre: np.ndarray  # of queries, a row for each cell
    radius: np.ndarray
    bound: np.ndarray  # least of the queries' lower bounds for their k-th best score
    groups: list[range]  # numbers of the query groups of a cell

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.argmin((self.pivots**2).sum(axis=1)[None, :] - 2 * (x @ self.pivots.T), axis=1)


def _slack(x: np.ndarray) -> np.ndarray:
    """Room for rounding: never rule out what may be equal."""
    return 1e-6 + 1e-9 * np.abs(x)


def _query_cells(queries: DataFrame, pivots: pd.DataFrame, dim: int, k: int) -> Cells:
    p = matrix(pivots, dim)
    cells = Cells(dim, p, np.zeros_like(p), np.zeros(len(p)), np.full(len(p), -np.inf), [range(0)] * len(p))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((len(p), dim)), np.zeros(len(p), dtype=np.int64)
        for frame in frames:
            x = matrix(frame, dim)
            np.add.at(total, c := cells.nearest(x), x)
            np.add.at(n, c, 1)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"cell": np.repeat(at, dim + 1), "axis": np.tile(np.arange(dim + 1), len(at)),
                            "s": np.concatenate([total[at], n[at, None]], axis=1).ravel()})

    counts = np.zeros(len(p))
    for r in queries.mapInPandas(sums, "cell int, axis int, s double").groupBy("cell", "axis").agg(F.sum("s").alias("s")).collect():
        if r["axis"] < dim:
            cells.centre[r["cell"], r["axis"]] = r["s"]
        else:
            counts[r["cell"]] = r["s"]
    cells.centre /= np.maximum(counts, 1)[:, None]

    def bounds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = matrix(frame, dim)
            c = cells.nearest(x)
            # one of the pivots may be the query itself
            best = np.sort(x @ p.T, axis=1)[:, -(k + 1)] if len(p) > k else np.full(len(x), -np.inf)
            yield pd.DataFrame({"cell": c, "radius": np.sqrt(((x - cells.centre[c]) ** 2).sum(axis=1)), "bound": best - _slack(best)})

    made = queries.mapInPandas(bounds, "cell int, radius double, bound double").groupBy("cell")
    start = 0
    for r in made.agg(F.max("radius").alias("radius"), F.min("bound").alias("bound")).orderBy("cell").collect():
        c = r["cell"]
        cells.radius[c], cells.bound[c] = r["radius"], r["bound"]
    # cells fill up groups of queries; a cell with too many is split into several
    room = 0
    for c in np.flatnonzero(counts).tolist():
        parts = int(-(-counts[c] // TOGETHER))
        if parts > 1 or counts[c] > room:
            cells.groups[c] = range(start, start + parts)
            start, room = start + parts, (TOGETHER - counts[c]) if parts == 1 else 0
        else:
            cells.groups[c] = range(start - 1, start)
            room -= counts[c]
    return cells


def _to_groups(cells: Cells, data_radius: np.ndarray):
    """Rows, each in every group of queries it may be an answer for."""
    used = np.array([c for c, g in enumerate(cells.groups) if len(g)], dtype=np.int64)
    m, rho, bound = cells.centre[used], cells.radius[used], cells.bound[used]
    length = np.sqrt((cells.pivots**2).sum(axis=1))
    most = m @ cells.pivots.T + np.sqrt((m**2).sum(axis=1))[:, None] * data_radius[None, :] + rho[:, None] * (length + data_radius)[None, :]
    open_ = most + _slack(most) >= bound[:, None]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = matrix(frame, cells.dim)
            score = x @ m.T + np.sqrt((x**2).sum(axis=1))[:, None] * rho[None, :]
            need = (score + _slack(score) >= bound[None, :]) & open_[:, cells.nearest(x)].T
            row, group = [], []
            for i, hits in enumerate(need):
                g = sorted({g for c in used[hits] for g in cells.groups[c]})
                row += [i] * len(g)
                group += g
            yield frame.iloc[row].assign(group=group)[["group", "vec_id", "v", "wide"]]

    return run


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the *k* rows with the highest inner product for
    each query (all, if there are fewer), ties to the smaller vec_id.

    Queries are the rows for which *is_query* (a condition on ``vec_id``) holds, one
    for each vec_id (of rows that share it, the one whose packed vector is lowest);
    candidates are all rows with another vec_id, repeated rows as often as they
    occur.  Components are floor(1024 x); a shorter vector counts as filled up with
    zeros.  NULL ids and vectors which are NULL, or hold NULL or a component that is
    not finite, take no part.  Scores beyond 64 bits are cut to that range.  Columns
    beside the two are not read.
    """
    out = "query_id long, vec_id long, score long"
    data = settle(integer_vectors(rows, id_col, vector_col))
    found = data.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "wide")).alias("q")).select("vec_id", "q.*")
    queries = settle(found)
    size = F.floor(F.length("v") / F.when(F.col("wide"), 8).otherwise(4))
    dim = data.agg(F.max(size)).first()[0]
    drawn = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(2 * PIVOTS).toPandas().drop_duplicates("vec_id").head(PIVOTS)
    if not len(drawn) or queries.isEmpty():
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cells = _query_cells(queries, drawn, dim, k)

    def radii(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        far = np.full(len(cells.pivots), -1.0)
        for frame in frames:
            x = matrix(frame, dim)
            c = cells.nearest(x)
            np.maximum.at(far, c, np.sqrt(((x - cells.pivots[c]) ** 2).sum(axis=1)))
        at = np.flatnonzero(far >= 0)
        yield pd.DataFrame({"cell": at, "radius": far[at]})

    data_radius = np.zeros(len(cells.pivots))
    for r in data.mapInPandas(radii, "cell int, radius double").groupBy("cell").agg(F.max("radius").alias("radius")).collect():
        data_radius[r["cell"]] = r["radius"]
    sent = settle(data.mapInPandas(_to_groups(cells, data_radius), "group int, vec_id long, v binary, wide boolean"))
    slices = sent.groupBy("group").agg(F.ceil(F.count("*") / SLICE).alias("slices"))

    def grouped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            group = [g[i % len(g)] for g, i in zip((cells.groups[c] for c in cells.nearest(matrix(frame, dim))),
                                                   frame["vec_id"] // 100, strict=True)]
            yield frame.assign(group=group)[["group", "vec_id", "v", "wide"]]

    asked = queries.mapInPandas(grouped, "group int, vec_id long, v binary, wide boolean").join(slices, "group")
    asked = asked.select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "vec_id", "v", "wide")
    sliced = sent.join(slices, "group").withColumn("slice", F.pmod(F.xxhash64("vec_id", "v"), F.col("slices"))).drop("slices")

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        scores = exact_scores(matrix(q, dim), matrix(x, dim))
        ids, parts = x["vec_id"].to_numpy(), []
        for own, s in zip(q["vec_id"], scores, strict=True):
            other = np.flatnonzero(ids != own)
            at = other[_best(ids[other], s[other], k)]
            parts.append(pd.DataFrame({"query_id": own, "vec_id": ids[at], "score": s[at]}))
        return pd.concat(parts)

    solved = asked.groupBy("group", "slice").cogroup(sliced.groupBy("group", "slice")).applyInPandas(solve, out)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return solved.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
