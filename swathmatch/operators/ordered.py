"""Neighbours and runs along time that do not need a whole group in one task.

Every function cuts a group into chunks of time.  Inside a chunk a window does
the work; across chunks only one summary row per chunk is looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(ts: str) -> Column:
    """Whole microseconds of a timestamp column, the axis used for windows."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key.  Spark limits each task's groups to one row before
    the shuffle, so a key holding most of the rows does not gather in one task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def with_neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str],
                    axis: str, chunk: int) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>`` of the row before and after.

    *axis* is the BIGINT column *order* starts with; *chunk* its chunk width.
    """
    by, order = list(by), list(order)
    vals = F.struct(*[F.col(c) for c in cols])
    rows = df.withColumn("_chunk", F.floor(F.col(axis) / F.lit(chunk)).cast("bigint"))
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order)
    rows = (
        rows.withColumn("_prev", F.lag(vals).over(inside))
        .withColumn("_next", F.lead(vals).over(inside))
    )
    key = F.struct(*[F.col(c) for c in order])
    edges = rows.groupBy(*by, "_chunk").agg(
        F.min_by(vals, key).alias("_first"), F.max_by(vals, key).alias("_last")
    )
    across = Window.partitionBy(*by).orderBy("_chunk")
    edges = edges.select(
        *by, "_chunk",
        F.lag("_last").over(across).alias("_before"),
        F.lead("_first").over(across).alias("_after"),
    )
    return (
        rows.join(edges, [*by, "_chunk"])
        .withColumns({f"prev_{c}": F.coalesce("_prev", "_before")[c] for c in cols})
        .withColumns({f"next_{c}": F.coalesce("_next", "_after")[c] for c in cols})
        .drop("_chunk", "_prev", "_next", "_before", "_after")
    )


def run_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], starts: Column,
                axis: str, chunk: int, name: str = "run") -> DataFrame:
    """Number the runs of a group; *starts* is true on the first row of each."""
    by, order = list(by), list(order)
    rows = df.withColumn("_chunk", F.floor(F.col(axis) / F.lit(chunk)).cast("bigint")).withColumn(
        "_start", F.coalesce(starts, F.lit(False)).cast("int")
    )
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*by, "_chunk").agg(F.sum("_start").alias("_n")).select(
        *by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    return (
        rows.withColumn("_in", F.sum("_start").over(inside))
        .join(sums, [*by, "_chunk"])
        .withColumn(name, (F.col("_base") + F.col("_in")).cast("bigint"))
        .drop("_chunk", "_start", "_in", "_base")
    )


def next_valid(df: DataFrame, by: Sequence[str], axis: str, tie: str, cols: Sequence[str],
               tolerance: int, pieces: int = 16, platform: str | None = "platform_id") -> DataFrame:
    """Fill NULLs of *cols* from the next later valid reading.

    Strictly later on *axis* (BIGINT), the first valid one only, no further than
    *tolerance* away.  With a *platform* column only readings of the same platform
    count, and rows whose platform is NULL stay as they are; without one (``None``)
    the whole group does.  Readings of one time are reduced to one first.
    """
    by = [*by, *([platform] if platform and platform not in by else [])]
    width = max(1, tolerance // pieces)
    rows = df.withColumn("_chunk", F.floor(F.col(axis) / F.lit(width)).cast("bigint"))
    known = rows.filter(F.col(platform).isNotNull()) if platform else rows

    def reading(c: str) -> Column:
        # equal times: the row with the smallest tie column speaks
        return F.when(F.col(c).isNotNull(), F.struct(F.col(axis), F.col(tie), F.col(c).alias("v")))

    # one row for each time, however many readings it has
    times = known.groupBy(*by, "_chunk", axis).agg(*[F.min(reading(c)).alias(f"_r_{c}") for c in cols])
    firsts = times.groupBy(*by, "_chunk").agg(*[F.min(f"_r_{c}").alias(f"_f_{c}") for c in cols])
    later = Window.partitionBy(*by).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(*by, "_chunk", *[F.last(f"_f_{c}", ignorenulls=True).over(later).alias(f"_l_{c}") for c in cols])
    inside = Window.partitionBy(*by, "_chunk").orderBy(F.desc(axis)).rowsBetween(Window.unboundedPreceding, -1)
    for c in cols:
        times = times.withColumn(f"_n_{c}", F.min(f"_r_{c}").over(inside))
    nexts = times.join(firsts, [*by, "_chunk"]).select(
        *by, axis, *[F.coalesce(f"_n_{c}", f"_l_{c}").alias(f"_n_{c}") for c in cols])
    # a row without a platform meets no time and keeps what it has
    filled = rows.drop("_chunk").join(nexts, [*by, axis], "left")
    for c in cols:
        nxt = F.col(f"_n_{c}")
        filled = filled.withColumn(c, F.coalesce(F.col(c), F.when(nxt[axis] - F.col(axis) <= F.lit(tolerance), nxt["v"])))
    return filled.select(*df.columns)
