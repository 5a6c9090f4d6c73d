"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathmatch.operators.skew import attach_single, salted_join

BINS = 16_384


def _stretched(v: Column) -> Column:
    """A scale on which values of every magnitude have room: one fill value of 1e36
    does not push all others into one bin.  Never falls where the value rises."""
    return F.signum(v) * F.log1p(F.abs(v))


def value_bins(df: DataFrame, by: Sequence[str], value: str, bins: int = BINS) -> tuple[DataFrame, DataFrame]:
    """``(by, _bin, _v, _c)``: distinct values of each group with their counts and bin;
    ``(by, n, _lo, _hi)``: the groups.  Bins rise with the value."""
    by = list(by)
    # equal values become one row before anything is joined
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    groups = counted.groupBy(*by).agg(F.sum("_c").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ends = groups.select(*by, "_lo", "_hi")
    known = salted_join(counted, ends, by, salts=None) if by else attach_single(counted, ends)
    width = (_stretched(F.col("_hi")) - _stretched(F.col("_lo"))) / bins
    place = F.floor((_stretched(F.col("_v")) - _stretched(F.col("_lo"))) / F.nullif(width, F.lit(0.0)))
    binned = known.withColumn("_bin", F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int")).drop("_lo", "_hi")
    return binned, groups


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs, bins: int = BINS) -> DataFrame:
    """Linearly interpolated quantiles per group, as an array column ``q``.

    *probs* is a list of numbers, the name of an ``ARRAY<DOUBLE>`` column which is
    constant within a group, or such an array made from the columns of *by* and ``n``.
    Also returns ``n``, the rows used.

    Spark's own exact percentile gathers all distinct values of a group in one
    task.  Here a group is cut into *bins* (see ``value_bins``); counting them tells
    in which bin each wanted rank lies, and only the values of those few bins are
    ordered, one bin per task.
    """
    by = list(by)
    if not by:
        everything = df.withColumn("_all", F.lit(0))
        return exact_quantiles(everything, ["_all"], value, probs, bins).drop("_all")
    wanted = probs if isinstance(probs, str) else None
    binned, stats = value_bins(df, by, value, bins)
    if isinstance(probs, Column):
        stats = stats.withColumn("_probs", probs)
    elif wanted:
        stats = stats.join(df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.first(wanted).alias("_probs")), by)
    else:
        stats = stats.withColumn("_probs", F.array(*[F.lit(float(p)) for p in probs]))

    # ranks below and above each quantile
    ranks = stats.select(
        *by, F.posexplode(F.transform("_probs", lambda p: p * (F.col("n") - 1))).alias("_i", "_pos"),
    ).select(
        *by, "_i", "_pos",
        F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))).alias("_rank"),
    )
    upto_bin = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    counts = binned.groupBy(*by, "_bin").agg(F.sum("_c").alias("_c")).withColumn(
        "_end", F.sum("_c").over(upto_bin)
    ).withColumn("_begin", F.col("_end") - F.col("_c"))
    inside = (F.col("_rank") >= F.col("_begin")) & (F.col("_rank") < F.col("_end"))
    targets = ranks.join(counts.select(*by, "_bin", "_begin", "_end"), by).filter(inside)

    needed = targets.select(*by, "_bin", "_begin").distinct()
    upto_value = Window.partitionBy(*by, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    values = binned.join(needed, [*by, "_bin"]).withColumn(
        "_end", F.col("_begin") + F.sum("_c").over(upto_value)
    ).withColumn("_begin", F.col("_end") - F.col("_c"))
    picked = targets.drop("_begin", "_end").join(
        values.select(*by, "_bin", "_v", "_begin", "_end"), [*by, "_bin"]
    ).filter(inside)
    one = picked.groupBy(*by, "_i").agg(
        F.min_by("_v", "_rank").alias("_a"), F.max_by("_v", "_rank").alias("_b"),
        F.first(F.col("_pos") - F.floor("_pos")).alias("_f"),
    ).withColumn("_q", F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f"))
    arrays = one.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"]).alias("q")
    )
    return arrays.join(stats.select(*by, "n"), by)


def several_quantiles(df: DataFrame, by: Sequence[str], wanted: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """One row per group: for each name in *wanted* the quantile of a column.

    All columns go through one pass: each row gives a value for every column, and equal
    values of a column are counted before anything is shuffled.  NULLs do not count; a
    group without a value for a name has NULL there, one without any value has no row.
    """
    by = list(by)
    sides = F.array(*[F.struct(F.lit(i).alias("side"), c.cast("double").alias("x")) for i, (c, _) in enumerate(wanted.values())])
    rows = df.select(*by, F.explode(sides).alias("_p")).select(*by, F.col("_p.side").alias("_side"), F.col("_p.x").alias("_x")).filter("_x IS NOT NULL")
    prob = F.element_at(F.array(*[F.lit(float(p)) for _, p in wanted.values()]), F.col("_side") + 1)
    q = exact_quantiles(rows, [*by, "_side"], "_x", F.array(prob))
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("_side") == i, F.col("q")[0])).alias(name) for i, name in enumerate(wanted)])
