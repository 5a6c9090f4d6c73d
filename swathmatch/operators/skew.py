"""Equi-joins that stay balanced when one key holds a large share of the rows.

The salt spreads a hot key before the shuffle; AQE's skew join, switched on in
``session.tune``, cuts what is still too large by the measured partition sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lanes a hot key is spread over before AQE looks at partition sizes.
LANES = 4


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str],
                how: str = "inner", salts: int | None = LANES) -> DataFrame:
    """Join where a key may hold a large share of *big*.

    Each row of *big* draws one of *salts* lanes and *small* is repeated in all
    of them, so a key holding a third of *big* spreads over *salts* tasks and
    every pair of rows still meets exactly once.  With ``None`` there are as many
    lanes as shuffle partitions: for a *small* of a few rows, whose few keys would
    otherwise be all the tasks there are.  The lane depends on the row and on the
    partition it comes from, so equal rows spread too.  Spark broadcasts *small* by
    itself where its measured size allows.
    """
    if salts is None:
        salts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    lane = F.pmod(F.xxhash64(*big.columns, F.spark_partition_id()), F.lit(salts))
    lhs = big.withColumn("_lane", lane.cast("int"))
    rhs = small.withColumn("_lane", lanes)
    return lhs.join(rhs, [*keys, "_lane"], how).drop("_lane")


def attach_single(df: DataFrame, single: DataFrame) -> DataFrame:
    """Add the columns of a table with exactly one row, without a shuffle.

    *single* comes from an aggregation without groups (``df.agg(...)``), so one
    row is what it has by construction, and it may be broadcast.
    """
    one = F.broadcast(single.withColumn("_one", F.lit(0)))
    return df.withColumn("_one", F.lit(0)).join(one, "_one").drop("_one")
