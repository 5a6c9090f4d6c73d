"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on.  All are session-level, so a cluster's own
# static settings stay as they are.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # partials reach the reducers in pieces, so a split partition stays splittable
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # estimates of derived tables are far off: before a job starts only tables of
    # small files are broadcast, the rest by the size measured in the shuffle
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "20m",
    # inferring constraints over chains of renamed coordinates takes Catalyst
    # seconds per query; the joins filter missing keys themselves
    "spark.sql.constraintPropagation.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "swathmatch", cores: str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of *df* with a reliable checkpoint.

    The folder is the one the cluster names in ``spark.checkpoint.dir`` (or that
    the session has been given).  Without one this is an error: a folder that
    executors do not share would lose the checkpoint.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A new path for files which driver and executors share.

    Below ``spark.checkpoint.dir``; a session on one machine may do without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="swathmatch-")
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
