"""Helpers of the training-data operators: tables, written intermediates, streamed groups."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset and
    all runs on one machine (tests, a laptop) a local one is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        folder = "file://" + tempfile.mkdtemp(prefix="swathmatch-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write *df* to the shared folder and read it back.

    Cuts the lineage, so later steps survive lost executors, and keeps an
    expensive pass from running once for each of its readers.
    """
    path = scratch(df.sparkSession)
    for paths in _RECORDING:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_RECORDING: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Note in *paths* what ``settle`` writes meanwhile."""
    _RECORDING.append(paths)
    try:
        yield
    finally:
        _RECORDING.pop()


def forget(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables which nothing reads any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(col: str = "text") -> Column:
    """The text, or an empty one where there is none."""
    return F.coalesce(F.col(col), F.lit("")).alias(col)


def runs_of_keys(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames which hold whole groups only, from frames sorted by *keys*.

    A frame is passed on up to its last key; the rows of that key wait for the
    next frame, so no more than one frame and one group are held.
    """
    waiting: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = _same_as(frame, frame.iloc[-1], keys)
        first_of_last = len(frame) - int(np.argmin(last[::-1])) if not last.all() else 0
        if first_of_last:
            yield pd.concat([*waiting, frame.iloc[:first_of_last]], ignore_index=True) if waiting else frame.iloc[:first_of_last]
            waiting = [frame.iloc[first_of_last:]]
        elif waiting and not _same_as(waiting[0].iloc[:1], frame.iloc[-1], keys)[0]:
            yield pd.concat(waiting, ignore_index=True)
            waiting = [frame]
        else:
            waiting.append(frame)
    if waiting:
        yield pd.concat(waiting, ignore_index=True)


def _same_as(frame: pd.DataFrame, row: pd.Series, keys: list[str]) -> np.ndarray:
    same = np.ones(len(frame), dtype=bool)
    for k in keys:
        same &= (frame[k] == row[k]).to_numpy()
    return same


def group_bounds(frame: pd.DataFrame, keys: list[str]) -> list[tuple[int, int]]:
    """Start and end of each run of equal *keys*."""
    if not len(frame):
        return []
    new = np.zeros(len(frame), dtype=bool)
    new[0] = True
    for k in keys:
        v = frame[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    at = np.flatnonzero(new).tolist()
    return list(zip(at, [*at[1:], len(frame)], strict=True))


def ship(spark: SparkSession) -> SparkSession:
    """Make the session ready for operators that run Python: texts reach it in small
    batches, and the package is sent to the workers where their path does not hold it.

    A cluster job submitted with ``--py-files``, or an environment that names the
    folder in ``PYTHONPATH``, needs nothing; a session opened from a script that
    only changed its own ``sys.path`` does.
    """
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    root = Path(__file__).resolve().parents[2]
    on_path = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root not in on_path and sc.applicationId not in _SHIPPED:
        target = Path(tempfile.mkdtemp(prefix="swathmatch-package-")) / "swathmatch.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted((root / "swathmatch").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(target))
        _SHIPPED.add(sc.applicationId)
    return spark


_SHIPPED: set[str] = set()
# a batch is held several times over (Arrow, Python strings, results)
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
