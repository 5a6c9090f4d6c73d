"""Tables kept for many readers: files by month, rows by place.

A reader asks for a window and a box.  The window picks month folders, so other
months are never listed or opened; the box meets the row-group statistics of files
whose rows lie together on the ground, so most of a month is skipped too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swathmatch.functions.geo import split_antimeridian

MONTH = "month"
# rows without a time, which belong to no month
TIMELESS = "none"
# width of the squares whose rows are written together
SQUARE_DEG = 4.0


def _square(lon: str, lat: str) -> Column:
    """Squares numbered so that neighbours mostly have near numbers: the bits of row and
    column in turn (64 rows and 128 columns at most)."""
    y = F.floor((F.least(F.greatest(F.col(lat), F.lit(-90.0)), F.lit(90.0)) + 90.0) / SQUARE_DEG).cast("int")
    x = F.floor(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) / SQUARE_DEG).cast("int")
    number = F.lit(0)
    for bit in range(7):
        for part, shift in ((x, 0), (y, 1)):
            number = number + F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1)), 2 * bit + shift)
    return F.coalesce(number, F.lit(-1))


def write_store(df: DataFrame, path: str, time: str = "time", lon: str = "lon", lat: str = "lat", parts: Sequence[str] = ()) -> None:
    """Write *df* by *parts* and month of *time*, rows sorted by place within a file.

    Folders that *df* has rows for are replaced, all others stay.  A month holding most
    rows is spread over as many files as the shuffle has partitions, each with squares
    of its own.  Rows without a time go to a folder of their own.
    """
    month = F.coalesce(F.date_format(F.col(time).cast("timestamp"), "yyyy-MM"), F.lit(TIMELESS))
    rows = df.withColumn(MONTH, month).withColumn("_square", _square(lon, lat))
    order = [*parts, MONTH, "_square", lon, lat]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_square").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*parts, MONTH).parquet(path)


def read_store(spark: SparkSession, path: str, start: str, end: str, box: Sequence[float] | None = None, time: str = "time",
               lon: str = "lon", lat: str = "lat", timeless: bool = False) -> DataFrame:
    """Rows of a store with *time* from *start* to *end* (included) and a place in *box*
    (min_lon, max_lon, min_lat, max_lat; min_lon > max_lon lies across the date line).

    With *timeless* also rows without a time.  All conditions reach the scan: months as
    folders, time and place as row-group statistics.
    """
    whole = spark.read.parquet(path)
    months = F.col(MONTH).between(start[:7], end[:7])
    when = F.col(time).between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end)))
    chosen = whole.filter((months & when) | ((F.col(MONTH) == TIMELESS) & F.col(time).isNull())) if timeless else whole.filter(months & when)
    if box is not None:
        west, east, south, north = box
        spans = [F.col(lon).between(w, e) for w, e in split_antimeridian(west, east)]
        chosen = chosen.filter(F.col(lat).between(south, north)).filter(spans[0] if len(spans) == 1 else spans[0] | spans[1])
    return chosen.drop(MONTH)
