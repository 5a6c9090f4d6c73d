"""Scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swathmatch import constants as K
from swathmatch.functions.decode import to_null
from swathmatch.functions.geo import as_col

OBS_LONG = T.StructType([
    T.StructField("platform_id", T.StringType()), T.StructField("platform_type", T.StringType()),
    T.StructField("time", T.TimestampType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("depth", T.DoubleType()),
    T.StructField("variable", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("value_qc", T.IntegerType()), T.StructField("institution", T.StringType()),
])
REQUIRED = ("lon", "lat", "time")


def canonical_obs(df: DataFrame) -> DataFrame:
    """Canonical names, ids as text, NaN as NULL; position and time are required."""
    df = df.withColumnsRenamed({"longitude": "lon", "latitude": "lat"})
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"required column(s) {missing} not found; available: {df.columns}")
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    out = df.withColumns({c: to_null(F.col(c).cast("double")) for c in doubles})
    if "platform_id" in df.columns:
        out = out.withColumn("platform_id", F.col("platform_id").cast("string"))
    return out


def scan_obs_long(spark: SparkSession, path: str, schema: T.StructType = OBS_LONG) -> DataFrame:
    """Long CSV with a declared schema, so an id never turns into a number."""
    return canonical_obs(spark.read.option("header", True).schema(schema).csv(path))


def scan_grid_cells(scenes: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row of 2-D arrays per scene to one row per cell.

    *scenes*: ``scene, time, lon, lat, <variables>``, every grid an
    ``ARRAY<ARRAY<DOUBLE>>`` of the same shape.
    """
    grids = ["lon", "lat", *variables]
    rows = scenes.select("scene", "time", F.posexplode(F.arrays_zip(*grids)).alias("y", "r"))
    cells = rows.select("scene", "time", "y",
                        F.posexplode(F.arrays_zip(*[F.col(f"r.{g}").alias(g) for g in grids])).alias("x", "c"))
    return cells.select("scene", "y", "x", "time", *[to_null(F.col(f"c.{g}")).alias(g) for g in grids])


def regular_grid_axes(i, j, ny: int, nx: int) -> tuple[Column, Column]:
    """S3: (lat, lon) of cell centres from row and column numbers."""
    return (F.lit(90.0) - (as_col(i) + 0.5) * F.lit(180.0 / ny),
            F.lit(-180.0) + (as_col(j) + 0.5) * F.lit(360.0 / nx))


def mesh_axes(values: DataFrame, lats: DataFrame, lons: DataFrame) -> DataFrame:
    """Positions of grid values from two axis tables, joined by index.

    *values* carry ``lat_idx, lon_idx``; the axis tables ``lat_idx, lat`` and
    ``lon_idx, lon``.  Only existing values get a row, no mesh is spanned.
    """
    from swathmatch.operators.skew import salted_join

    return salted_join(salted_join(values, lats, ["lat_idx"]), lons, ["lon_idx"])


def parse_index_lines(lines: DataFrame, n_fields: int = 8) -> DataFrame:
    """Platform index lines (column ``value``) to rows.

    Comment lines, lines of the wrong width and unreadable numbers or times drop
    out.  Fields: file name, lat min/max, lon min/max, first and last time,
    institution, parameters (blank separated; optional beyond *n_fields*).
    """
    parts = F.split("value", ",")
    rows = lines.filter(~F.col("value").startswith("#")).select(parts.alias("p")).filter(
        F.size("p") == n_fields + 1)

    def text(i: int) -> Column:
        return F.trim(F.col("p")[i])

    def stamp(i: int) -> Column:
        return F.try_to_timestamp(F.regexp_replace(text(i), "Z+$", ""))

    out = rows.select(
        text(0).alias("file_name"),
        *[text(i).try_cast("double").alias(n) for i, n in enumerate(("lat_min", "lat_max", "lon_min", "lon_max"), 1)],
        stamp(5).alias("time_start"), stamp(6).alias("time_end"), text(7).alias("institution"),
        F.array_remove(F.split(text(8), r"\s+"), "").alias("parameters"),
    )
    return out.dropna(subset=["lat_min", "lat_max", "lon_min", "lon_max", "time_start", "time_end"])


def scan_index(spark: SparkSession, path: str) -> DataFrame:
    """The index file(s) at *path*."""
    return parse_index_lines(spark.read.text(path))


def station_index(files: DataFrame) -> DataFrame:
    """One row per station directory from the first line of one of its files.

    *files*: ``path, first_line``.  An unreadable line leaves the position NULL,
    the station itself stays.
    """
    prefix = F.regexp_extract("path", r"^(.*/)[^/]*$", 1)
    parts = F.split(F.regexp_replace(prefix, "(^/+)|(/+$)", ""), "/")
    tokens = F.split(F.trim("first_line"), r"\s+")
    named = files.select(
        prefix.alias("dir_prefix"), "path",
        F.element_at(parts, 1).alias("network"),
        F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise("unknown").alias("station"),
        F.try_element_at(tokens, F.lit(4)).try_cast("double").alias("lat"),
        F.try_element_at(tokens, F.lit(5)).try_cast("double").alias("lon"),
    )
    both = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    first = F.min_by(F.struct("network", "station", F.when(both, F.col("lat")).alias("lat"),
                              F.when(both, F.col("lon")).alias("lon")), "path")
    return named.groupBy("dir_prefix").agg(first.alias("s")).select("dir_prefix", "s.*")


def station_files(spark: SparkSession, path: str) -> DataFrame:
    """Station files as rows of ``path, line``; a long record never has to fit one cell."""
    return spark.read.text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def line_time(line) -> Column:
    """Time of a data line ``YYYY/MM/DD HH:MM value flags``; NULL when it is none."""
    stamp = F.regexp_extract(as_col(line), r"^\s*(\d{4}/\d{2}/\d{2})\s+(\d{2}:\d{2})(\s|$)", 0)
    return F.try_to_timestamp(F.regexp_replace(F.trim(stamp), r"\s+", " "), F.lit("yyyy/MM/dd HH:mm"))


def station_date_ranges(lines: DataFrame) -> DataFrame:
    """Earliest and latest readable time per station directory."""
    timed = lines.select(F.regexp_extract("path", r"^(.*/)[^/]*$", 1).alias("dir_prefix"), line_time("line").alias("t"))
    return timed.filter(F.col("t").isNotNull()).groupBy("dir_prefix").agg(
        F.min("t").alias("first_time"), F.max("t").alias("last_time"))


def platform_ranges(obs: DataFrame) -> DataFrame:
    """Per platform the first position and the time span."""
    return obs.groupBy("platform_id").agg(
        F.min_by("lat", "obs_id").alias("lat"), F.min_by("lon", "obs_id").alias("lon"),
        F.min("time").alias("first_time"), F.max("time").alias("last_time"))


def read_field_map(spark: SparkSession, path: str) -> DataFrame:
    """A map written by ``sinks.sink_field_map``."""
    return spark.read.schema("n bigint, knots array<struct<qs:double,qv:double>>").parquet(path)


def read_partition_window(df: DataFrame, start: str, end: str, min_lon: float, max_lon: float,
                          min_lat: float, max_lat: float, min_depth: float, max_depth: float) -> DataFrame:
    """The time window first, then box and depth; all reach the Parquet scan."""
    t0, t1 = F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))
    out = df.filter(F.col("time").between(t0, t1)).filter(
        F.col("lon").between(min_lon, max_lon) & F.col("lat").between(min_lat, max_lat))
    return out.filter(F.col("depth").between(min_depth, max_depth)) if "depth" in df.columns else out


def union_segments(parts: Sequence[DataFrame]) -> DataFrame:
    """Files of one model pooled; order is a matter of the window that needs it."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def granule_listing(df: DataFrame, name: str, resolution: str, start: str, end: str,
                    end_exclusive: bool = False) -> DataFrame:
    """Listed files of a resolution within a window, names of either era."""
    c = F.col(name)

    def old(i: int) -> Column:
        return F.regexp_extract(c, K.RADAR_NAME_OLD, i)

    def new(i: int) -> Column:
        return F.regexp_extract(c, K.RADAR_NAME_NEW, i)

    is_old = old(1) != ""
    out = df.withColumns({
        "g_resolution": F.when(is_old, old(2)).otherwise(new(1)),
        "g_time": F.try_to_timestamp(F.when(is_old, old(1)).otherwise(F.substring(new(2), 1, 12)),
                                     F.lit("yyyyMMddHHmm")),
    })
    hi = F.to_timestamp(F.lit(end))
    return out.filter(
        (F.col("g_resolution") == resolution) & (F.col("g_time") >= F.to_timestamp(F.lit(start)))
        & ((F.col("g_time") < hi) if end_exclusive else (F.col("g_time") <= hi)))
