"""The tables behind every figure of a report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathmatch import constants as K
from swathmatch.functions.geo import circular_diff_deg
from swathmatch.operators import stats
from swathmatch.operators.predict import category
from swathmatch.operators.quantiles import exact_quantiles, several_quantiles
from swathmatch.operators.skew import attach_single, salted_join

OBSERVATION = ("val_source", "val_id", "val_time", "val_lat", "val_lon")


def residual(sar: str, val: str) -> Column:
    """Plain or wrapped difference, by the observation variable."""
    if val.removeprefix("val_") in K.CIRCULAR_VAL_VARS:
        return circular_diff_deg(sar, val)
    return F.col(sar) - F.col(val)


def dedupe_observations(pairs: DataFrame, sar: str, val: str, others: Sequence[str] = ()) -> DataFrame:
    """One row per observation: scene values averaged, the rest from its first row.

    Missing parts of the identity are equal to each other.  First is the row with
    the least observed value, then the least of *others* in their order, so all
    columns come from one row.
    """
    ids = [c for c in OBSERVATION if c in pairs.columns]
    rest = [val, *[c for c in others if c != val]]
    groups = pairs.filter(F.col(sar).isNotNull() & F.col(val).isNotNull()).groupBy(*ids)
    if len(rest) == 1:
        return groups.agg(F.avg(sar).alias(sar), F.min(val).alias(val), F.count("*").alias("n_pixels"))
    rows = groups.agg(F.avg(sar).alias(sar), F.count("*").alias("n_pixels"), F.min(F.struct(*rest)).alias("_first"))
    return rows.select(*ids, sar, F.col(f"_first.{val}").alias(val), "n_pixels", *[F.col(f"_first.{c}").alias(c) for c in rest[1:]])


def scatter_annotations(pairs: DataFrame, sar: str, val: str) -> DataFrame:
    """N, bias, rmse and correlation over de-duplicated observations."""
    obs = dedupe_observations(pairs, sar, val)
    rows = obs.withColumn("everything", F.lit("all"))
    run = stats.circular_metrics if val.removeprefix("val_") in K.CIRCULAR_VAL_VARS else stats.linear_metrics
    m = run(rows, sar, val, ["everything"])
    d = residual(sar, val)
    plain = rows.groupBy("everything").agg(F.avg(d).alias("mean_diff"), F.sum("n_pixels").alias("n_raw"))
    # the figure shows the plain mean of the wrapped differences
    return m.join(plain, m.source == plain.everything).select(
        "N", F.col("mean_diff").alias("bias"), "rmse", "correlation", "n_raw")


def imbalance_share(pairs: DataFrame, force: bool = False) -> DataFrame:
    """Largest share a source has, and whether the figure splits."""
    counts = pairs.groupBy("val_source").count()
    return counts.groupBy().agg(
        F.count("*").alias("n_sources"), (F.max("count") / F.sum("count")).alias("share")
    ).select("n_sources", F.when(F.col("n_sources") >= 2, F.col("share")).otherwise(0.0).alias("share"),
             ((F.col("n_sources") >= 2) & ((F.col("share") > K.IMBALANCE_SHARE) | F.lit(force))).alias("split"))


def scatter_groups(pairs: DataFrame, sar: str, val: str, by: Sequence[str] = ("val_source",)) -> DataFrame:
    """T4: groups of a scatter figure with their size and value range."""
    lo, hi = F.least(F.min(sar), F.min(val)), F.greatest(F.max(sar), F.max(val))
    return pairs.groupBy(*by).agg(F.count("*").alias("n"), lo.alias("lo"), hi.alias("hi"))


def summary_table(metrics: DataFrame) -> DataFrame:
    """T5: source by bias, rmse, correlation, four decimals."""
    return metrics.select("source", *[F.round(c, 4).alias(c) for c in ("bias", "rmse", "correlation")])


def statistics_bars(metrics: DataFrame, names: Sequence[str] = ("bias", "rmse", "correlation")) -> DataFrame:
    """The metrics in long form."""
    return metrics.unpivot(["source"], list(names), "metric", "value")


def residual_histogram(pairs: DataFrame, sar: str, val: str, mode: str = "shared",
                       fixed: tuple[float, float] | None = None, bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """Density histogram of the differences per source.

    *mode* ``shared`` takes one range for all sources, ``source`` one each; with
    *fixed* that range is used and values outside it do not count.  An empty
    range is widened by half a unit both ways; the last bin is closed.
    """
    rows = pairs.filter(F.col(sar).isNotNull() & F.col(val).isNotNull()).select(
        "val_source", residual(sar, val).alias("r"))
    by = ["val_source"] if mode == "source" else []
    if fixed is not None:
        rows = rows.withColumns({"lo": F.lit(float(fixed[0])), "hi": F.lit(float(fixed[1]))})
    else:
        spans = rows.groupBy(*by).agg(F.min("r").alias("_a"), F.max("r").alias("_b"))
        flat = F.col("_a") == F.col("_b")
        spans = spans.select(*by, F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("lo"),
                             F.when(flat, F.col("_b") + 0.5).otherwise(F.col("_b")).alias("hi"))
        rows = salted_join(rows, spans, by, salts=None) if by else attach_single(rows, spans)
    width = (F.col("hi") - F.col("lo")) / bins
    hits = rows.filter(F.col("r").between(F.col("lo"), F.col("hi"))).withColumn(
        "bin", F.least(F.floor((F.col("r") - F.col("lo")) / width), F.lit(bins - 1)).cast("int"))
    counts = hits.groupBy("val_source", "bin", "lo", "hi").count()
    totals = counts.groupBy("val_source").agg(F.sum("count").alias("n"))
    return counts.join(totals, "val_source").select(
        "val_source", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"), F.col("count"),
        (F.col("count") / (F.col("n") * width)).alias("density"))


def difference_grid(pairs: DataFrame, sar: str, val: str) -> tuple[DataFrame, DataFrame]:
    """Mean difference in square cells per layer or model source.

    Returns ``(grid, scales)``.  A cell is twice the median aggregation radius
    wide, else the median pixel spacing; a source with neither has no grid.  The
    origin lies one cell below the lowest coordinate, longitudes across the date
    line are shifted, ``vmax`` is the 98th percentile of the absolute difference.
    """
    rows = pairs.filter(
        F.col(sar).isNotNull() & F.col(val).isNotNull() & F.col("sar_lat").isNotNull() & F.col("sar_lon").isNotNull()
        & F.col("collocation_type").isin("layer_vs_layer", "model_vs_layer")
    ).select("val_source", "sar_lon", "sar_lat", residual(sar, val).alias("diff"),
             "aggregation_window_km", "sar_pixel_spacing_km")

    middles = several_quantiles(rows, ["val_source"], {
        "_win": (F.when(F.col("aggregation_window_km") > 0, F.col("aggregation_window_km")), 0.5),
        "_px": (F.col("sar_pixel_spacing_km"), 0.5), "vmax": (F.abs("diff"), 0.98)})
    shifted = F.pmod(F.col("sar_lon"), F.lit(360.0)) - 180.0
    frame = rows.groupBy("val_source").agg(
        # an exact sum: the width of a cell must not depend on the order of the rows
        (F.sum(F.col("sar_lat").cast("decimal(20,15)")).cast("double") / F.count("sar_lat")).alias("mean_lat"),
        F.min("sar_lat").alias("lat0"), F.min("sar_lon").alias("_lon0"), F.min(shifted).alias("_slon0"),
        (F.max("sar_lon") - F.min("sar_lon") > 180.0).alias("wraps"))
    km = F.coalesce(2 * F.col("_win"), F.col("_px"), F.lit(0.0))
    scales = (
        frame.join(middles, "val_source")
        .withColumn("cell_km", km)
        .select("val_source", "cell_km", "wraps", "lat0",
                F.when(F.col("wraps"), F.col("_slon0")).otherwise(F.col("_lon0")).alias("lon0"),
                (F.col("cell_km") / K.KM_PER_DEG_GRID).alias("dlat"),
                (F.col("cell_km") / F.greatest(K.KM_PER_DEG_GRID * F.cos(F.radians("mean_lat")), F.lit(1e-6))).alias("dlon"),
                F.when(F.col("vmax") == 0, F.lit(1e-6)).otherwise(F.col("vmax")).alias("vmax"))
    )
    at = salted_join(rows.select("val_source", "sar_lon", "sar_lat", "diff"),
                     scales.filter("cell_km > 0").select("val_source", "wraps", "lat0", "lon0", "dlat", "dlon"),
                     ["val_source"], salts=None)
    lon = F.when(F.col("wraps"), shifted).otherwise(F.col("sar_lon"))
    grid = at.select(
        "val_source",
        F.floor((F.col("sar_lat") - (F.col("lat0") - F.col("dlat"))) / F.col("dlat")).cast("int").alias("row"),
        F.floor((lon - (F.col("lon0") - F.col("dlon"))) / F.col("dlon")).cast("int").alias("col"), "diff",
    ).groupBy("val_source", "row", "col").agg(F.avg("diff").alias("mean_diff"), F.count("*").alias("n"))
    return grid, scales.select("val_source", "cell_km", "wraps", "vmax")


def match_coverage(classified: DataFrame) -> DataFrame:
    """Matched and unmatched observations per category."""
    return classified.groupBy("category").agg(
        F.count_if("matched").alias("n_matched"), F.count_if(~F.col("matched")).alias("n_unmatched"))


def zoom_extent(parts: Sequence[DataFrame]) -> DataFrame:
    """Limits over everything drawn; each part has ``lon, lat``."""
    drawn = parts[0].select("lon", "lat")
    for p in parts[1:]:
        drawn = drawn.unionByName(p.select("lon", "lat"))
    return drawn.agg(F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
                     F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"))


def sensing_depths(nodes: DataFrame) -> DataFrame:
    """Sources by sensing depth and band, as one line each."""
    known = nodes.filter((F.col("sensing_depth_cm") != "") & (F.col("band") != "") & (F.col("source") != ""))
    return known.groupBy("sensing_depth_cm", "band").agg(
        F.concat(F.array_join(F.array_sort(F.collect_set("source")), "/"), F.lit(" ~"), F.col("sensing_depth_cm"),
                 F.lit("cm ("), F.col("band"), F.lit("-band)")).alias("line"))


def land_qa_table(qa: DataFrame) -> DataFrame:
    """Scenes with land cells."""
    return qa.filter(F.col("land_count") > 0)


def matched_scenes(pairs: DataFrame) -> DataFrame:
    """T13."""
    return pairs.select("sar_scene_name").filter(F.col("sar_scene_name").isNotNull()).distinct()


def colour_limits(field: DataFrame, observed: DataFrame, value: str, by: Sequence[str] = (),
                  separate: bool = False, circular: bool = False) -> DataFrame:
    """2nd and 98th percentile of field and observations, pooled or apart."""
    sides = field.select(*by, F.lit("field").alias("side"), F.col(value).alias("x")).unionByName(
        observed.select(*by, F.lit("observed").alias("side"), F.col(value).alias("x")))
    if not separate:
        sides = sides.withColumn("side", F.lit("pooled"))
    q = exact_quantiles(sides, [*by, "side"], "x", [0.02, 0.98])
    lo, hi = (F.lit(0.0), F.lit(360.0)) if circular else (F.col("q")[0], F.col("q")[1])
    flat = lo == hi
    return q.select(*by, "side", F.when(flat, lo - 0.5).otherwise(lo).alias("vmin"),
                    F.when(flat, hi + 0.5).otherwise(hi).alias("vmax"))


def density_class(pairs: DataFrame) -> DataFrame:
    """Matches per type and matched scene; above 300 the drawing is dense."""
    scenes = pairs.groupBy(F.lit(0).alias("_k")).agg(F.count_distinct("sar_scene_name").alias("n_scenes"))
    types = pairs.groupBy("collocation_type").agg(F.count("*").alias("n")).withColumn("_k", F.lit(0))
    per = F.col("n") / F.greatest(F.col("n_scenes"), F.lit(1))
    return types.join(scenes, "_k").select("collocation_type", "n", per.alias("per_scene"),
                                           (per > K.DENSE_MATCHES_PER_SCENE).alias("dense"))


def report_sections(pairs: DataFrame, sar: str, val: str, sar_units: str) -> dict[str, DataFrame]:
    """The row sets of a soil-moisture report."""
    family = stats.units_family(sar_units)
    native = [s for s, f in K.UNITS_FAMILY.items() if f == family]
    not_cds = F.col("val_source") != "cds_ssm"
    return {
        "matched": stats.rescaled_pairs(pairs.filter(not_cds), sar, val, sar_units),
        "native": pairs.filter(F.col("val_source").isin(*native) & not_cds),
        "cds": pairs.filter(~not_cds),
    }


# --- W4, W5 ------------------------------------------------------------------------------

def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """At most *n* points, always the same ones for a seed.

    Ordered by a hash and cut: a distributed top-n, no global sort.
    """
    lot = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(lot, key).limit(n)


def stride_decimate(cells: DataFrame, stride: int) -> DataFrame:
    """Every *stride*-th row and column, whatever the size of a scene."""
    return cells.filter((F.col("y") % stride == 0) & (F.col("x") % stride == 0))


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """Sorted output, at the sink only."""
    return df.orderBy(*cols)
