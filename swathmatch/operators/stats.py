"""Agreement per group.

All groups are reduced by partial sums before the shuffle, so the share a group
has of the rows does not matter.  Missing values are NULL, never NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathmatch import constants as K
from swathmatch.functions.geo import circular_diff_deg
from swathmatch.operators.quantiles import exact_quantiles
from swathmatch.operators.skew import attach_single, salted_join


def group_key(by: Sequence[str]) -> Column:
    """A5: one label per group; moored and drifting buoys count as one family.

    Only in ``val_source``, and only for grouping: the rows keep their label.
    """
    def one(c: str) -> Column:
        if c != "val_source":
            return F.col(c).cast("string")
        folded = F.col(c)
        for name, family in K.GROUP_ALIASES.items():
            folded = F.when(F.col(c) == name, F.lit(family)).otherwise(folded)
        return folded

    return one(by[0]) if len(by) == 1 else F.concat_ws(" | ", *[one(c) for c in by])


def _valid(pairs: DataFrame, sar: str, val: str, by: Sequence[str]) -> DataFrame:
    return (
        pairs.filter(F.col(sar).isNotNull() & F.col(val).isNotNull())
        .select(group_key(by).alias("source"), F.col(sar).cast("double").alias("s"),
                F.col(val).cast("double").alias("v"))
    )


def _ratio(rmse: Column, mean: Column) -> Column:
    return F.when(F.abs(mean) > K.MEAN_EPSILON, rmse / F.nullif(F.abs(mean), F.lit(0.0)))


def linear_metrics(pairs: DataFrame, sar: str, val: str, by: Sequence[str] = ("val_source",),
                   ubrmsd: bool = False) -> DataFrame:
    """A1 (and A8 with *ubrmsd*): N, bias, std, rmse, correlation, scatter_index."""
    d = F.col("s") - F.col("v")
    enough = (F.col("N") >= K.MIN_N_FOR_CORRELATION) & (F.col("_ss") > 0) & (F.col("_sv") > 0)
    grouped = _valid(pairs, sar, val, by).groupBy("source").agg(
        F.count("*").alias("N"), F.avg(d).alias("bias"),
        F.when(F.count("*") > 1, F.stddev_samp(d)).alias("std"),
        F.sqrt(F.avg(d * d)).alias("rmse"), F.avg("v").alias("_mean"),
        F.stddev_pop("s").alias("_ss"), F.stddev_pop("v").alias("_sv"),
        F.covar_pop("s", "v").alias("_cov"), F.stddev_pop(d).alias("_ub"),
    )
    # written out, because corr() fails on a constant series in ANSI mode
    corr = F.col("_cov") / F.nullif(F.col("_ss") * F.col("_sv"), F.lit(0.0))
    extra = [F.when(F.col("N") > 1, F.col("_ub")).alias("ubrmsd")] if ubrmsd else []
    return grouped.select(
        "source", "N", "bias", "std", "rmse", F.when(enough, corr).alias("correlation"),
        _ratio(F.col("rmse"), F.col("_mean")).alias("scatter_index"), *extra,
    )


def circular_mean(angle: Column) -> Column:
    """A3: direction of the mean vector, in [0, 360)."""
    rad = F.radians(angle)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(rad)), F.avg(F.cos(rad)))), F.lit(360.0))


def circular_metrics(pairs: DataFrame, sar: str, val: str, by: Sequence[str] = ("val_source",)) -> DataFrame:
    """A2 with A4: the same metrics for directions.

    The correlation coefficient needs deviations from the mean directions; sums
    of products of sines and cosines give it in the same single pass.  A series
    whose spread is lost in rounding (below about 1e-5 degrees) has none.
    """
    d = circular_diff_deg("s", "v")
    dr, a, b = F.radians(d), F.radians("s"), F.radians("v")
    parts = {
        "ss": F.sin(a) * F.sin(b), "sc": F.sin(a) * F.cos(b),
        "cs": F.cos(a) * F.sin(b), "cc": F.cos(a) * F.cos(b),
        "aa": F.sin(a) * F.sin(a), "ac": F.sin(a) * F.cos(a), "ab": F.cos(a) * F.cos(a),
        "ba": F.sin(b) * F.sin(b), "bc": F.sin(b) * F.cos(b), "bb": F.cos(b) * F.cos(b),
    }
    g = _valid(pairs, sar, val, by).groupBy("source").agg(
        F.count("*").alias("N"), F.avg(F.sin(dr)).alias("ds"), F.avg(F.cos(dr)).alias("dc"),
        F.sqrt(F.avg(d * d)).alias("rmse"), circular_mean(F.col("v")).alias("mean_v"),
        F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a))).alias("a0"),
        F.atan2(F.avg(F.sin(b)), F.avg(F.cos(b))).alias("b0"),
        *[F.sum(e).alias(f"p_{k}") for k, e in parts.items()],
    )
    p = {k: F.col(f"p_{k}") for k in parts}
    ca, sa, cb, sb = F.cos("a0"), F.sin("a0"), F.cos("b0"), F.sin("b0")
    cross = p["ss"] * ca * cb - p["sc"] * ca * sb - p["cs"] * sa * cb + p["cc"] * sa * sb
    spread_a = p["aa"] * ca * ca - 2 * p["ac"] * ca * sa + p["ab"] * sa * sa
    spread_b = p["ba"] * cb * cb - 2 * p["bc"] * cb * sb + p["bb"] * sb * sb
    floor = F.col("N") * F.lit(1e-13)
    corr = F.when(
        (F.col("N") >= K.MIN_N_FOR_CORRELATION) & (spread_a > floor) & (spread_b > floor),
        cross / F.nullif(F.sqrt(spread_a * spread_b), F.lit(0.0)),
    )
    length = F.least(F.lit(1.0), F.hypot("dc", "ds"))
    bias = F.pmod(F.degrees(F.atan2("ds", "dc")) + 180.0, F.lit(360.0)) - 180.0
    return g.select(
        "source", "N", bias.alias("bias"),
        F.when((F.col("N") > 1) & (length > 0), F.degrees(F.sqrt(F.lit(-2.0) * F.log(length)))).alias("std"),
        "rmse", corr.alias("correlation"), _ratio(F.col("rmse"), F.col("mean_v")).alias("scatter_index"),
    )


def metrics(pairs: DataFrame, sar_var: str, val_var: str, by: Sequence[str] = ("val_source",)) -> DataFrame:
    """Linear or circular metrics, as the variable demands."""
    run = circular_metrics if val_var in K.CIRCULAR_VAL_VARS else linear_metrics
    return run(pairs, f"sar_{sar_var}", f"val_{val_var}", by)


# --- A7: distribution matching ----------------------------------------------------

def cdf_fit(pairs: DataFrame, sar: str, val: str, by: Sequence[str]) -> DataFrame:
    """A7, fit: per group the knots of a monotone map from *sar* to *val*.

    ``nbins = max(2, min(10, N // 20))``; equally spaced quantiles of both sides;
    targets of equal source quantiles averaged.  Fewer than two pairs, or fewer
    than two distinct source knots, leave the group without a map.
    """
    by = list(by)
    rows = pairs.filter(F.col(sar).isNotNull() & F.col(val).isNotNull())
    sides = rows.select(*by, F.explode(F.array(
        F.struct(F.lit("s").alias("side"), F.col(sar).cast("double").alias("x")),
        F.struct(F.lit("v").alias("side"), F.col(val).cast("double").alias("x")))).alias("p")
    ).select(*by, "p.side", "p.x")
    # both sides of a group have its number of rows, which the quantiles know as n
    bins = F.greatest(F.lit(K.CDF_MIN_BINS),
                      F.least(F.lit(K.CDF_MAX_BINS), F.floor(F.col("n") / K.CDF_ROWS_PER_BIN).cast("int")))
    q = exact_quantiles(sides, [*by, "side"], "x", F.transform(F.sequence(F.lit(0), bins), lambda i: i / bins))
    both = q.groupBy(*by).agg(
        F.max(F.when(F.col("side") == "s", F.col("n"))).alias("n"),
        F.min_by("q", F.when(F.col("side") == "s", 0)).alias("qs"),
        F.min_by("q", F.when(F.col("side") == "v", 0)).alias("qv"),
    )
    points = both.select(*by, "n", F.explode(F.arrays_zip("qs", "qv")).alias("z")).select(*by, "n", "z.qs", "z.qv")
    knots = points.groupBy(*by, "n", "qs").agg(F.avg("qv").alias("qv")).groupBy(*by, "n").agg(
        F.array_sort(F.collect_list(F.struct("qs", "qv"))).alias("knots"))
    return knots.filter((F.size("knots") >= 2) & (F.col("n") >= 2)).drop("n")


def cdf_apply(x: Column, knots: Column) -> Column:
    """A7, apply: piecewise linear between knots, the end pieces go on straight."""
    at = F.size(F.filter(knots, lambda k: k["qs"] <= x))
    i = F.least(F.greatest(at, F.lit(1)), F.size(knots) - 1)
    a, b = F.try_element_at(knots, i), F.try_element_at(knots, i + 1)
    return a["qv"] + (b["qv"] - a["qv"]) * (x - a["qs"]) / (b["qs"] - a["qs"])


def with_knots(pairs: DataFrame, knots: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the map of their group, NULL where the group has none."""
    return salted_join(pairs, knots, by, how="left", salts=None)


def fit_field_map(pairs: DataFrame, sar: str, val: str, sar_units: str, reference: str = "ismn") -> DataFrame:
    """A7, pooled: one map from the raw scene value to the reference's domain, fitted on
    all pairs together.  One row ``n, knots``, or none where there are too few pairs.

    Targets are harmonised (A9), so sources in percent and in volumes share a domain;
    the scene side stays raw, because the map is for cells that no observation has
    touched.  Pairs that could not be harmonised take no part.  The map is a small table
    of its own: write it with ``sources.sinks.sink_field_map`` and use it on any scene.
    """
    names = to_convert(sar_units, reference)
    raw, target = F.col(sar).cast("double"), F.col(val).cast("double")
    if names:
        due = F.coalesce(F.col("val_source").isin(*names), F.lit(False))
        # a map has a dozen knots at most; as a literal it is not fitted again by every pass
        fitted = cdf_fit(pairs.filter(F.col("val_source") == reference), sar, val, ["val_source"]).select("knots").first()
        moved = F.lit(None).cast("double") if fitted is None else cdf_apply(target, _literal(fitted["knots"]))
        target = F.when(due, moved).otherwise(target)
    pooled = pairs.filter(raw.isNotNull()).select(F.lit(0).alias("_pool"), raw.alias("_s"), target.alias("_v")).filter("_v IS NOT NULL")
    size = pooled.groupBy("_pool").agg(F.count("*").alias("n"))
    return cdf_fit(pooled, "_s", "_v", ["_pool"]).join(size, "_pool").select("n", "knots")


def _literal(knots: Sequence) -> Column:
    return F.array(*[F.struct(F.lit(k["qs"]).alias("qs"), F.lit(k["qv"]).alias("qv")) for k in knots])


def apply_field_map(field: DataFrame, field_map: DataFrame, value: str, out: str) -> DataFrame:
    """A7, pooled: *out* is *value* of each row in the map's domain.

    NULL where *value* is missing or not finite, and everywhere if the map has no row.
    The map is one row, so the field is not shuffled.
    """
    rows = attach_single(field, field_map.agg(F.first("knots").alias("_knots")))
    x = F.col(value).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & F.col("_knots").isNotNull()
    return rows.withColumn(out, F.when(finite, cdf_apply(x, F.col("_knots")))).drop("_knots")


# --- A9-A13: soil moisture -----------------------------------------------------------

def units_family(units: str | None) -> str:
    """Family of a units text; units of no family are their own."""
    text = str(units or "").strip().lower()
    return K.UNIT_FAMILIES.get(text, text)


def to_convert(sar_units: str, reference: str = "ismn") -> list[str]:
    """Sources in the family of the scene's units but not of the reference's."""
    family = units_family(sar_units)
    return sorted(s for s, f in K.UNITS_FAMILY.items()
                  if f == family and f != K.UNITS_FAMILY.get(reference))


def harmonize(pairs: DataFrame, sar: str, val: str, sar_units: str, reference: str = "ismn") -> DataFrame:
    """Bring sources in the scene's own units into the reference's domain.

    The map fitted on the reference's rows is applied to *both* columns of those
    sources.  Without a usable reference their rows become NULL.  The column
    ``harmonized`` is true where a source was converted, false where it was to
    be but could not, NULL where nothing was due.
    """
    names = to_convert(sar_units, reference)
    if not names:
        return pairs.withColumn("harmonized", F.lit(None).cast("boolean"))
    fit = cdf_fit(pairs.filter(F.col("val_source") == reference), sar, val, ["val_source"])
    # one group, so one map or none: the aggregation makes it one row
    rows = attach_single(pairs, fit.agg(F.first("knots").alias("knots")))
    due = F.col("val_source").isin(*names)
    usable = F.col(sar).isNotNull() & F.col(val).isNotNull() & F.col("knots").isNotNull()

    def moved(c: str) -> Column:
        return F.when(~due, F.col(c)).when(usable, cdf_apply(F.col(c), F.col("knots")))

    return rows.withColumns({
        "_s": moved(sar), "_v": moved(val),
        "harmonized": F.when(due, F.col("knots").isNotNull()),
    }).withColumns({sar: F.col("_s"), val: F.col("_v")}).drop("_s", "_v", "knots")


def rescaled_pairs(pairs: DataFrame, sar: str, val: str, sar_units: str,
                   by: Sequence[str] = ("val_source",), reference: str = "ismn") -> DataFrame:
    """The scene column in each group's own domain, row by row.

    Sources due for harmonising go through the reference's map (both columns),
    every other group through its own; rows without a map become NULL.  Grouped
    by source the reference's map is the one its own group gets, so one fit
    serves all rows.
    """
    if tuple(by) != ("val_source",):
        return _rescaled_by(pairs, sar, val, sar_units, by)
    due = F.coalesce(F.col("val_source").isin(*to_convert(sar_units, reference)), F.lit(False))
    rows = pairs.withColumn("_due", due).withColumn(
        "_map", F.when(F.col("_due"), F.lit(reference)).otherwise(group_key(by)))
    knots = cdf_fit(rows.filter(~F.col("_due")), sar, val, ["_map"])
    # a handful of sources: their maps come along as one row, so the pairs are not shuffled
    entries = F.map_from_entries(F.collect_list(F.struct("_map", "knots")))
    out = attach_single(rows, knots.filter("_map IS NOT NULL").agg(entries.alias("_maps"))).withColumn(
        "knots", F.try_element_at("_maps", F.col("_map")))
    usable = F.col(sar).isNotNull() & F.col(val).isNotNull() & F.col("knots").isNotNull()
    return out.withColumns({
        "_s": F.when(usable, cdf_apply(F.col(sar), F.col("knots"))),
        "_v": F.when(~F.col("_due"), F.col(val)).when(usable, cdf_apply(F.col(val), F.col("knots"))),
    }).withColumns({sar: F.col("_s"), val: F.col("_v"),
                    "harmonized": F.when(F.col("_due"), F.col("knots").isNotNull())}).drop("_s", "_v", "_due", "_map", "_maps", "knots")


def _rescaled_by(pairs: DataFrame, sar: str, val: str, sar_units: str, by: Sequence[str]) -> DataFrame:
    """A11 for finer groups: harmonise by source first, then match each group."""
    rows = harmonize(pairs, sar, val, sar_units).withColumn("_group", group_key(by))
    done = F.coalesce(F.col("harmonized"), F.lit(False))
    out = with_knots(rows, cdf_fit(rows.filter(~done), sar, val, ["_group"]), ["_group"])
    both = F.col(sar).isNotNull() & F.col(val).isNotNull()
    new = F.when(both, F.when(done, F.col(sar)).when(
        F.col("knots").isNotNull(), cdf_apply(F.col(sar), F.col("knots"))))
    return out.withColumn(sar, new).drop("knots", "_group")


def soil_statistics(pairs: DataFrame, sar: str, val: str, sar_units: str,
                    by: Sequence[str] = ("val_source",)) -> DataFrame:
    """A10: metrics with ubRMSD on rescaled pairs; groups below two pairs skipped."""
    return linear_metrics(rescaled_pairs(pairs, sar, val, sar_units, by), sar, val, by, ubrmsd=True).filter(
        F.col("N") >= 2)


def native_units_statistics(pairs: DataFrame, sar: str, val: str, sar_units: str) -> DataFrame:
    """Plain metrics of the sources in the scene's units family."""
    family = units_family(sar_units)
    names = [s for s, f in K.UNITS_FAMILY.items() if f == family]
    keep = F.col("val_source").isin(*names) & (F.col("val_source") != "cds_ssm")
    return linear_metrics(pairs.filter(keep), sar, val)


def cds_statistics(pairs: DataFrame, sar: str, val: str) -> DataFrame:
    """A13."""
    return linear_metrics(pairs.filter(F.col("val_source") == "cds_ssm"), sar, val)


def run_statistics(pairs: DataFrame, quantity: str, sar_var: str, val_var: str,
                   sar_units: str = "") -> DataFrame:
    """The statistics of one variable pair, without the ``cds_ssm`` rows."""
    rows = pairs.filter(F.coalesce(F.col("val_source") != "cds_ssm", F.lit(True)))
    if quantity == "soil_moisture":
        return soil_statistics(rows, f"sar_{sar_var}", f"val_{val_var}", sar_units)
    return metrics(rows, sar_var, val_var)


# --- A14 ------------------------------------------------------------------------------

def scene_qa(cells: DataFrame, flag: str, value: str) -> DataFrame:
    """Land share of classified cells and the mean over land before masking."""
    land = F.col(flag) == 1
    return cells.groupBy("scene").agg(
        F.count_if(land).alias("land_count"),
        (F.count_if(land) / F.nullif(F.count(flag), F.lit(0))).alias("land_fraction"),
        F.avg(F.when(land, F.col(value))).alias("land_mean"),
    )


def mask_qa(cells: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """Counts and shares of the cells each reason masked."""
    n = F.count("*")
    out = []
    for r in reasons:
        out += [F.count_if(F.col(r)).alias(f"{r}_count"), (F.count_if(F.col(r)) / n).alias(f"{r}_fraction")]
    return cells.groupBy("scene").agg(*out)
