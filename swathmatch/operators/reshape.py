"""Reshaping, pooling and choosing between sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathmatch import constants as K
from swathmatch.operators.skew import attach_single, salted_join


def pivot_variables(long: DataFrame, ids: Sequence[str], codes: Sequence[str], order: str) -> DataFrame:
    """Long to wide, the first value and first code per id and variable.

    "First" means first non-missing by *order*; only existing ids appear.  With
    the list of codes given this is one aggregation.
    """
    def first(c: str, code: str) -> Column:
        hit = (F.col("variable") == code) & F.col(c).isNotNull()
        return F.min_by(F.when(hit, F.col(c)), F.when(hit, F.col(order)))

    aggs = []
    for code in codes:
        aggs += [first("value", code).alias(code), first("value_qc", code).alias(f"{code}_QC")]
    return long.groupBy(*ids).agg(*aggs)


def melt_to_long(wide: DataFrame, ids: Sequence[str], codes: Sequence[str]) -> DataFrame:
    """Wide to long, each value with its code; missing values go, a missing code column is NULL."""
    cells = []
    for code in codes:
        qc = F.col(f"{code}_QC") if f"{code}_QC" in wide.columns else F.lit(None)
        cells.append(F.struct(F.lit(code).alias("variable"), F.col(code).cast("double").alias("value"),
                              qc.cast("int").alias("value_qc")))
    return (
        wide.select(*ids, F.explode(F.array(*cells)).alias("c"))
        .select(*ids, "c.variable", "c.value", "c.value_qc")
        .filter(F.col("value").isNotNull())
    )


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """Pool all matches; columns a source lacks are NULL, ids default to ``unknown``."""
    pooled = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if "val_id" in pooled.columns:
        pooled = pooled.withColumn("val_id", F.coalesce("val_id", F.lit("unknown")))
    return pooled


def merge_sibling_nodes(obs: DataFrame, source_of_node: DataFrame) -> DataFrame:
    """Files of one source become one, so overpasses are averaged together."""
    return salted_join(obs, source_of_node.select("source_node", "source_type"), ["source_node"], salts=None).drop(
        "source_node").withColumnRenamed("source_type", "source_node")


def merge_wave_columns(pairs: DataFrame) -> DataFrame:
    """``val_SWH`` from the first wave height present and ``val_var_code`` which one it was."""
    present = [c for c in K.WAVE_HEIGHT_VARS if f"val_{c}" in pairs.columns]
    merged = f"val_{K.MERGED_WAVE_VAR}"
    if merged in pairs.columns or not present:
        return pairs
    code = F.coalesce(*[F.when(F.col(f"val_{c}").isNotNull(), F.lit(c)) for c in present], F.lit(""))
    return pairs.withColumns({merged: F.coalesce(*[F.col(f"val_{c}") for c in present]), "val_var_code": code})


def select_pairs(pairs: DataFrame, quantity: str) -> list[tuple[str, str]]:
    """Which (scene, observation) variable pairs can be compared.

    Column names decide, except that ``owiSignificantWaveHeight`` also needs a
    value: one existence test, which stops at the first hit.
    """
    if quantity not in K.VARIABLE_PAIRS:
        raise KeyError(f"unknown variable {quantity!r}; known: {', '.join(K.VARIABLE_PAIRS)}")
    have = set(pairs.columns)
    wanted = list(K.VARIABLE_PAIRS[quantity])
    if quantity == "waves":
        pairs = merge_wave_columns(pairs)
        have = set(pairs.columns)
        main = next((v for v in ("oswTotalHs", "oswHs") if f"sar_{v}" in have), None)
        names = [main] if main else []
        extra = "owiSignificantWaveHeight"
        if f"sar_{extra}" in have and not pairs.filter(F.col(f"sar_{extra}").isNotNull()).isEmpty():
            names.append(extra)
        wanted = [(v, K.MERGED_WAVE_VAR) for v in names]
    return [(s, v) for s, v in wanted if f"sar_{s}" in have and f"val_{v}" in have]


def units_pooling(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Units of the pooled column.

    *units* has ``val_source, units, long_name``.  Where all sources present
    agree, one value stands for all rows; otherwise every row gets its own and
    ``mixed`` is true.
    """
    present = pairs.select("val_source").distinct()
    known = units.join(present, "val_source", "left_semi")
    one = known.agg(
        F.min("units").alias("_units"), F.min_by("long_name", "val_source").alias("_name"),
        (F.count_distinct("units") > 1).alias("mixed"))
    rows = salted_join(pairs, known.select("val_source", "units", "long_name"), ["val_source"], "left", salts=None)
    rows = attach_single(rows, one)
    mixed = F.coalesce("mixed", F.lit(False))
    return rows.withColumns({
        "val_units": F.when(mixed, F.coalesce("units", F.lit(""))).otherwise(F.col("_units")),
        "val_long_name": F.when(mixed, F.coalesce("long_name", F.lit(""))).otherwise(F.col("_name")),
        "mixed": mixed,
    }).drop("_units", "_name", "units", "long_name")


def cutover_split(requests: DataFrame, cutover: str) -> DataFrame:
    """The part of a window before a product change and the part from it on.

    The earlier part of a straddling window ends one second before.
    """
    cut = F.to_timestamp(F.lit(cutover))
    start, end = F.col("start"), F.col("end")
    before = F.when(start < cut, F.struct(
        F.lit("before").alias("part"), start.alias("s"),
        F.when(end < cut, end).otherwise(cut - F.expr("interval 1 second")).alias("e")))
    after = F.when(end >= cut, F.struct(
        F.lit("after").alias("part"), F.greatest(start, cut).alias("s"), end.alias("e")))
    return requests.select(
        "request_id", F.explode(F.array_compact(F.array(before, after))).alias("w")
    ).select("request_id", "w.part", F.col("w.s").alias("start"), F.col("w.e").alias("end"))


def model_segments(requests: DataFrame, buffer_minutes: int) -> DataFrame:
    """Current-model data sets of a window, widened but never overlapping.

    Coverage starts at a fixed day (windows ending before it have no segment).
    Where a window needs both data sets their widened parts stop at the change.
    """
    first = F.to_timestamp(F.lit(K.CURRENT_MODEL_FIRST_DAY))
    cut = F.to_timestamp(F.lit(K.CURRENT_MODEL_CUTOVER))
    old, new = K.CURRENT_MODEL_SEGMENTS
    r = requests.filter(F.col("end") >= first).withColumn("start", F.greatest("start", first))
    both = (F.col("start") < cut) & (F.col("end") > cut)
    older = F.when(F.col("end") <= cut, F.struct(F.lit(old).alias("k"), F.col("start").alias("s"), F.col("end").alias("e")))
    newer = F.when((F.col("end") > cut) & (F.col("start") >= cut),
                   F.struct(F.lit(new).alias("k"), F.col("start").alias("s"), F.col("end").alias("e")))
    split_old = F.when(both, F.struct(F.lit(old).alias("k"), F.col("start").alias("s"), cut.alias("e")))
    split_new = F.when(both, F.struct(F.lit(new).alias("k"), cut.alias("s"), F.col("end").alias("e")))
    seg = r.select("request_id", both.alias("both"),
                   F.explode(F.array_compact(F.array(older, newer, split_old, split_new))).alias("g"))
    pad = F.expr(f"interval {int(buffer_minutes)} minutes")
    lo, hi = F.greatest(F.col("g.s") - pad, first), F.col("g.e") + pad
    return seg.select(
        "request_id", F.col("g.k").alias("dataset"),
        F.when(F.col("both") & (F.col("g.k") == new), F.greatest(lo, cut)).otherwise(lo).alias("start"),
        F.when(F.col("both") & (F.col("g.k") == old), F.least(hi, cut - F.expr("interval 1 second")))
        .otherwise(hi).alias("end"))


def historical_first(rows: DataFrame, pairs: Mapping[str, str] = K.HISTORICAL_FIRST_PAIRS) -> DataFrame:
    """Where delayed-mode data of a window exist, the real-time feed of that window is left out."""
    live_of = F.create_map(*[F.lit(x) for live, hist in pairs.items() for x in (hist, live)])
    covered = rows.select(F.try_element_at(live_of, F.col("source_type")).alias("source_type"), "window_id").filter(
        F.col("source_type").isNotNull()).distinct()
    return rows.join(covered, ["source_type", "window_id"], "left_anti")


def waterfall_choice(rows: DataFrame, by: Sequence[str], priority: str = "priority") -> DataFrame:
    """The first backend that has rows for a request serves it alone."""
    best = rows.groupBy(*by).agg(F.min(priority).alias(priority))
    return rows.join(best, [*by, priority], "left_semi")


_BOX = ["min_lon", "max_lon", "min_lat", "max_lat"]


def largest_overlap(requests: DataFrame, regions: DataFrame) -> DataFrame:
    """the region box that overlaps a request most; first listed on ties, no overlap no row.

    Joined on 10-degree tiles, so neither side is paired with all of the other.  Equal
    boxes are judged once, and pairs are only counted up: the largest area of a box first,
    then the first region that reaches it.
    """
    boxes, listed = requests.select(*_BOX).distinct(), _first_listed(regions)
    width = F.least("max_lon", "r_max_lon") - F.greatest("min_lon", "r_min_lon")
    height = F.least("max_lat", "r_max_lat") - F.greatest("min_lat", "r_min_lat")

    def hits(rows: DataFrame) -> DataFrame:
        return _tile_hits(rows, listed).filter((width > 0) & (height > 0)).withColumn("_a", width * height)

    best = hits(boxes).groupBy(*_BOX).agg(F.max("_a").alias("area"))
    first = hits(best).filter("_a = area").groupBy(*_BOX, "area").agg(F.min("region_order").alias("region_order"))
    once = Window.partitionBy("request_id").orderBy(F.desc("area"), "region_order")
    ranked = requests.select("request_id", *_BOX).join(first, _BOX).withColumn("_rn", F.row_number().over(once)).filter("_rn = 1")
    return _named(ranked, regions).select("request_id", "region", "area")


def centre_region(requests: DataFrame, regions: DataFrame) -> DataFrame:
    """the first listed region holding the centre of a request; equal centres are judged once."""
    centred = requests.select("request_id", ((F.col("min_lon") + F.col("max_lon")) / 2).alias("c_lon"),
                              ((F.col("min_lat") + F.col("max_lat")) / 2).alias("c_lat"))
    points = centred.select("c_lon", "c_lat").distinct().select(
        "c_lon", "c_lat", F.col("c_lon").alias("min_lon"), F.col("c_lon").alias("max_lon"),
        F.col("c_lat").alias("min_lat"), F.col("c_lat").alias("max_lat"))
    inside = F.col("c_lon").between(F.col("r_min_lon"), F.col("r_max_lon")) & F.col("c_lat").between(
        F.col("r_min_lat"), F.col("r_max_lat"))
    first = _tile_hits(points, _first_listed(regions)).filter(inside).groupBy("c_lon", "c_lat").agg(
        F.min("region_order").alias("region_order"))
    hits = centred.join(first, ["c_lon", "c_lat"]).groupBy("request_id").agg(F.min("region_order").alias("region_order"))
    return _named(hits, regions).select("request_id", "region")


def _first_listed(regions: DataFrame) -> DataFrame:
    """Each region box once, with the first place in the list.

    A number and no name, so that whoever looks for the least one can count it up without sorting."""
    return regions.groupBy(*_BOX).agg(F.min("region_order").alias("region_order"))


def _named(rows: DataFrame, regions: DataFrame) -> DataFrame:
    names = regions.groupBy(F.col("region_order").alias("_order")).agg(F.min("region").alias("region"))
    return rows.join(names, F.col("region_order").eqNullSafe(F.col("_order")))


def _tile_hits(requests: DataFrame, regions: DataFrame, tile: float = 10.0) -> DataFrame:
    def tiles(df: DataFrame, w: str, e: str, s: str, n: str) -> DataFrame:
        for name, lo, hi in (("_tx", w, e), ("_ty", s, n)):
            df = df.withColumn(name, F.explode(F.sequence(F.floor(F.col(lo) / tile), F.floor(F.col(hi) / tile))))
        return df

    r = regions.withColumnsRenamed({c: f"r_{c}" for c in ("min_lon", "max_lon", "min_lat", "max_lat")})
    lhs = tiles(requests, "min_lon", "max_lon", "min_lat", "max_lat")
    rhs = tiles(r, "r_min_lon", "r_max_lon", "r_min_lat", "r_max_lat")
    # a pair is counted in the tile of the south-west corner of its intersection
    home = (F.col("_tx") == F.floor(F.greatest("min_lon", "r_min_lon") / tile)) & (
        F.col("_ty") == F.floor(F.greatest("min_lat", "r_min_lat") / tile))
    return salted_join(lhs, rhs, ["_tx", "_ty"]).filter(home).drop("_tx", "_ty")


def finest_resolution(first: Column, second: Column) -> Column:
    """smallest value of two sets, either of which may be missing."""
    return F.array_min(F.array_union(F.coalesce(first, F.array().cast("array<double>")),
                                     F.coalesce(second, F.array().cast("array<double>"))))


def swath_to_columns(cells: DataFrame) -> DataFrame:
    """sub-swath *k* laid beside the ones before it: ``x' = k * nx + x``."""
    return cells.withColumn("x", (F.col("k") * F.col("nx") + F.col("x")).cast("int")).drop("k", "nx")
