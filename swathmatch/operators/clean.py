"""Q1-Q26 on tables: quality control, filters and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathmatch import constants as K
from swathmatch.functions.decode import bits_clear, land_bit, osw_rejected, qc_good
from swathmatch.functions.geo import as_col, split_antimeridian
from swathmatch.operators.ordered import keep_first
from swathmatch.operators.skew import salted_join


def qc_whitelist(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Q1: value and quality code become NULL unless the code is a good one."""
    out = {}
    for c in codes:
        qc = f"{c}_QC"
        if c in df.columns and qc in df.columns:
            out[c] = F.when(qc_good(qc), F.col(c))
            out[qc] = F.when(qc_good(qc), F.col(qc))
    return df.withColumns(out)


def qc_row_filter(df: DataFrame, qc: str, components: Sequence[str]) -> DataFrame:
    """Q2: rows with a good overall code and at least one component."""
    return df.filter(qc_good(qc) & F.coalesce(*[F.col(c) for c in components]).isNotNull())


def bitmask_reject(df: DataFrame, flag: str, bits: int) -> DataFrame:
    """Q3: drop rows with a reject bit set."""
    return df.filter(bits_clear(flag, bits)) if bits else df


def land_bit_mask(df: DataFrame, mask: str, variables: Sequence[str]) -> DataFrame:
    """Q6: land hides *variables*, everything else passes."""
    return df.withColumns({v: F.when(~land_bit(mask), F.col(v)) for v in variables})


def land_flag_mask(df: DataFrame, flag: str, variables: Sequence[str]) -> DataFrame:
    """Q7: land flag 1 hides value and spread; heading and incidence stay."""
    land = F.coalesce(F.col(flag) == 1, F.lit(False))
    return df.withColumns({v: F.when(~land, F.col(v)) for v in variables})


def osw_flag_mask(df: DataFrame, value: str = "oswTotalHs", partitions: str | None = "oswHs") -> DataFrame:
    """Q8: wave heights rejected by land or quality, with the two reasons kept."""
    land, quality = osw_rejected(value, "oswLandFlag", "oswQualityFlag")
    out = df.withColumns({"land_masked": land, "quality_masked": quality})
    ok = ~(F.col("land_masked") | F.col("quality_masked"))
    hidden = {value: F.when(ok, F.col(value))}
    if partitions and partitions in df.columns:
        hidden[partitions] = F.when(ok, F.col(partitions))
    return out.withColumns(hidden)


def drop_invalid(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Q10."""
    return df.dropna(subset=list(required))


def precedence_null_out(df: DataFrame, order: Sequence[str] = K.WAVE_HEIGHT_VARS) -> DataFrame:
    """Q11: of several alternatives in a row only the first present one survives."""
    present = [c for c in order if c in df.columns]
    out = {}
    for i, c in enumerate(present[1:], start=1):
        free = F.coalesce(*[F.col(h) for h in present[:i]]).isNull()
        out[c] = F.when(free, F.col(c))
        if f"{c}_QC" in df.columns:
            # the code goes only together with a value it belonged to
            out[f"{c}_QC"] = F.when(free | F.col(c).isNull(), F.col(f"{c}_QC"))
    return df.withColumns(out)


def presence_filter(df: DataFrame, quantity: str) -> DataFrame:
    """Q12: what an observation must carry to be of use."""
    if quantity == "wind":
        return df.filter(F.col("speed").isNotNull() | F.col("direction").isNotNull())
    if quantity == "waves":
        return df.filter(F.col("height").isNotNull())
    return df.filter(F.col("speed").isNotNull() & F.col("direction").isNotNull())


def domain_filter(df: DataFrame, min_lon: float, max_lon: float, min_lat: float, max_lat: float,
                  start: str, end: str, buffer_km: float, tolerance_minutes: float) -> DataFrame:
    """Q13: widened box and time window; rows without a time stay."""
    pad = buffer_km / K.KM_PER_DEG_NEAREST_BUFFER
    lon, lat = F.col("lon"), F.col("lat")
    west, east = lon >= min_lon - pad, lon <= max_lon + pad
    across = (west & east) if min_lon <= max_lon else (west | east)
    slack = F.make_dt_interval(mins=F.lit(int(tolerance_minutes)),
                               secs=F.lit((tolerance_minutes % 1) * 60).cast("decimal(18,6)"))
    lo, hi = F.to_timestamp(F.lit(start)) - slack, F.to_timestamp(F.lit(end)) + slack
    when = F.col("time").cast("timestamp")
    return df.filter(
        across & lat.between(min_lat - pad, max_lat + pad) & (when.isNull() | when.between(lo, hi))
    )


def domain_envelope(specs: DataFrame) -> DataFrame:
    """Q14: widest buffer and tolerance over all specs and overrides."""
    return specs.agg(F.max("aggregation_window_km").alias("buffer_km"),
                     F.max("time_tolerance_minutes").alias("tolerance_minutes"))


def exclude_platforms(df: DataFrame, covered: DataFrame) -> DataFrame:
    """Q16: platforms a preferred feed already brings."""
    return df.join(covered.select("platform_id").distinct(), "platform_id", "left_anti")


def dedupe_overlapping_windows(df: DataFrame, file: str = "file_name") -> DataFrame:
    """Q17: files of one product (name without its date suffix): first of (time, lat, lon)."""
    product = F.regexp_replace(F.col(file), r"_\d{8}(T\d{6})?_\d{8}(T\d{6})?(\.\w+)?$", "")
    return keep_first(df.withColumn("product", product), ["product", "time", "lat", "lon"], [F.col(file)])


def shallowest_level(df: DataFrame) -> DataFrame:
    """Q18: per platform and minute the whole row of the smallest depth, earlier row on ties."""
    minute = df.withColumn("_minute", F.date_trunc("minute", "time"))
    return keep_first(minute, ["platform_id", "_minute"],
                      [F.col("depth").asc_nulls_last(), F.col("obs_id")]).drop("_minute")


def depth_window(df: DataFrame, lo: float = K.DEFAULT_MIN_DEPTH, hi: float = K.DEFAULT_MAX_DEPTH) -> DataFrame:
    """Q19."""
    return df.filter(F.col("depth").between(lo, hi))


def dedupe_scene_seam(east: DataFrame, west: DataFrame, keys: Sequence[str] = ("time", "lat")) -> DataFrame:
    """Q20: stitched grid, west part moved up by 360, a longitude met twice kept from the east."""
    both = east.withColumn("_part", F.lit(0)).unionByName(
        west.withColumn("lon", F.col("lon") + 360.0).withColumn("_part", F.lit(1)))
    return keep_first(both, [*keys, "lon"], [F.col("_part")]).drop("_part")


def drop_nondirectional(pairs: DataFrame, val: str) -> DataFrame:
    """Q21: sources which never carry *val*."""
    useful = pairs.groupBy("val_source").agg(F.count(val).alias("_n")).filter(F.col("_n") > 0).select("val_source")
    return salted_join(pairs, useful, ["val_source"], salts=None)


def scene_filter(pairs: DataFrame, scene: str) -> DataFrame:
    """Q22."""
    return pairs.filter(F.col("sar_scene_name") == scene)


def variable_relevance(df: DataFrame, quantity: str, column: str = "variable") -> DataFrame:
    """Q23: rows comparable to the quantity; an unknown quantity keeps all."""
    wanted = K.INSITU_VARIABLES.get(quantity)
    return df.filter(F.col(column).isin(*wanted)) if wanted else df


def availability_clamp(requests: DataFrame, missions: DataFrame) -> DataFrame:
    """Q24: requests cut to the life of each mission; open-ended missions have no end."""
    r, m = requests.alias("r"), missions.alias("m")
    lasts = F.coalesce(F.col("m.avail_end"), F.col("r.end"))
    hit = (F.col("r.end") >= F.col("m.avail_start")) & (F.col("r.start") <= lasts)
    # the key is whatever names the product family both sides belong to
    return r.join(m, F.col("r.family") == F.col("m.family")).filter(hit).select(
        "r.request_id", "m.mission",
        F.greatest(F.col("r.start"), F.col("m.avail_start")).alias("start"),
        F.least(F.col("r.end"), lasts).alias("end"),
    )


def missions_active_on(days: DataFrame, missions: DataFrame) -> DataFrame:
    """Q24: missions of a family in service on a day, both ends included."""
    return days.join(missions, "family").filter(
        F.col("day").between(F.to_date("avail_start"), F.coalesce(F.to_date("avail_end"), F.col("day"))))


def catalog_dedupe(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Q25: one row per product id, the first listed."""
    return keep_first(df, [key], [F.col(c) for c in order])


def granule_name_parts(name) -> tuple[Column, Column, Column]:
    """Q26: (time, lon, lat) written into a scene file name of either era."""
    name = as_col(name)

    def old(i: int) -> Column:
        return F.regexp_extract(name, K.WIND_NAME_OLD, i)

    def new(i: int) -> Column:
        return F.regexp_extract(name, K.WIND_NAME_NEW, i)

    def signed(value: Column, hemisphere: Column, positive: str) -> Column:
        number = value.try_cast("double")
        return F.when(hemisphere == positive, number).otherwise(-number)

    is_old = old(1) != ""
    stamp = F.when(is_old, F.concat(*[old(i) for i in range(1, 7)])).otherwise(F.substring(new(5), 1, 14))
    lon = F.when(is_old, signed(old(7), old(8), "E")).otherwise(signed(new(3), new(4), "E"))
    lat = F.when(is_old, signed(old(9), old(10), "N")).otherwise(signed(new(1), new(2), "N"))
    known = is_old | (new(1) != "")
    wrapped = F.pmod(lon + 180.0, F.lit(360.0)) - 180.0
    return (F.when(known, F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))),
            F.when(known, wrapped), F.when(known, lat))


def near_longitude(lon: Column, min_lon: float, max_lon: float, pad: float = K.GRANULE_PAD_DEG) -> Column:
    """Q26: inside the padded range, also where the pad reaches past 180 degrees."""
    lo, hi = min_lon - pad, max_lon + pad
    hit = lon.between(lo, hi)
    if hi > 180:
        hit = hit | (lon <= hi - 360)
    if lo < -180:
        hit = hit | (lon >= lo + 360)
    return hit


def granule_padded_bbox(df: DataFrame, name: str, min_lon: float, max_lon: float,
                        min_lat: float, max_lat: float, start: str, end: str,
                        end_exclusive: bool = False) -> DataFrame:
    """Q26: granules by the position in their name; unreadable names drop out."""
    t, lon, lat = granule_name_parts(name)
    out = df.withColumns({"g_time": t, "g_lon": lon, "g_lat": lat})
    across = F.lit(False)
    for w, e in split_antimeridian(min_lon, max_lon):
        across = across | near_longitude(F.col("g_lon"), w, e)
    hi = F.to_timestamp(F.lit(end))
    return out.filter(
        across & F.col("g_lat").between(min_lat - K.GRANULE_PAD_DEG, max_lat + K.GRANULE_PAD_DEG)
        & (F.col("g_time") >= F.to_timestamp(F.lit(start)))
        & ((F.col("g_time") < hi) if end_exclusive else (F.col("g_time") <= hi))
    )
