"""Decoding and cleaning rules for single values, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathmatch import constants as K
from swathmatch.functions.geo import as_col


def to_null(c) -> Column:
    """NaN becomes NULL; applied once where data enters."""
    c = as_col(c)
    return F.when(F.isnan(c), None).otherwise(c)


def uv_to_speed_dir(u, v) -> tuple[Column, Column]:
    """speed and the direction the wind comes from, in [0, 360)."""
    u, v = as_col(u), as_col(v)
    return F.hypot(u, v), F.pmod(F.lit(270.0) - F.degrees(F.atan2(v, u)), F.lit(360.0))


def speed_dir_to_uv(speed, direction) -> tuple[Column, Column]:
    """eastward and northward part of a current flowing towards *direction*."""
    speed, rad = as_col(speed), F.radians(as_col(direction))
    return speed * F.sin(rad), speed * F.cos(rad)


def rotate_180(direction) -> Column:
    """towards becomes from."""
    return F.pmod(as_col(direction) + 180.0, F.lit(360.0))


def decode_dn(raw, scale: float, offset: float, reserved: Sequence[int] = (),
              reserved_from: int | None = None) -> Column:
    """reserved digital numbers are NULL, the rest is scaled."""
    raw = as_col(raw)
    bad = F.lit(False)
    if reserved:
        bad = bad | raw.isin(*reserved)
    if reserved_from is not None:
        bad = bad | (raw >= reserved_from)
    return F.when(~bad, raw * F.lit(float(scale)) + F.lit(float(offset)))


def fill_to_null(v, *sentinels: float, negative: bool = False) -> Column:
    """sentinels (and negatives, where the product says so) are NULL."""
    v = as_col(v)
    bad = F.isnan(v)
    for s in sentinels:
        bad = bad | (v == F.lit(float(s)))
    if negative:
        bad = bad | (v < 0)
    return F.when(~bad, v)


def epoch_time(epoch: str, days=None, seconds=None) -> Column:
    """fixed epoch plus whole days and (fractional) seconds.

    Whole units are counted in integers: as doubles, microseconds are exact for 285 years only.
    """
    micros = F.lit(0).cast("bigint")
    if days is not None:
        whole = as_col(days).cast("bigint")
        micros = micros + whole * F.lit(86_400_000_000) + ((as_col(days) - whole) * F.lit(86_400_000_000.0)).cast("bigint")
    if seconds is not None:
        whole = as_col(seconds).cast("bigint")
        micros = micros + whole * F.lit(1_000_000) + F.rint((as_col(seconds) - whole) * F.lit(1e6)).cast("bigint")
    return F.timestamp_micros(F.unix_micros(F.to_timestamp(F.lit(epoch))) + micros)


def parse_time_coerce(text, fmt: str) -> Column:
    """F16: fixed format, anything else is NULL."""
    return F.try_to_timestamp(as_col(text), F.lit(fmt))


def name_stamp(name) -> Column:
    """the ``YYYYMMDDtHHMMSS`` stamp of a scene file name."""
    token = F.upper(F.regexp_extract(as_col(name), K.SCENE_STAMP_IN_NAME, 1))
    return F.try_to_timestamp(token, F.lit("yyyyMMdd'T'HHmmss"))


def name_date_token(name) -> Column:
    """a 12- or 8-digit date token; eight digits mean midnight."""
    token = F.regexp_extract(as_col(name), K.DATE_TOKEN_IN_NAME, 1)
    return F.try_to_timestamp(F.when(token != "", F.rpad(token, 12, "0")), F.lit("yyyyMMddHHmm"))


def acquisition_time(attribute, name, prefer_name: bool = False) -> Column:
    """attribute or file-name time, whichever is preferred and present."""
    from_attr, from_name = F.try_to_timestamp(as_col(attribute)), name_stamp(name)
    return F.coalesce(from_name, from_attr) if prefer_name else F.coalesce(from_attr, from_name)


# date, then perhaps a time with or without colons, fractions and a zone
_DATETIME = r"^\s*(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}):?(\d{2})(?::?(\d{2})(?:\.\d*)?)?\s*(?:Z+|[+-]\d{2}:?\d{2})?)?\s*$"


def normalize_datetime(text) -> Column:
    """six accepted spellings to ``YYYY-MM-DDTHH:MM:SS``; others stay as they are.

    A missing time is midnight, missing seconds are none."""
    t = as_col(text)
    date, hour, minute, second = (F.regexp_extract(t, _DATETIME, i) for i in range(1, 5))
    clock = F.concat_ws(":", *[F.when(part == "", "00").otherwise(part) for part in (hour, minute, second)])
    return F.when(t.rlike(_DATETIME), F.concat(date, F.lit("T"), clock)).otherwise(F.trim(t))


def paired_labels(values: Sequence[int] | None, meanings: str | None) -> dict[int, str] | None:
    """Labels by flag value, or ``None`` when the metadata does not pair up."""
    names = (meanings or "").split()
    if values is None or not names or len(values) != len(names):
        return None
    return dict(zip(map(int, values), names, strict=True))


def decode_flag_labels(flag, labels: Mapping[int, str]) -> Column:
    """integer flag to label; values without a label are ``unknown``."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, as_col(flag).cast("int")), F.lit("unknown"))


def resolution_from_name(name) -> Column:
    """sampling in km from a file name, 12.5 when it has none."""
    found = F.regexp_extract(as_col(name), K.RESOLUTION_IN_NAME, 1)
    return F.coalesce(found.try_cast("double"), F.lit(K.DEFAULT_NAME_RESOLUTION_KM))


def gdop(dopx=None, dopy=None, given=None) -> Column:
    """dilution of precision from its two parts, else the one given."""
    parts = []
    if dopx is not None and dopy is not None:
        x, y = as_col(dopx), as_col(dopy)
        parts.append(F.sqrt(x * x + y * y))
    if given is not None:
        parts.append(as_col(given))
    return F.coalesce(*parts)


def first_available(df: DataFrame, preferred: Sequence[str]) -> str | None:
    """the first of several alternative columns a product carries."""
    return next((c for c in preferred if c in df.columns), None)


def canonical_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """product names to canonical codes."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def platform_label(code, fallback) -> Column:
    """two-letter platform code to its label, else the node's own type."""
    pairs = [F.lit(x) for pair in K.PLATFORM_LABELS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_col(code)), as_col(fallback))


def wmo_platform_class(platform_id) -> Column:
    """last three digits below 500 are moorings, everything else buoys."""
    number = as_col(platform_id).try_cast("double")
    return F.when(F.pmod(number, F.lit(1000.0)) < 500, "mooring").otherwise("buoy")


def mean_valid_partitions(total, partitions) -> Column:
    """total wave height, else the mean of its positive partitions."""
    good = F.filter(as_col(partitions), lambda x: x.isNotNull() & ~F.isnan(x) & (x > 0))
    mean = F.aggregate(good, F.lit(0.0), lambda acc, x: acc + x) / F.nullif(F.size(good), F.lit(0))
    return F.coalesce(to_null(total), mean)


# --- quality rules -------------------------------------------------------------

def qc_good(qc) -> Column:
    """Q1: a missing quality code counts as bad."""
    return F.coalesce(as_col(qc).isin(*K.VALID_QC_CODES), F.lit(False))


def reject_bits(masks: Sequence[int], meanings: str,
                reject: Sequence[str] = K.WIND_CELL_REJECT_FLAGS) -> int:
    """Q3: OR of the bit masks whose meaning rejects a cell."""
    bits = 0
    for mask, meaning in zip(masks, meanings.split()):
        if meaning in reject:
            bits |= int(mask)
    return bits


def bits_clear(flag, bits: int) -> Column:
    """Q3: none of *bits* is set."""
    return as_col(flag).cast("bigint").bitwiseAND(F.lit(bits).cast("bigint")) == 0


def label_rejected(flag, values: Sequence[int] | None, meanings: str | None) -> Column:
    """Q4: reject by label, ``0:good`` style tokens included; unusable metadata rejects nothing."""
    names = [t.rsplit(":", 1)[-1] for t in meanings.split()] if meanings else []
    if not names or values is None or len(names) != len(values):
        return F.lit(False)
    bad = [int(v) for v, name in zip(values, names) if name in K.QUALITY_REJECT_LABELS]
    return F.coalesce(as_col(flag).isin(*bad), F.lit(False)) if bad else F.lit(False)


def both_missing(a, b) -> Column:
    """Q5: two quality flags exist and neither has a value."""
    return as_col(a).isNull() & as_col(b).isNull()


def land_bit(mask) -> Column:
    """Q6: bit 1 is land; the other bits mask nothing."""
    return F.coalesce(as_col(mask).cast("bigint").bitwiseAND(F.lit(1).cast("bigint")) != 0, F.lit(False))


def osw_rejected(value, land, quality) -> tuple[Column, Column]:
    """Q8: (land, quality) rejection of a usable wave height; NULL flags have no say."""
    usable = as_col(value).isNotNull()
    by_land = usable & F.coalesce(as_col(land) == K.WAVE_LAND_FLAG, F.lit(False))
    by_quality = usable & F.coalesce(as_col(quality) >= K.WAVE_QUALITY_REJECT_FROM, F.lit(False))
    return by_land, by_quality


def validity_code(df: DataFrame, flag: str = "pixel_level_quality_flags",
                  mask: str = "mask", ice: str = "icemask") -> Column:
    """Q9: quality flag 5, or open water without ice where the flag does not exist."""
    if flag in df.columns:
        return F.coalesce(F.col(flag) == 5, F.lit(False))
    return F.coalesce((F.col(mask) == -1) & (F.col(ice) == 1), F.lit(False))
