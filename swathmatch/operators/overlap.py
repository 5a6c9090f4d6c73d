"""Joins of intervals and boxes of every size, over nested cells.

Time, and the plane of longitude and latitude, are cut into cells of rising width, each
four times the one below.  An interval or a box belongs to the level whose cells are
just as wide as it is, where it touches two of them at most along each axis; it is
also listed on the wider levels which the other side has members of.  Two that meet do
so on the level of the larger one, in the cell of the first place they share, so no
pair has to be de-duplicated, and neither short nor long ones need a width chosen for
them.

The levels are set by the data.  The widest has cells of about a 256th of all there
is, over all axes together: what is larger is listed under several of those, so that
not even the intervals without an end gather under one key.  The narrowest has a few
cells for each row of the smaller side: finer ones would only be more to list.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swathmatch.operators.skew import LANES, attach_single

# the widest cells: so many halvings of the whole extent, shared out among the axes;
# the narrowest: so many more than the smaller side has rows, in powers of two
HALVINGS, FINER = 8, 3
HOUR = 3_600_000_000
_WHOLE = 62


class Axis(NamedTuple):
    """Columns of one axis on both sides: an interval, its ends included.

    A *time* axis is exact in microseconds; a NULL end of it is open, and an interval that
    ends before it starts meets nothing.  Other axes are numbers (degrees); a row with a
    NULL there meets nothing, and one whose ends are the wrong way round meets what
    holds them both, as ``lo <= r_hi AND r_lo <= hi`` says.
    """

    lo: str
    hi: str
    r_lo: str
    r_hi: str
    time: bool = False

    @property
    def narrowest(self) -> int:
        """Bits of the narrowest cells: a quarter of a degree, a quarter of a minute."""
        return 24 if self.time else 18

    def steps(self, c: str) -> Column:
        """Whole steps along the axis, which rise with the value."""
        if self.time:
            return F.unix_micros(F.col(c).cast("timestamp"))
        return F.floor(F.col(c).cast("double") * (1 << 20)).cast("bigint")


Spaces = Sequence[Sequence[Axis]]


def _down(x: Column, bits: Column) -> Column:
    """The cell of *x* among cells of 2^bits steps."""
    return F.call_function("shiftright", x, bits)


def _bits(lo: Column, hi: Column) -> Column:
    """Bits (even) of the cells just as wide as an interval; an open one needs the widest."""
    size = F.greatest((hi - lo + 1).cast("double"), F.lit(1.0))
    return F.coalesce((2 * F.ceil(F.log2(size) / 2)).cast("int"), F.lit(_WHOLE))


def _sides(axis: Axis, side: str) -> tuple[Column, Column]:
    lo, hi = (axis.lo, axis.hi) if side == "l" else (axis.r_lo, axis.r_hi)
    return axis.steps(lo), axis.steps(hi)


def _numbered(spaces: Spaces) -> list[list[tuple[int, Axis]]]:
    """The axes of each space with their numbers."""
    at = iter(range(sum(map(len, spaces))))
    return [[(next(at), a) for a in axes] for axes in spaces]


def _extent(df: DataFrame, spaces: Spaces, side: str) -> DataFrame:
    """One row: how many rows there are, where each axis begins and ends, and the sizes in
    each space (at most 32)."""
    out = [F.count("*").alias(f"{side}rows")]
    for k, axes in enumerate(_numbered(spaces)):
        for i, a in axes:
            lo, hi = _sides(a, side)
            out += [F.min(F.least(lo, hi)).alias(f"{side}first{i}"), F.max(F.greatest(lo, hi)).alias(f"{side}last{i}")]
        out.append(F.collect_set(_widest_bits([_bits(*_sides(a, side)) for _, a in axes])).alias(f"{side}sizes{k}"))
    return df.agg(*out)


def _widest_bits(bits: list[Column]) -> Column:
    return F.greatest(*bits) if len(bits) > 1 else bits[0]


def cells_in_use(left: DataFrame, right: DataFrame, spaces: Spaces, sizes: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """One row: where each axis begins and ends, the narrowest and the widest level of each
    space, the levels either side has there, and whether the left side has fewer rows.

    With *sizes*, the bits the left side's intervals may need in each space, that side is
    not read, and the right one alone says where the axes begin and end.
    """
    both = _extent(right, spaces, "r")
    known = "r"
    if sizes is None:
        both, known = attach_single(both, _extent(left, spaces, "l")), "lr"
    n_axes = sum(map(len, spaces))
    fewest = _least([F.col(f"{s}rows") for s in known])
    finest = F.greatest(F.ceil(F.log2(fewest + 1)).cast("int") + FINER, F.lit(HALVINGS))
    # levels are even
    coarse, fine = F.lit(HALVINGS // n_axes // 2 * 2), F.floor(finest / n_axes / 2).cast("int") * 2
    ends, scales, levels = {}, {}, []
    for k, axes in enumerate(_numbered(spaces)):
        for i, _ in axes:
            ends |= {f"_first{i}": _least([F.col(f"{s}first{i}") for s in known]), f"_last{i}": -_least([-F.col(f"{s}last{i}") for s in known])}
        whole = _widest_bits([_bits(F.col(f"_first{i}"), F.col(f"_last{i}")) for i, _ in axes])
        least = F.lit(axes[0][1].narrowest)
        scales |= {f"_widest{k}": F.greatest(least, whole - coarse), f"_narrowest{k}": F.greatest(least, whole - fine)}
        for s in "lr":
            given = F.col(f"{s}sizes{k}") if s in known else F.array(*[F.lit(int(b)) for b in sizes[k]])
            levels.append(_held(given, k).alias(f"_{s}levels{k}"))
    fewer = (F.col("lrows") < F.col("rrows") if sizes is None else F.lit(False)).alias("_lfewer")
    return both.withColumns(ends).withColumns(scales).select(*ends, *scales, *levels, fewer)


def _least(columns: list[Column]) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def _held(sizes: Column, space: int) -> Column:
    """The levels that intervals of some sizes belong to."""
    return F.array_distinct(F.transform(sizes, lambda bits: _level(bits, space)))


def _level(bits: Column, space: int) -> Column:
    return F.least(F.greatest(bits, F.col(f"_narrowest{space}")), F.col(f"_widest{space}"))


def listed(df: DataFrame, in_use: DataFrame, spaces: Spaces, side: str) -> DataFrame:
    """Rows under all their cells: ``_level<space>, _cell<axis>``; the interval in steps and
    its own level as ``_<side>a<axis>, _<side>b<axis>, _<side>own<space>``.

    An interval is listed on the wider levels of the other side, and on its own one if
    something as small as it is waits there; what lies beyond the axes is left out.
    """
    other = "r" if side == "l" else "l"
    rows = attach_single(df, in_use)
    for k, axes in enumerate(_numbered(spaces)):
        for i, a in axes:
            first, last = F.col(f"_first{i}"), F.col(f"_last{i}")
            begin, end = _sides(a, side)
            if a.time:
                begin, end = F.coalesce(begin, first), F.coalesce(end, last)
            else:
                begin, end = F.least(begin, end), F.when(begin.isNotNull() & end.isNotNull(), F.greatest(begin, end))
            rows = rows.withColumns({f"_{side}a{i}": F.greatest(begin, first), f"_{side}b{i}": F.least(end, last)})
            rows = rows.filter((begin <= end) & (F.col(f"_{side}a{i}") <= F.col(f"_{side}b{i}")))
        ends = [(F.col(f"_{side}a{i}"), F.col(f"_{side}b{i}")) for i, _ in axes]
        rows = rows.withColumn("_own", _level(_widest_bits([_bits(*x) for x in ends]), k))
        levels = F.col(f"_{other}levels{k}")
        wider = F.filter(levels, lambda level: level > F.col("_own"))
        level = F.col(f"_level{k}")
        rows = rows.withColumn(f"_level{k}", F.explode(F.when(F.array_min(levels) <= F.col("_own"), F.concat(F.array("_own"), wider)).otherwise(wider)))
        for (i, _), (begin, end) in zip(axes, ends, strict=True):
            rows = rows.withColumn(f"_cell{i}", F.explode(F.sequence(_down(begin, level), _down(end, level))))
        rows = rows.withColumnRenamed("_own", f"_{side}own{k}")
    return rows.drop(*in_use.columns)


def _laned(df: DataFrame, in_use: DataFrame, spaces: Spaces, side: str, lane: Column) -> DataFrame:
    """*df* under its cells and lanes: a row of the larger side has its own *lane*, one of the smaller side waits in all."""
    fewer = F.col("_lfewer") if side == "l" else ~F.col("_lfewer")
    lanes = F.when(fewer, F.sequence(F.lit(0), F.lit(LANES - 1))).otherwise(F.array(lane))
    rows = attach_single(df, in_use.select("_lfewer")).withColumn("_lanes", lanes).drop("_lfewer")
    return listed(rows, in_use, spaces, side).withColumn("_lane", F.explode("_lanes")).drop("_lanes")


def overlap_join(left: DataFrame, right: DataFrame, spaces: Spaces, by: Sequence[str] = (),
                 sizes: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """Pairs of rows that overlap on every axis and agree on *by*, each once.

    *spaces* are groups of axes with one scale: ``((WINDOW,), (LON, LAT))``.  Ends count as
    inside.  All columns of both sides come back as they are; they must not share names
    but *by*.  Both sides are read once ahead of the join, for their extents; where the
    left one is dear to compute, *sizes* spares it that (``cells_in_use``).
    """
    in_use = cells_in_use(left, right, spaces, sizes)
    n_axes = sum(map(len, spaces))
    keys = [*[f"_level{k}" for k in range(len(spaces))], *[f"_cell{i}" for i in range(n_axes)]]
    # a hot cell is spread over lanes, by what tells rows apart at little cost
    def lane(df: DataFrame) -> Column:
        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        return F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(LANES)).cast("int")

    lhs = _laned(left, in_use, spaces, "l", lane(left))
    rhs = _laned(right, in_use, spaces, "r", lane(right))
    pairs = lhs.join(rhs, [*by, *keys, "_lane"])
    for k, axes in enumerate(_numbered(spaces)):
        level = F.col(f"_level{k}")
        home = level == F.greatest(f"_lown{k}", f"_rown{k}")
        for i, a in axes:
            home = home & (F.col(f"_cell{i}") == _down(F.greatest(f"_la{i}", f"_ra{i}"), level))
            if a.time:
                meet = (F.col(f"_la{i}") <= F.col(f"_rb{i}")) & (F.col(f"_ra{i}") <= F.col(f"_lb{i}"))
            else:
                meet = (F.col(a.lo) <= F.col(a.r_hi)) & (F.col(a.r_lo) <= F.col(a.hi))
            pairs = pairs.filter(meet)
        pairs = pairs.filter(home)
    return pairs.select(*left.columns, *[c for c in right.columns if c not in by])


# rows of one side that a group held as arrays may have before it is cut
GROUP_ROWS = 20_000
PIECES = ("_piece0", "_piece1")


def cut_groups(lhs: DataFrame, rhs: DataFrame, at: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a cogroup by *at* with ``PIECES``: a group of many rows is cut on both
    sides, and every piece of one meets every piece of the other."""
    # groups to be cut: no more than a GROUP_ROWS-th of the rows, so they may be broadcast
    full = [df.groupBy(*at).agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("_pieces")).filter("_pieces > 1") for df in (lhs, rhs)]

    def cut(df: DataFrame, own: int) -> DataFrame:
        pieces = df
        for i in (0, 1):
            pieces = pieces.join(F.broadcast(full[i].withColumnRenamed("_pieces", f"_n{i}")), list(at), "left")
        mine, other = (F.coalesce(f"_n{i}", F.lit(1)) for i in (own, 1 - own))
        return pieces.withColumn(PIECES[own], F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), mine).cast("int")).withColumn(
            PIECES[1 - own], F.explode(F.sequence(F.lit(0), other - 1))).drop("_n0", "_n1")

    return cut(lhs, 0), cut(rhs, 1)


def overlap_pair_counts(left: DataFrame, right: DataFrame, spaces: Spaces, key: str, group: str, name: str = "n") -> DataFrame:
    """``key, group, n``: pairs of ``overlap_join`` counted by a column of either side, none of them made.

    The rows of a cell meet as arrays of numbers, so a pair is a few comparisons and never
    a row; what leaves a cell is a number for each left row and group.  Parts of one key may
    come in several rows.  A cell with many rows is cut on both sides, and every
    piece of one meets every piece of the other.
    """
    in_use = cells_in_use(left, right, spaces)
    axes = [(i, a, k) for k, some in enumerate(_numbered(spaces)) for i, a in some]
    at = [*[f"_level{k}" for k in range(len(spaces))], *[f"_cell{i}" for i, _, _ in axes]]
    every = (1 << len(axes) + len(spaces)) - 1

    def side(df: DataFrame, s: str, column: str) -> DataFrame:
        rows = listed(df.withColumn("_what", F.col(column)), in_use, spaces, s)
        # a pair counts where, on every axis, one of the two begins in the cell, and one is of the level
        bits = [_down(F.col(f"_{s}a{i}"), F.col(f"_level{k}")) == F.col(f"_cell{i}") for i, _, k in axes]
        bits += [F.col(f"_{s}own{k}") == F.col(f"_level{k}") for k in range(len(spaces))]
        flags = sum((F.when(b, F.lit(1 << n).cast("short")).otherwise(F.lit(0).cast("short")) for n, b in enumerate(bits)), F.lit(0).cast("short"))
        ends = []
        for i, a, _ in axes:
            lo, hi = (f"_{s}a{i}", f"_{s}b{i}") if a.time else ((a.lo, a.hi) if s == "l" else (a.r_lo, a.r_hi))
            kind = "bigint" if a.time else "double"
            ends += [F.col(lo).cast(kind).alias(f"lo{i}"), F.col(hi).cast(kind).alias(f"hi{i}")]
        return rows.select(*at, "_what", flags.alias("flags"), *ends)

    lhs, rhs = side(left, "l", key), side(right, "r", group)
    numbers, by = [i for i, _, _ in axes], [*at, *PIECES]
    schema = f"`{key}` {left.schema[key].dataType.simpleString()}, `{group}` {right.schema[group].dataType.simpleString()}, `{name}` bigint"

    def counted(l, r):
        import numpy as np
        import pandas as pd

        def framed(*columns):
            # as objects texts stay plain arrays
            return pd.DataFrame({c: pd.Series(x, dtype=x.dtype) for c, x in zip((key, group, name), columns, strict=True)})

        if not len(l) or not len(r):
            return framed(l["_what"].to_numpy()[:0], np.empty(0, object), np.zeros(0, np.int64))
        # both sides along the first axis: a block of left rows meets a stretch of the right ones
        l, r = l.sort_values(f"lo{numbers[0]}"), r.sort_values(f"lo{numbers[0]}")
        codes, names = pd.factorize(r["_what"], use_na_sentinel=False)
        l_ends = [(l[f"lo{i}"].to_numpy(), l[f"hi{i}"].to_numpy()) for i in numbers]
        r_ends = [(r[f"lo{i}"].to_numpy(), r[f"hi{i}"].to_numpy()) for i in numbers]
        l_flags, r_flags = l["flags"].to_numpy(), r["flags"].to_numpy()
        begin = r_ends[0][0]
        longest = (r_ends[0][1] - begin).max()
        longest += abs(longest) * 1e-9 + 1e-6
        parts = []
        for start in range(0, len(l), 128):
            block = slice(start, start + 128)
            first = np.searchsorted(begin, l_ends[0][0][block].min() - longest)
            last = np.searchsorted(begin, l_ends[0][1][block].max(), "right")
            if first >= last:
                continue
            hit = (l_flags[block, None] | r_flags[None, first:last]) == every
            for (a, b), (c, d) in zip(l_ends, r_ends, strict=True):
                hit &= a[block, None] <= d[None, first:last]
                hit &= c[None, first:last] <= b[block, None]
            row, col = np.nonzero(hit)
            found = np.bincount(row * len(names) + codes[first:last][col])
            some = np.flatnonzero(found)
            parts.append((start + some // len(names), some % len(names), found[some]))
        row, code, n = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, int)] * 3
        return framed(l["_what"].to_numpy()[row], np.asarray(names, dtype=object)[code], n)

    lhs, rhs = cut_groups(lhs, rhs, at)
    return lhs.groupBy(*by).cogroup(rhs.groupBy(*by)).applyInPandas(lambda l, r: counted(l, r), schema)


def overlap_counts(asked: DataFrame, windows: DataFrame, name: str = "n", by: Sequence[str] = ()) -> DataFrame:
    """*asked* with the number of *windows* (of the same *by*) that each of its windows meets, in column *name*.

    Both have ``start, end`` (ends included; NULL is open).  What begins by the end of a
    window and has not ended ahead of it meets it, so two running counts are enough: no
    pair is ever made.  Counts are taken hour by hour, and the hours are summed up.
    Windows of *windows* that end before they start are not counted, those of *asked* get 0.
    """
    def us(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    by = list(by)
    none, far = F.lit(0).cast("long"), 1 << 62
    # an open start lies ahead of all that ends, an open end behind all that begins
    keyed = asked.withColumns({"_a": F.coalesce(us("start"), F.lit(-far)), "_b": F.coalesce(us("end"), F.lit(far))})
    ask = keyed.select(*by, "_a", "_b").distinct()
    real = windows.select(*by, F.coalesce(us("start"), F.lit(-far)).alias("a"), F.coalesce(us("end"), F.lit(far)).alias("b")).filter("a <= b")
    # at one time ends are asked for first, then things happen, then starts are asked for
    marks = real.select(*by, F.explode(F.array(F.struct(F.col("a").alias("t"), F.lit(1).alias("begun"), F.lit(0).alias("ended")),
                                               F.struct(F.col("b").alias("t"), F.lit(0).alias("begun"), F.lit(1).alias("ended")))).alias("m"))
    marks = marks.groupBy(*by, "m.t").agg(F.sum("m.begun").alias("begun"), F.sum("m.ended").alias("ended")).withColumn("turn", F.lit(1))
    ends = F.explode(F.array(F.struct(F.col("_a").alias("t"), F.lit(0).alias("turn")), F.struct(F.col("_b").alias("t"), F.lit(2).alias("turn"))))
    asks = ask.select("*", ends.alias("m")).select(*by, "_a", "_b", "m.t", "m.turn", none.alias("begun"), none.alias("ended"))
    rows = asks.unionByName(marks, allowMissingColumns=True).withColumn("_hour", F.floor(F.col("t") / HOUR))
    inside = Window.partitionBy(*by, "_hour").orderBy("t", "turn").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = rows.groupBy(*by, "_hour").agg(F.sum("begun").alias("_begun"), F.sum("ended").alias("_ended"))
    hours = hours.select(*by, "_hour", *[F.coalesce(F.sum(c).over(before), none).alias(c) for c in ("_begun", "_ended")])
    sums = rows.withColumns({"begun": F.sum("begun").over(inside), "ended": F.sum("ended").over(inside)}).filter("turn <> 1")
    counted = sums.join(hours, [*by, "_hour"]).groupBy(*by, "_a", "_b").agg(
        (F.max(F.when(F.col("turn") == 2, F.col("begun") + F.col("_begun"))) - F.max(F.when(F.col("turn") == 0, F.col("ended") + F.col("_ended")))).alias("_n"))
    out = keyed.join(counted, [*by, "_a", "_b"])
    return out.withColumn(name, F.when(F.col("_a") <= F.col("_b"), F.col("_n")).otherwise(none)).select(*asked.columns, name)
