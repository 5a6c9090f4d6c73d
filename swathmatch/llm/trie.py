"""Prefix trie of conversations, from padded matrices of turn ids.

A conversation is laid out in segments of a bounded number of turns; a segment
knows the identity of the prefix ahead of it, a sum over those turns, so segments
of all depths are handled at once and a conversation may be of any length.  Segments
are dealt by ranges, so that those with a long common prefix lie together.  A task
sorts a padded matrix of turn ids (``lexsort``), marks where a column changes,
accumulates the marks over the columns (a prefix differs once a turn of it does),
and sums every depth from mark to mark (``reduceat``).  A node that several
matrices hold a part of is put together by its identity.

Sums over subtrees: each node belongs to its smallest member, whose nodes form a
chain down to its end.  The sum of a subtree is that of the rest of the node's own
chain and of the whole chains that hang below, whose owners are members of the node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathmatch.llm.ngram_join import _mixed
from swathmatch.llm.packing import running_start
from swathmatch.llm.shared import group_bounds, settle, whole_text
from swathmatch.operators.skew import salted_join

# turns of a segment, and cells of a matrix
SEGMENT, CELLS = 64, 1 << 20
# turn numbers, and segments or depths, whose sums are taken together
PART = 1000
# ids in a piece of a list that is digested
IDS = 20_000
# conversations that may share an opening, and its longest
GROUP, OPENING = 100, 5

NODE = ["depth", "hi", "lo"]
LANES = ["l0", "l1", "l2", "l3"]


def turns(convs: DataFrame) -> DataFrame:
    """conv, pos (from 0), said (digest of role and text), chars (code points): the
    turns of each conversation in the order of turn (NULL first; turns of one number by
    their digests).

    NULL role and text count as empty; rows without conv_id are left out, as they
    belong to no conversation; repeated rows are turns of their own; columns beside
    conv_id, turn, role and text are not read.
    """
    role = F.coalesce("role", F.lit(""))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, whole_text()), 256)
    rows = convs.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"),
        F.substring(said, 1, 32).alias("said"), F.length(whole_text()).cast("long").alias("chars"), F.lit(1).alias("one"))
    numbered = running_start(rows.withColumn("part", F.floor(F.col("turn") / PART)), ["conv"], "part", ["turn", "said"], "one", "pos")
    return settle(numbered.select("conv", F.col("pos").cast("long").alias("pos"), "said", "chars"))


def with_openings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their group, in the
    form of ``turns``, and conv of all of them (also of those left without a turn).

    Conversation c takes the first h turns of conversation ``c - c % 100`` (what there
    is of them), then its own behind its first h; h is ``crc32(c) % 6`` of the decimal
    number.  ``%`` is that of SQL, so numbers below 0 belong to 0, -100, ...
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (OPENING + 1)
    sizes = settle(rows.groupBy("conv").agg(F.count("*").alias("n")))
    base = (F.col("conv") - F.col("conv") % GROUP).alias("base")
    plan = sizes.select("conv", base, h.alias("h")).join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("there")), "base", "left")
    plan = settle(plan.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0)))).drop("there"))
    own = salted_join(rows.filter(F.col("pos") >= h), plan.select("conv", "h", "taken"), ["conv"])
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")).drop("h", "taken")
    # at most GROUP conversations take at most OPENING turns of one
    first = rows.filter(F.col("pos") < OPENING).withColumnRenamed("conv", "base")
    taken = first.join(plan.select("conv", "base", "taken"), "base").filter("pos < taken").select("conv", "pos", "said", "chars")
    return own.select("conv", "pos", "said", "chars").unionByName(taken), sizes.select("conv")


def _added(df: DataFrame, sums: list[str], part: str, order: list[str]) -> DataFrame:
    """*df* with, for each of *sums*, the sum over the rows ahead of the same conv, as ``<name>_ahead``.

    Sums of the parts are added up first; then each part on its own.
    """
    parts = df.groupBy("conv", part).agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    ahead = Window.partitionBy("conv").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("conv", part, *[F.coalesce(F.sum(f"_{c}").over(ahead), F.lit(0)).alias(f"_{c}") for c in sums])
    inner = Window.partitionBy("conv", part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(f"{c}_local") for c in sums])
    both = local.join(bases, ["conv", part])
    return both.select(*df.columns, *[(F.col(f"{c}_local") + F.col(f"_{c}")).alias(f"{c}_ahead") for c in sums])


def _laid_out(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Packed digests and lengths of segments, and the sum of their turns' marks."""
    for frame in frames:
        said = [np.frombuffer(bytes.fromhex(x), "<u8").reshape(-1, 2) for x in frame["said"]]
        sums = [_marks(s, int(k) * size + np.arange(len(s))).sum(axis=0) & 0xFFFFFFFF for s, k in zip(said, frame["segment"], strict=True)]
        yield pd.DataFrame({"conv": frame["conv"], "segment": frame["segment"], "n": [len(s) for s in said], "said": [s.tobytes() for s in said],
                            "chars": [np.asarray(c, "<i8").tobytes() for c in frame["chars"]],
                            **{c: [int(s[k]) for s in sums] for k, c in enumerate(LANES)}})


def _marks(said: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Four 32-bit numbers for each turn, from its digest and its place; their sums over
    a prefix, modulo 2^32, are the identity of that prefix."""
    place = _mixed(pos.astype(np.uint64) + np.uint64(1))
    x, y = _mixed(said[:, 0] ^ place), _mixed(said[:, 1] + place)
    return np.stack([x >> np.uint64(32), x & np.uint64(0xFFFFFFFF), y >> np.uint64(32), y & np.uint64(0xFFFFFFFF)], axis=1).astype(np.int64)


def _joined(a: Column, b: Column) -> Column:
    """Two 32-bit numbers as one signed 64-bit number."""
    return F.shiftleft(F.pmod(a, F.lit(1 << 32)), 32).bitwiseOR(F.pmod(b, F.lit(1 << 32)))


def _segments(rows: DataFrame, size: int, part: int) -> DataFrame:
    """conv, segment, n, said, chars, and the sums of marks ahead of the segment and in it."""
    turn = F.struct("pos", "said", "chars")
    cut = rows.groupBy("conv", F.floor(F.col("pos") / size).cast("long").alias("segment")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    cut = cut.select("conv", "segment", F.expr("array_join(transform(turns, t -> t.said), '')").alias("said"), F.expr("turns.chars").alias("chars"))
    columns = "conv long, segment long, n int, said binary, chars binary, l0 long, l1 long, l2 long, l3 long"
    packed = settle(cut.mapInPandas(lambda frames: _laid_out(frames, size), columns))
    sums = packed.select("conv", "segment", *LANES, F.floor(F.col("segment") / part).alias("part"))
    ahead = _added(sums, LANES, "part", ["segment"]).select("conv", "segment", *[F.pmod(f"{c}_ahead", F.lit(1 << 32)).alias(f"{c}_ahead") for c in LANES])
    return settle(packed.join(ahead, ["conv", "segment"]))


class _Matrix(NamedTuple):
    """Rows sorted by their turns: ids (padded with -1), sums of marks up to each column
    (that ahead of the segment first), chars, mark of a new prefix by column."""

    order: np.ndarray
    ids: np.ndarray
    sums: np.ndarray
    chars: np.ndarray
    new: np.ndarray


def _matrix(frame: pd.DataFrame, size: int) -> _Matrix:
    n = frame["n"].to_numpy()
    rows, width = len(frame), int(n.max())
    filled = np.arange(width)[None, :] < n[:, None]
    said = np.frombuffer(b"".join(frame["said"]), "<u8").reshape(-1, 2)
    ahead = frame[[f"{c}_ahead" for c in LANES]].to_numpy(np.int64)
    first = frame["segment"].to_numpy(np.int64) * size
    _, number = np.unique(said.view("V16").reshape(-1), return_inverse=True)
    ids = np.full((rows, width), -1, np.int64)
    ids[filled] = number
    chars = np.zeros((rows, width), np.int64)
    chars[filled] = np.frombuffer(b"".join(frame["chars"]), "<i8")
    marks = np.zeros((rows, width + 1, 4), np.int64)
    marks[:, 0] = ahead
    marks[:, 1:][filled] = _marks(said, (first[:, None] + np.arange(width))[filled])
    sums = np.cumsum(marks, axis=1) & 0xFFFFFFFF
    _, prefix = np.unique(np.column_stack([first, ahead]), axis=0, return_inverse=True)
    prefix = prefix.reshape(-1)
    order = np.lexsort((*ids.T[::-1], prefix))
    ids, prefix = ids[order], prefix[order]
    change = np.ones((rows, width + 1), bool)
    change[1:, 0] = prefix[1:] != prefix[:-1]
    change[1:, 1:] = ids[1:] != ids[:-1]
    return _Matrix(order, ids, sums[order], chars[order], np.logical_or.accumulate(change, axis=1)[:, 1:])


def _matrices(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """The rows of a task in frames of at most *most* rows, full ones but for the last."""
    waiting, rows = [], 0
    for frame in frames:
        while rows + len(frame) > most:
            yield pd.concat([*waiting, frame.iloc[: most - rows]], ignore_index=True)
            frame = frame.iloc[most - rows :]
            waiting, rows = [], 0
        waiting.append(frame)
        rows += len(frame)
    if rows:
        yield pd.concat(waiting, ignore_index=True)


def _key(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sums[:, 0] << 32 | sums[:, 1], sums[:, 2] << 32 | sums[:, 3]


def _counted(frames: Iterator[pd.DataFrame], size: int, most: int) -> Iterator[pd.DataFrame]:
    """Each matrix's part of its nodes: members, the smallest of them, the parent."""
    for frame in _matrices(frames, most):
        m = _matrix(frame, size)
        conv, first = frame["conv"].to_numpy()[m.order], frame["segment"].to_numpy()[m.order] * size
        for j in range(m.ids.shape[1]):
            at = np.flatnonzero(m.new[:, j])
            members, least = np.diff(np.append(at, len(conv))), np.minimum.reduceat(conv, at)
            real = m.ids[at, j] >= 0
            at = at[real]
            if not len(at):
                continue
            (hi, lo), (up_hi, up_lo) = _key(m.sums[at, j + 1]), _key(m.sums[at, j])
            yield pd.DataFrame({"depth": first[at] + j + 1, "hi": hi, "lo": lo, "up_hi": up_hi, "up_lo": up_lo, "n_convs": members[real],
                                "conv": least[real], "chars": m.chars[at, j]})


def _hanging(frames: Iterator[pd.DataFrame], size: int, most: int) -> Iterator[pd.DataFrame]:
    """Each matrix's part of what hangs below its nodes: whole chains whose owner passes
    the node ahead of its chain."""
    for frame in _matrices(frames, most):
        m = _matrix(frame, size)
        first, head = frame["segment"].to_numpy()[m.order] * size, frame["head"].to_numpy()[m.order]
        totals = frame[["saved", "leaves"]].to_numpy(np.int64)[m.order]
        for j in range(m.ids.shape[1]):
            at = np.flatnonzero(m.new[:, j])
            below = np.add.reduceat(np.where((first + j + 1 < head)[:, None], totals, 0), at, axis=0)
            real = (m.ids[at, j] >= 0) & below.any(axis=1)
            at, below = at[real], below[real]
            if len(at):
                hi, lo = _key(m.sums[at, j + 1])
                yield pd.DataFrame({"depth": first[at] + j + 1, "hi": hi, "lo": lo, "saved": below[:, 0], "leaves": below[:, 1]})


def _dealt(segments: DataFrame) -> DataFrame:
    """Segments by ranges of their prefixes; equal ones are spread by their conversations."""
    # a number given, as a matrix costs more than its few bytes tell
    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return segments.repartitionByRange(parts, "segment", *[f"{c}_ahead" for c in LANES], "said", "conv")


def _listed(ends: DataFrame, most: int) -> DataFrame:
    """ends_sha256 by node, from rows (depth, hi, lo, conv).

    Ordered ids are written out in pieces, by ranges of node and id; a node's digest
    is a running one over its pieces.
    """
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for s, e in group_bounds(frame, NODE):
                for a in range(s, e, most):
                    ids = frame["conv"].iloc[a : min(e, a + most)].tolist()
                    out.append((*frame[NODE].iloc[a].tolist(), ids[0], ",".join(map(str, ids))))
            yield pd.DataFrame(out, columns=[*NODE, "first", "ids"])

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for frame in frames:
            out = []
            for *key, ids in zip(*(frame[c] for c in [*NODE, "ids"]), strict=True):
                if key == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    key = "depth long, hi long, lo long"
    spread = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    written = spread.mapInPandas(pieces, f"{key}, first long, ids string")
    return written.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInPandas(digests, f"{key}, ends_sha256 string")


def prefix_trie(rows: DataFrame, members: DataFrame, size: int = SEGMENT, cells: int = CELLS, part: int = PART, ids: int = IDS) -> DataFrame:
    """A row for each node: each distinct sequence of the first turns of a conversation.

    *rows*: conv, pos, said, chars as ``turns`` gives them; *members*: conv of all
    conversations, also of those without a turn.  Returned: conv_id (the smallest
    member: a conversation that starts with the sequence), depth (turns), parent_conv_id
    (NULL for the root, which has no turn), n_convs (members), n_children, n_leaves
    (nodes without a child in the subtree, its top included), saved_tokens (over the
    subtree: code points of a node's last text, times its members but one), ends_sha256
    (of the ids of the members that end here, ascending, comma-joined), and node and
    parent, keys that stay the same in every trie.

    No conversations give no row, not even a root.  Nodes are told apart by 128-bit sums
    of 128-bit digests.  *size* (turns of a segment), *cells* (of a matrix), *part* and
    *ids* bound what is held at once; they change no result.
    """
    segments, most = _segments(rows, size, part), max(1, cells // size)
    parts = _dealt(segments).mapInPandas(
        lambda frames: _counted(frames, size, most), "depth long, hi long, lo long, up_hi long, up_lo long, n_convs long, conv long, chars long")
    inner = parts.groupBy(*NODE).agg(*[F.min(c).alias(c) for c in ("up_hi", "up_lo", "conv", "chars")], F.sum("n_convs").alias("n_convs"))
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = members.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        *[zero.alias(c) for c in NODE], none.alias("up_hi"), none.alias("up_lo"), "conv", zero.alias("chars"), "n_convs")
    found = settle(inner.unionByName(root))
    children = found.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))
    nodes = found.join(children.agg(F.count("*").alias("n_children")), NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = settle(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).withColumn("leaves", (F.col("n_children") == 0).cast("long")))
    below = nodes.select(*NODE, "conv", "saved", "leaves", (-F.floor(F.col("depth") / part)).alias("part"))
    chained = _added(below.withColumn("up", -F.col("depth")), ["saved", "leaves"], "part", ["up"])
    chained = chained.select(*NODE, *[(F.col(c) + F.col(f"{c}_ahead")).alias(f"own_{c}") for c in ("saved", "leaves")])
    chains = nodes.groupBy("conv").agg(F.min("depth").alias("head"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    # a chain counts for the nodes its owner passes ahead of it
    chains = settle(chains.filter((F.col("head") > 1) & ((F.col("saved") > 0) | (F.col("leaves") > 0))))
    ahead = salted_join(segments, chains, ["conv"]).filter(F.col("segment") * size + 1 < F.col("head"))
    hung = _dealt(ahead).mapInPandas(lambda frames: _hanging(frames, size, most), "depth long, hi long, lo long, saved long, leaves long")
    # all chains but its owner's hang below the root
    whole = nodes.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).select(*[zero.alias(c) for c in NODE], "saved", "leaves")
    hung = hung.groupBy(*NODE).agg(F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    last = F.max(F.struct("segment", "n", *LANES, *[f"{c}_ahead" for c in LANES])).alias("s")
    ended = segments.groupBy("conv").agg(last).select("conv", (F.col("s.segment") * size + F.col("s.n")).alias("depth"), *[
        _joined(*(F.col(f"s.{c}") + F.col(f"s.{c}_ahead") for c in pair)).alias(name) for name, pair in (("hi", LANES[:2]), ("lo", LANES[2:]))])
    ended = members.join(ended, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in NODE])
    out = nodes.join(chained, NODE).join(hung, NODE, "left").join(_listed(ended, ids), NODE, "left")
    out = out.join(whole.select(*NODE, F.col("saved").alias("all_saved"), F.col("leaves").alias("all_leaves")), NODE, "left")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv").alias("parent_conv_id"))
    out = salted_join(out, above, ["depth", "up_hi", "up_lo"], "left")
    total = [F.coalesce(f"all_{c}", F.col(f"own_{c}") + F.coalesce(f"hung_{c}", zero)).alias(name)
             for name, c in (("n_leaves", "leaves"), ("saved_tokens", "saved"))]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", *total,
                      F.coalesce("ends_sha256", nothing).alias("ends_sha256"), F.struct(*NODE).alias("node"),
                      F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))).alias("parent"))
