"""Removal of long repeated byte strings by bucket-pointer refinement.

A suffix array of all bytes would be many times the corpus.  Here each string of
``length`` bytes is represented by one of its suffixes, the one whose first q
bytes hash lowest, so equal strings pick it at the same offset.  These sampled
suffixes fall into initial q-gram buckets; a bucket with one member is final.
The others are refined by identifiers of what stands at later offsets: first of
the whole reach of a suffix, then of blocks of ever fewer strings.  Identifiers
settle a block in either direction: if another member has the same bytes all over
it, all its strings repeat; if none shares the bytes common to all its strings,
none does.  What an earlier round settled is not looked at again.

Strings are of bytes, or of words: then each word is one sign, an identifier of
eight bytes, and what stands between words does not count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathmatch.llm.bpe import Remembered
from swathmatch.llm.shared import forget, recorded, settle, whole_text

LENGTH = 400
# strings in a block, by round
ROUNDS = (48, 7, 1)
# bytes of a text handled at once
SEGMENT = 1 << 19
# identifiers of words that a worker remembers
REMEMBERED_WORDS = 60_000


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte; powers of an odd base and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    size = SEGMENT + (1 << 17)

    def powers(b: int) -> np.ndarray:
        p = np.full(size, b, dtype=np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    return np.random.default_rng(3).integers(0, 1 << 64, 256, dtype=np.uint64), powers(base), powers(pow(base, -1, 1 << 64))


@lru_cache(maxsize=1)
def _identifiers() -> Remembered:
    return Remembered(lambda word: hashlib.blake2b(word, digest_size=8).digest(), REMEMBERED_WORDS)


def word_ids(data: bytes) -> bytes:
    """Eight bytes for each word; white space is as in ``word_bounds``."""
    return b"".join(map(_identifiers().__getitem__, data.split()))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end; they stand between blanks and the signs 9 to 13."""
    b = np.frombuffer(data, dtype=np.uint8)
    space = np.concatenate([[True], (b == 32) | ((b >= 9) & (b <= 13)), [True]])
    return np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])


def gram_hashes(numbers: np.ndarray, q: int) -> np.ndarray:
    _, up, down = _tables()
    sums = np.zeros(len(numbers) + 1, np.uint64)
    np.cumsum(numbers * up[: len(numbers)], out=sums[1:])
    h = (sums[q:] - sums[:-q]) * down[: len(numbers) - q + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def lowest_in_windows(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of *w* values, where its lowest stands (the first, in a tie)."""
    low = np.uint64((1 << 20) - 1)
    padded = np.full(-(-len(h) // w) * w, ~np.uint64(0))
    padded[: len(h)] = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - w + 1
    return (np.minimum(behind[:n], ahead[w - 1 : w - 1 + n]) & low).astype(np.int64)


def suffixes(data: bytes, length: int, q: int, words: bool = False) -> Iterator[list[int]]:
    """bucket, identifier of the reach, position, first and last start of the strings
    which pick this suffix, how many follow each other with the same reach (as in a
    text of one repeated word), and the last start of those.

    *data*: a byte for each sign, or the eight of each word."""
    width = 8 if words else 1
    for at in range(0, len(data) // width - length + 1, SEGMENT):
        b = np.frombuffer(data[at * width : (at + SEGMENT + length - 1) * width], dtype="<u8" if words else np.uint8)
        h = gram_hashes(b if words else _tables()[0][b], q)
        picked = lowest_in_windows(h, length - q + 1)
        first = np.flatnonzero(np.concatenate([[True], picked[1:] != picked[:-1]]))
        last = np.append(first[1:], len(picked)) - 1
        pos = picked[first]
        run: list[int] | None = None
        for g, p, lo, hi in zip(h[pos].view(np.int64).tolist(), pos.tolist(), first.tolist(), last.tolist(), strict=True):
            reach = hashlib.blake2b(data[(at + lo) * width : (at + hi + length) * width], digest_size=8, salt=(p - lo).to_bytes(4, "little")).digest()
            name = int.from_bytes(reach, "little", signed=True)
            if run and run[:2] == [g, name]:
                run[5:] = run[5] + 1, at + hi
            else:
                if run:
                    yield run
                run = [g, name, at + p, at + lo, at + hi, 1, at + hi]
        if run:
            yield run


def _bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, mark, data: rows with the same id and text have the same key, and the
    same result."""
    return docs.select(*_key(F.col("text")), _bytes(F.col("text")).alias("data"))


def _key(text: Column) -> tuple[Column, Column]:
    """doc, mark: the id and 64 bits of the text; rows without an id are told apart by 128."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("nameless"), text)).alias("doc"), F.xxhash64(text).alias("mark")


def _sampled(keyed: DataFrame, length: int, q: int, words: bool) -> DataFrame:
    """The columns of ``suffixes``, doc, mark; of words also the bytes of the reach, by
    first byte and number."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if words:
            _identifiers().only()
        for frame in frames:
            for doc, mark, data in zip(frame["doc"], frame["mark"], frame["data"], strict=True):
                signs = word_ids(data) if words else data
                if len(signs) >= length * (8 if words else 1):
                    out = pd.DataFrame(list(suffixes(signs, length, q, words)), columns=["bucket", "reach", "pos", "lo", "hi", "n", "till"])
                    if words:
                        starts, ends = word_bounds(data)
                        out["byte"] = starts[out["lo"]]
                        out["bytes"] = ends[out["hi"] + length - 1] - out["byte"]
                    yield out.assign(doc=doc, mark=mark)

    more = "byte int, bytes int, " if words else ""
    return keyed.mapInPandas(_joined(run), f"bucket long, reach long, pos int, lo int, hi int, n int, till int, {more}doc long, mark long")


def _joined(run, rows: int = 50_000):
    """Put the small frames that *run* yields together."""
    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for out in run(frames):
            held.append(out)
            n += len(out)
            if n >= rows:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    return whole


def _reaches(members: DataFrame, keyed: DataFrame, length: int, words: bool) -> DataFrame:
    """member, bucket, one, doc, mark, pos, lo, hi and the bytes of the reach."""
    names = [c for c in members.columns if c not in ("doc", "mark")]
    wanted = members.groupBy("doc", "mark").agg(F.collect_list(F.struct(*names)).alias("m"))
    first, number = (F.col("m.byte"), F.col("m.bytes")) if words else (F.col("m.lo"), F.col("m.hi") - F.col("m.lo") + length)
    part = keyed.join(wanted, ["doc", "mark"]).select("doc", "mark", "data", F.explode("m").alias("m")).select(
        "doc", "mark", *(f"m.{c}" for c in ("member", "bucket", "one", "pos", "lo", "hi")), F.substring(F.col("data"), first + 1, number).alias("data"))
    return part.dropDuplicates(["member"])


def _blocks(size: int, length: int, words: bool):
    """Split the unsettled offsets of each member into blocks of *size* strings."""
    width = 8 if words else 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for member, bucket, one, pos, lo, hi, data, a, b in zip(
                    *(frame[c] for c in ("member", "bucket", "one", "pos", "lo", "hi", "data", "a", "b")), strict=True):
                signs = word_ids(data) if words else data
                # a string starting d signs ahead of the suffix is in block d // size
                for k in range(a // size, b // size + 1):
                    d0, d1 = max(a, k * size), min(b, k * size + size - 1)
                    core = signs[(pos - k * size - lo) * width : (pos - (k * size + size - 1) + length - lo) * width] if size > 1 else b""
                    whole = signs[(pos - d1 - lo) * width : (pos - d0 + length - lo) * width]
                    name = hashlib.blake2b(core or whole, digest_size=16, salt=k.to_bytes(4, "little")).digest()
                    same = name if size == 1 else hashlib.blake2b(
                        whole, digest_size=16, salt=d0.to_bytes(4, "little") + d1.to_bytes(4, "little")).digest()
                    out.append((member, bucket, one, name, same, d0, d1))
            yield pd.DataFrame(out, columns=["member", "bucket", "one", "core", "whole", "a", "b"])

    return run


def _refined(reaches: DataFrame, length: int, rounds: tuple[int, ...], words: bool) -> list[DataFrame]:
    """Ranges (doc, mark, lo, hi) of repeated strings, a table for each round."""
    open_ = reaches.select("member", (F.col("pos") - F.col("hi")).alias("a"), (F.col("pos") - F.col("lo")).alias("b"))
    done = []
    for size in rounds:
        cut = reaches.join(open_, "member").mapInPandas(
            _blocks(size, length, words), "member long, bucket long, one boolean, core binary, whole binary, a int, b int")
        blocks = settle(cut)
        equal = settle(blocks.groupBy("bucket", "core", "whole").agg(F.count("*").alias("n"), F.min("member").alias("first")))
        shared = equal.groupBy("bucket", "core").agg(F.count("*").alias("kinds"))
        seen = blocks.join(equal, ["bucket", "core", "whole"])
        found = seen.filter("n > 1 AND one").join(reaches.select("member", "doc", "mark", "pos"), "member")
        done.append(found.select("doc", "mark", (F.col("pos") - F.col("b")).alias("lo"), (F.col("pos") - F.col("a")).alias("hi")))
        # one member of each kind goes on, where others share the core with it
        open_ = seen.filter("member = first").join(shared.filter("kinds > 1"), ["bucket", "core"]).select("member", "a", "b")
    return done


def repeated_spans(docs: DataFrame, length: int = LENGTH, words: bool = False) -> DataFrame:
    """doc, mark, spans: merged ranges [start, end) of bytes (of *words*) covered by a
    string of *length* of them which starts anywhere else too, in this text or another.

    *docs*: doc_id, text (not NULL).  The key (doc, mark) is that of ``keyed_rows``.
    """
    q = max(1, length // 4)
    keyed = _keyed(docs)
    paths: list[str] = []
    with recorded(paths):
        every = settle(_sampled(keyed, length, q, words))
        # written before it is joined: Spark splits hot keys between plain exchanges only
        often = settle(every.groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 1").select("bucket"))
    sampled = settle(every.join(often, "bucket", "left_semi"))
    # most suffixes have a bucket of their own; the rest is written, so they can go
    forget(docs.sparkSession, paths)
    more = ["byte", "bytes"] if words else []
    kinds = settle(sampled.groupBy("bucket", "reach").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "mark", "pos", "lo", "hi", *more)).alias("m")))
    whole = sampled.join(kinds.filter("n > 1").select("bucket", "reach"), ["bucket", "reach"], "left_semi").select("doc", "mark", "lo", F.col("till").alias("hi"))
    several = settle(kinds.groupBy("bucket").agg(F.count("*").alias("k")).filter("k > 1").select("bucket"))
    members = settle(kinds.join(several, "bucket", "left_semi").select(
        F.monotonically_increasing_id().alias("member"), "bucket", (F.col("n") == 1).alias("one"), "m.*"))
    reaches = settle(_reaches(members, keyed, length, words))
    rounds = tuple(r for r in ROUNDS if r < length - q) or (1,)
    ranges = whole
    for found in _refined(reaches, length, rounds, words):
        ranges = ranges.unionByName(found)
    # a row lists ranges of one text only
    listed = ranges.groupBy("doc", "mark").agg(F.collect_set(F.struct("lo", "hi")).alias("r"))
    return listed.mapInPandas(_merged(length), "doc long, mark long, spans array<struct<start:int,end:int>>")


def union(ranges: Iterable[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _merged(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            spans = [[{"start": s, "end": e} for s, e in union((r["lo"], r["hi"] + length) for r in ranges)] for ranges in frame["r"]]
            yield pd.DataFrame({"doc": frame["doc"], "mark": frame["mark"], "spans": spans})

    return run


def with_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows and columns of *docs* and ``repeated_spans``: merged byte ranges
    (NULL where nothing repeats).

    A NULL text counts as empty; texts shorter than *length* have no spans; rows
    which are equal in doc_id and text are texts of their own, so they repeat each
    other; rows without a doc_id are told apart by their texts.
    """
    return _beside(docs, {"repeated_spans": repeated_spans(docs.select("doc_id", whole_text()), length)})


def _beside(docs: DataFrame, spans: dict[str, DataFrame]) -> DataFrame:
    """*docs* with a column for each table of spans; these are put together first, so the
    texts are shuffled once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc, mark = _key(text)
    own = docs.withColumns({"_doc": doc, "_mark": mark})
    tables = [t.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), F.col("spans").alias(name)) for name, t in spans.items()]
    every = reduce(lambda a, b: a.join(b, ["_doc", "_mark"], "full"), tables)
    return own.join(every, ["_doc", "_mark"], "left").drop("_doc", "_mark")


def _settled_spans(docs: DataFrame, length: int, words: bool) -> DataFrame:
    """``repeated_spans``, without the tables written on the way."""
    paths: list[str] = []
    with recorded(paths):
        spans = settle(repeated_spans(docs.select("doc_id", whole_text()), length, words))
    forget(docs.sparkSession, paths[:-1])
    return spans


def cut_texts(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """All rows and columns of *docs*, their texts without the repeated bytes: those in
    strings of *length* bytes and, if *words* is given, in passages of so many words.

    A character of which only a part repeats stays.  Words are equal by their bytes,
    whatever white space is between them.  A NULL text stays NULL."""
    spans, names = {"repeated_spans": _settled_spans(docs, length, False)}, docs.columns
    if words:
        spans["repeated_words"] = _settled_spans(docs, words, True)
    rows = _beside(docs, spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            by_word = batch.column("repeated_words").to_pylist() if words else [None] * len(texts)
            for i, (spans, passages) in enumerate(zip(batch.column("repeated_spans").to_pylist(), by_word, strict=True)):
                if spans or passages:
                    data, at, kept = texts[i].encode(), 0, []
                    ranges = [(s["start"], s["end"]) for s in spans or ()]
                    if passages:
                        starts, ends = word_bounds(data)
                        ranges += [(int(starts[s["start"]]), int(ends[s["end"] - 1])) for s in passages]
                    for start, end in union(ranges):
                        while start < end and data[start] & 0xC0 == 0x80:
                            start += 1
                        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
                            end -= 1
                        kept.append(data[at:start])
                        at = end
                    texts[i] = b"".join([*kept, data[at:]]).decode()
            columns = {**dict(zip(batch.schema.names, batch.columns, strict=True)), "text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return rows.mapInArrow(run, docs.schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary): each text without the
    bytes of its ``repeated_spans``.  See ``with_spans`` for the corner cases."""
    rows = with_spans(docs.select("doc_id", whole_text()), length).select(
        F.col("doc_id").cast("long").alias("doc_id"), _bytes(F.col("text")).alias("data"), "repeated_spans")
    spans = F.coalesce("repeated_spans", F.array().cast("array<struct<start:int,end:int>>"))
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length("data")))
    parts = F.zip_with(ends, starts, lambda e, s: F.substring(F.col("data"), e + 1, s - e))
    kept = F.when(F.col("repeated_spans").isNull(), F.col("data")).otherwise(
        F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p)))
    return rows.select("doc_id", F.length("data").cast("long").alias("n_bytes"), kept.alias("kept"),
                       F.size(spans).cast("long").alias("n_spans")).withColumn("n_removed", F.col("n_bytes") - F.length("kept"))
