"""N-gram Jaccard self-join by MinHash banding, and its near-duplicate classes.

Texts with the same n-gram set are one class from the start.  Classes meet where
they share a band of their signature; a bucket is cut into blocks, and a pair of
blocks is looked at by one task, so a bucket of any size needs little memory.  A
pair of classes belongs to the first band it shares: there, and only there, its
full n-gram sets are compared.  Tasks return link counts and the links that hold
a block together, never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathmatch.llm.bpe import Remembered
from swathmatch.llm.components import components
from swathmatch.llm.shared import group_bounds, runs_of_keys, settle, whole_text

NGRAM = 5
SIMILARITY = 0.8
RECALL = 0.9999
# members of a bucket that one side of a comparison holds, and n-grams of them all
BLOCK, GRAMS = 1024, 1 << 20
# words whose hashes a worker remembers
WORDS = 150_000


def choose_bands(similarity: float, recall: float, most: int = 128) -> tuple[int, int]:
    """Bands and rows: the most selective rows for which enough bands fit in *most*
    hashes to find a pair at *similarity* with probability *recall*."""
    best = (most, 1)
    for rows in range(1, 17):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of hashed word n-grams and their signatures."""

    def __init__(self, n: int, bands: int, rows: int):
        self.n, self.bands, self.rows = n, bands, rows
        self.word = Remembered(lambda w: int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little"), WORDS)
        self.word.only()
        rng = np.random.default_rng(8)
        self.xors = rng.integers(0, 1 << 64, bands * rows, dtype=np.uint64)
        self.odds = rng.integers(0, 1 << 64, bands * rows, dtype=np.uint64) | np.uint64(1)

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct n-grams; a text of fewer words is one gram of them all."""
        words = text.split()
        if not words:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.word.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(w))
        h = np.full(len(w) - n + 1, n, np.uint64)
        for k in range(n):
            h = _mixed(h + w[k : len(w) - n + 1 + k])
        return np.unique(h)

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(len(self.xors), ~np.uint64(0))
        for i in range(0, len(grams), 2048):
            part = grams[i : i + 2048]
            low = np.minimum(low, ((part[None, :] ^ self.xors[:, None]) * self.odds[:, None]).min(axis=1))
        low = low.reshape(self.bands, self.rows)
        h = np.arange(self.bands, dtype=np.uint64)
        for k in range(self.rows):
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + low[:, k])
        return h


def _signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key of the n-gram set, its size, band hashes (packed)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sh = Shingles(n, bands, rows)
        for frame in frames:
            out = []
            for text in frame["text"]:
                grams = sh.of(text)
                key = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                out.append((key, len(grams), sh.band_hashes(grams).tobytes() if len(grams) else None))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "key": [x[0] for x in out], "size": [x[1] for x in out],
                                "bands": [x[2] for x in out]})

    return docs.mapInPandas(run, "doc_id long, key binary, size int, bands binary")


def _grams_of(rows: DataFrame, n: int) -> DataFrame:
    """key, grams (packed) of rows (text, key) whose text has this key."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sh = Shingles(n, 1, 1)
        for frame in frames:
            grams = [sh.of(t).tobytes() for t in frame["text"]]
            ok = [hashlib.blake2b(g, digest_size=16).digest() == k for g, k in zip(grams, frame["key"], strict=True)]
            yield pd.DataFrame({"key": frame["key"], "grams": grams})[ok]

    return rows.mapInPandas(run, "key binary, grams binary")


def _by_band(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each band of a class; most meet nothing, so they carry no more than names."""
    for frame in frames:
        if len(frame):
            each = np.frombuffer(b"".join(frame["bands"]), np.int64)
            rows = frame.loc[frame.index.repeat(len(each) // len(frame)), ["key", "size"]].reset_index(drop=True)
            yield rows.assign(bucket=each)[["bucket", "key", "size"]]


def _first_shared(bands_a: np.ndarray, bands_b: np.ndarray, bucket: np.uint64) -> np.ndarray:
    """Pairs (rows of a, rows of b) whose first shared band is this bucket."""
    at = int(np.flatnonzero(bands_a[0] == bucket)[0])
    first = np.ones((len(bands_a), len(bands_b)), dtype=bool)
    for k in range(at):
        first &= bands_a[:, k][:, None] != bands_b[:, k][None, :]
    return first


def _sides(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the first block, rows of the second, and the packed bands."""
    bands = np.frombuffer(b"".join(frame["bands"]), np.uint64).reshape(len(frame), -1)
    i, j, own = (frame[c].to_numpy() for c in ("bi", "bj", "block"))
    return np.flatnonzero(own == i), np.flatnonzero(own == j), bands


TASK = ["bucket", "bi", "bj"]


def _wanted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members which have a partner to be compared with in their pair of blocks."""
    for frame in runs_of_keys(frames, TASK):
        keep = np.zeros(len(frame), dtype=bool)
        for s, e in group_bounds(frame, TASK):
            if e - s < 2:
                continue
            part = frame.iloc[s:e]
            a, b, bands = _sides(part)
            if not len(a) or not len(b):
                continue
            pair = _first_shared(bands[a], bands[b], np.int64(part["bucket"].iloc[0]).view(np.uint64))
            if part["bi"].iloc[0] == part["bj"].iloc[0]:
                np.fill_diagonal(pair, False)
            hit = np.zeros(e - s, dtype=bool)
            hit[a] |= pair.any(axis=1)
            hit[b] |= pair.any(axis=0)
            keep[s:e] = hit
        yield frame[keep]


def _linked(similarity: float):
    """Compare the full sets of each pair of blocks: counts and links that span."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs_of_keys(frames, TASK):
            out = []
            for s, e in group_bounds(frame, TASK):
                part = frame.iloc[s:e]
                a, b, bands = _sides(part)
                if not len(a) or not len(b):
                    continue
                same = part["bi"].iloc[0] == part["bj"].iloc[0]
                pair = _first_shared(bands[a], bands[b], np.int64(part["bucket"].iloc[0]).view(np.uint64))
                if same:
                    pair = np.triu(pair, 1)
                out += _compare(part, a, b, pair, similarity)
            yield pd.DataFrame(out, columns=["key", "other", "links"])

    return run


def _compare(part: pd.DataFrame, a: np.ndarray, b: np.ndarray, pair: np.ndarray, similarity: float) -> list[tuple]:
    keys, copies = part["key"].to_list(), part["copies"].to_numpy()
    grams = [np.frombuffer(g, np.uint64) for g in part["grams"]]
    sizes = np.array([len(g) for g in grams])
    flat = np.concatenate(grams)
    universe, code = np.unique(flat, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    links = np.zeros(len(part), dtype=np.int64)
    root = list(range(len(part)))
    out = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    mark = np.zeros(len(universe), dtype=np.int8)
    for row, i in enumerate(a):
        cols = b[np.flatnonzero(pair[row])]
        # sets of too different a size cannot be similar enough
        cols = cols[np.minimum(sizes[cols], sizes[i]) >= similarity * np.maximum(sizes[cols], sizes[i]) - 1e-9]
        if not len(cols):
            continue
        mark[code[starts[i] : starts[i] + sizes[i]]] = 1
        for j in cols:
            common = int(mark[code[starts[j] : starts[j] + sizes[j]]].sum())
            if common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9:
                links[i] += copies[j]
                links[j] += copies[i]
                x, y = find(int(i)), find(int(j))
                if x != y:
                    root[x] = y
                    out.append((keys[i], keys[j], 0))
        mark[code[starts[i] : starts[i] + sizes[i]]] = 0
    return out + [(keys[i], None, int(n)) for i, n in enumerate(links) if n]


def near_duplicates(docs: DataFrame, n: int = NGRAM, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per row of *docs*: doc_id, class_id, n_links, n_copies, class_size.

    Two texts are linked where the Jaccard similarity of their sets of word
    n-grams is *similarity* or more (words between white space, case kept; a text
    of fewer than *n* words is one gram).  ``n_links`` counts the other rows linked
    with this one, ``n_copies`` those among them with the same set; ``class_id`` is
    the smallest doc_id among all rows reached over links, ``class_size`` their
    number.  Bands and rows are chosen so that a pair right at the threshold is met
    with probability *recall*; pairs which meet are compared exactly.

    A NULL text counts as empty; a text without words has no links and is a class
    of its own; rows without a doc_id take no part in naming a class (the class of
    such rows only has a NULL name); repeated rows are copies of each other;
    columns beside doc_id and text are not read.
    """
    bands, rows = choose_bands(similarity, recall)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text())
    signed = settle(_signed(docs, n, bands, rows))
    filled = signed.filter(F.col("size") > 0)
    classes = settle(filled.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
                                               F.first("size").alias("size"), F.first("bands").alias("bands")))
    # buckets of two classes or more, each member in its block
    members = classes.mapInPandas(_by_band, "bucket long, key binary, size int")
    # blocks hold few members and few n-grams: long texts meet in smaller ones
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / GRAMS))
    buckets = settle(members.groupBy("bucket").agg(F.count("*").alias("m"), blocks.alias("nb")).filter("m > 1").select("bucket", "nb"))
    # the signature, many times a name, goes to the members of shared buckets only
    members = members.join(buckets, "bucket").join(classes.select("key", "doc_id", "copies", "bands"), "key")
    members = members.withColumn("block", F.pmod(F.xxhash64("key"), F.col("nb")))
    # block b meets every block: as the first of a pair or as the second
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("o")
    tasks = members.select("*", other).select(
        "bucket", F.least("block", "o").alias("bi"), F.greatest("block", "o").alias("bj"), "block", "key", "doc_id", "copies", "bands")
    schema = "bucket long, bi long, bj long, block long, key binary, doc_id long, copies long, bands binary"
    wanted = settle(_dealt(tasks).mapInPandas(_wanted, schema))
    # sets of the members that are to be compared, from one text of each class
    needed = wanted.select("doc_id", "key").distinct()
    known = docs.filter(F.col("doc_id").isNotNull()).join(needed, "doc_id").select("text", "key")
    nameless = docs.filter(F.col("doc_id").isNull()).select("text")
    if not nameless.isEmpty():
        known = known.unionByName(_keyed_nameless(nameless, needed, n))
    grams = _grams_of(known, n).groupBy("key").agg(F.first("grams").alias("grams"))
    compared = settle(_dealt(wanted.join(grams, "key").drop("doc_id")).mapInPandas(_linked(similarity), "key binary, other binary, links long"))
    named = components(compared.filter("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    counts = compared.groupBy("key").agg(F.sum("links").alias("links"))
    info = classes.select("key", "copies", "doc_id").join(named.select(F.col("node").alias("key"), "root"), "key", "left")
    info = info.join(counts, "key", "left").withColumn("root", F.coalesce("root", "key"))
    sizes = info.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    info = info.join(sizes, "root").select(
        "key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), (F.col("copies") - 1).alias("n_copies"), "class_size")
    with_words = filled.select("doc_id", "key").join(info, "key").drop("key")
    wordless = signed.filter(F.col("size") == 0).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_copies"),
        F.lit(1).cast("long").alias("class_size"))
    return with_words.unionByName(wordless)


def _dealt(tasks: DataFrame) -> DataFrame:
    return tasks.repartition(*TASK).sortWithinPartitions(*TASK)


def _keyed_nameless(texts: DataFrame, needed: DataFrame, n: int) -> DataFrame:
    """text, key of rows without a doc_id whose class is needed."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sh = Shingles(n, 1, 1)
        for frame in frames:
            keys = [hashlib.blake2b(sh.of(t).tobytes(), digest_size=16).digest() for t in frame["text"]]
            yield pd.DataFrame({"text": frame["text"], "key": keys})

    keyed = texts.mapInPandas(run, "text string, key binary")
    return keyed.join(needed.filter("doc_id IS NULL").select("key"), "key").select("text", "key")
