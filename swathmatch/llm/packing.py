"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of documents.  A round is worth one window and hands every
queue a quantum, its target share of that window; the queue sends as many tokens and
cuts the document in which its credit ends.  A queue whose quantum is below ``LEAST``
tokens saves its credit up and sends that many at once, in a round of its own turn, so
that texts are not cut into crumbs.  All rounds together form one stream, which windows
cut without a gap, so deficits carry over windows and over the partitions that hold the
queues.

The credit a queue has been given by round k is k quanta, so the round of a token
follows from the tokens ahead of it in its queue: no task has to see a whole queue.
Prefix sums are taken in two levels of about sqrt(rows) each.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathmatch.llm.bpe import REMEMBERED, Remembered, byte_letters
from swathmatch.llm.shared import settle, whole_text

WINDOW = 4096
# tokens a queue sends at least at once
LEAST = 64
# id put behind each document
END_ID = 2
# signs which end a word: no rule of the vocabulary joins them to a letter
CLOSING = ".,!%$#&*|"


class Chunks:
    """Ids of white-space separated chunks, for a lower-case byte-level vocabulary
    that drops white space.

    Most new chunks are a known word with another case or closing sign; those are
    put together from what is remembered.
    """

    def __init__(self, path: str, remembered: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.letters = byte_letters()
        self.ids = Remembered(self._encode, remembered)

    def _encode(self, chunk: str) -> bytes:
        word = chunk.rstrip(CLOSING)
        if word and len(word) < len(chunk) and word[-1].isalpha() and word[-1] < "\u0100":
            return self.ids[word] + self.ids[chunk[len(word) :]]
        if chunk.isalpha() and max(chunk) < "\u0100":
            # letters which every normalisation of the file leaves alone, but for case
            low = chunk.lower()
            if low != chunk:
                return self.ids[low]
            letters = "".join([self.letters[b] for b in low.encode()])
            return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.ids.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=4)
def chunks(path: str, remembered: int = REMEMBERED) -> Chunks:
    return Chunks(path, remembered)


def tokenized(docs: DataFrame, path: str, remembered: int = REMEMBERED) -> DataFrame:
    """row, doc_id, source, n, ids: each row of *docs* under a key of its own."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = chunks(path, remembered)
        coder.ids.only()
        row = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], dtype=coder.dtype).tobytes()
        width = len(end)
        for frame in frames:
            ids = [coder.encode(t) + end for t in frame["text"]]
            yield pd.DataFrame({"row": np.arange(row, row + len(ids)), "doc_id": frame["doc_id"], "source": frame["source"],
                                "n": [len(x) // width for x in ids], "ids": ids})
            row += len(ids)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                       whole_text())
    return settle(rows.mapInPandas(run, "row long, doc_id long, source string, n long, ids binary"))


def running_start(df: DataFrame, keys: list[str], part: str, order: list[str], value: str, name: str) -> DataFrame:
    """*name*: the sum of *value* over the rows ahead, by (*part*, *order*) within *keys*.

    Sums of the parts are added up first; then each part is ordered on its own.
    """
    parts = df.groupBy(*keys, part).agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(*keys, part, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return local.join(base, [*keys, part]).withColumn(name, F.col("_base") + F.col("_local")).drop("_base", "_local")


def quanta(lengths: DataFrame, targets: Mapping[str, float] | None, window: int, least: int, total: int) -> DataFrame:
    """source, _burst, _turns, _phase: what a queue sends at once, the rounds it saves up
    for it, and which of these rounds is its first (as a part of them)."""
    sources = lengths.groupBy("source").agg(F.sum("n").alias("_tokens"))
    share = F.col("_tokens") / F.lit(float(total))
    if targets is not None:
        given = F.lit(None).cast("double")
        for name, part in targets.items():
            given = F.when(F.col("source") == name, float(part) / sum(targets.values())).otherwise(given)
        # a source without a target gets its own share of all tokens
        share = F.coalesce(given, share)
    quantum = share * window
    # a queue shorter than that is sent as a whole
    burst = F.greatest(quantum, F.least(F.lit(float(least)), F.col("_tokens").cast("double")))
    chance = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return sources.select("source", burst.alias("_burst"), (burst / quantum).alias("_turns"),
                          F.when(burst > quantum, chance).otherwise(0.0).alias("_phase"))


def placed(lengths: DataFrame, targets: Mapping[str, float] | None, window: int, least: int = LEAST) -> tuple[DataFrame, int]:
    """Where the parts of each row go in the packed stream, and the stream's length.

    *lengths*: row, source, n.  The result has ``row`` and ``parts``, an array of
    (start, n, place) in order of start.
    """
    schema = "array<struct<start:bigint,n:bigint,place:bigint>>"
    n_rows, total = lengths.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_rows:
        return lengths.select("row", F.lit(None).cast(schema).alias("parts")), 0
    queues = lengths.withColumn("_mix", F.xxhash64("row"))
    queues = queues.withColumn("_part", F.pmod("_mix", F.lit(math.isqrt(n_rows) + 1)))
    queued = running_start(queues, ["source"], "_part", ["_mix", "row"], "n", "_ahead")
    end, burst, j = F.col("_ahead") + F.col("n"), F.col("_burst"), F.col("_j")
    # one burst more on either side, as quotients are rounded; those without a token go
    bursts = queued.join(quanta(lengths, targets, window, least, total), "source").withColumn("_j", F.explode(F.sequence(
        F.greatest(F.floor(F.col("_ahead") / burst) - 1, F.lit(0)), F.floor(end / burst) + 1)))
    lo, hi = F.greatest(F.ceil(j * burst), F.col("_ahead")), F.least(F.ceil((j + 1) * burst), end)
    sent = bursts.select("row", "source", (lo - F.col("_ahead")).alias("start"), (hi - lo).alias("n"), lo.alias("_at"),
                         F.floor((j + F.col("_phase")) * F.col("_turns")).alias("_round")).filter("n > 0")
    # a part of the stream holds about sqrt(all rounds) rounds
    step = math.isqrt(total // window + 1) + 1
    stream = sent.withColumn("_block", F.floor(F.col("_round") / step))
    at = running_start(stream, [], "_block", ["_round", "source", "_at"], "n", "place")
    parts = F.array_sort(F.collect_list(F.struct("start", "n", "place")))
    return at.groupBy("row").agg(parts.cast(schema).alias("parts")), total


def joined(parts: list) -> list[list[int]]:
    """start, n, place of a row's parts, those that follow each other in the stream as one."""
    out: list[list[int]] = []
    for p in parts:
        start, n, place = p["start"], p["n"], p["place"]
        if out and out[-1][2] + out[-1][1] == place:
            out[-1][1] += n
        else:
            out.append([start, n, place])
    return out


def window_starts(total: int, window: int) -> list[int]:
    """Starts of the sequences behind the last full window: powers of two, falling."""
    at, rest, out = total - total % window, total % window, []
    while rest:
        out.append(at)
        step = 1 << (rest.bit_length() - 1)
        at, rest = at + step, rest - step
    return out


def pieces_of(place: int, n: int, total: int, window: int, tail: list[int]) -> list[tuple[int, int, int, int]]:
    """start, length, sequence, offset of the pieces of what stands at *place*."""
    full = total // window
    starts = [*range(place // window * window, min(place + n, full * window), window), *tail]
    bounds = sorted({place, *(s for s in starts if place < s < place + n), place + n})
    out = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        if a < full * window:
            seq, first = a // window, a // window * window
        else:
            k = max(i for i, s in enumerate(tail) if s <= a)
            seq, first = full + k, tail[k]
        out.append((a - place, b - a, seq, a - first))
    return out


def pack(docs: DataFrame, path: str, window: int = WINDOW, targets: Mapping[str, float] | None = None,
         remembered: int = REMEMBERED, least: int = LEAST) -> DataFrame:
    """Pieces of all documents: doc_id, source, start, length, doc_tokens, sequence_id,
    offset, ids (binary, little-endian unsigned 32-bit).

    A document is its ids and one closing id; every id lies in exactly one piece.
    Windows are full; what is left behind the last full one is cut into sequences
    whose lengths are powers of two, so nothing is padded.  *targets* are token
    shares by source (default: each source's share of all tokens, so that all
    queues end together), all above zero; a queue that ends early leaves its room to the
    others.  While all queues last, a full window holds each source's share, give or take
    a token per source, and *least* tokens for sources whose share is below that.
    A worker remembers the ids of up to twice *remembered* chunks.

    A NULL text counts as empty (one closing id); a NULL source is the source
    ``''``; a NULL doc_id stays NULL; repeated rows are packed as often as they
    occur; columns beside doc_id, source and text are not read.
    """
    if least < 1 or any(part <= 0 for part in (targets or {}).values()):
        raise ValueError("least and the targets must be above zero")
    rows = tokenized(docs, path, remembered)
    places, total = placed(rows.select("row", "source", "n"), targets, window, least)
    tail = window_starts(total, window)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dtype = chunks(path, remembered).dtype
        for frame in frames:
            out = []
            for doc, source, n, parts, ids in zip(frame["doc_id"], frame["source"], frame["n"], frame["parts"], frame["ids"], strict=True):
                wide = np.frombuffer(ids, dtype=dtype).astype("<u4").tobytes()
                for first, k, place in joined(parts):
                    out += [(doc, source, first + s, m, n, q, o, wide[4 * (first + s) : 4 * (first + s + m)])
                            for s, m, q, o in pieces_of(place, k, total, window, tail)]
            yield pd.DataFrame(out, columns=["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
                               ).astype({"doc_id": "Int64"})

    return rows.join(places, "row").mapInPandas(
        run, "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
