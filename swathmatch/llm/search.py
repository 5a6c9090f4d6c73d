"""Ranked lexical search over an inverted index, by a hybrid of TAAT and DAAT.

The index is cut by documents into shards of a bounded number of words; a shard's
posting lists are written by the task that reads its documents, without a shuffle.
A shard answers an item by itself: its short lists are summed into accumulators
(term at a time), and those accumulators are then one more iterator, with a bound
of its own, beside the long lists (document at a time).  Windows of documents whose
bounds stay below the worst of the best so far are skipped by all iterators, and
within a window the lists that cannot lift a document to that score are left unread.
A task carries the best so far from shard to shard.

Scores are whole numbers, so skipping changes no result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathmatch.llm.shared import group_bounds, runs_of_keys, settle, whole_text
from swathmatch.operators.skew import salted_join

BEST = 50
# words of a shard (the document that passes this is its last) and most documents of one
SHARD_WORDS, SHARD_DOCS = 1 << 22, 1 << 16
# items answered together
ITEMS = 256
# documents of a window
WINDOW = 1024
# postings of short lists, which are summed ahead, for each document of a shard
SHORT = 0.25

# bytes of a text: those of terms as they are (A-Z lower-cased), a space for all others
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and all signs beyond ASCII; only A-Z lower-cased."""
    return text.encode().translate(_TERMS).split()


class Index(NamedTuple):
    """``postings``: shard, term, n (documents that hold it), ords (their places in the
    shard, packed), counts (packed).  ``documents``: a row for each shard with n
    (documents that hold a term), words, docs (ids, packed), nameless (marks, packed),
    lengths (in terms, packed)."""

    postings: DataFrame
    documents: DataFrame


_POSTINGS = {"term": "binary", "ords": "binary", "counts": "binary"}
_DOCUMENTS = {"words": "long", "docs": "binary", "nameless": "binary", "lengths": "binary"}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_words: int = SHARD_WORDS, shard_docs: int = SHARD_DOCS) -> Index:
    """Inverted index of the whole texts, written to the shared folder.

    NULL texts have no terms; rows without a doc_id and repeated rows are documents
    of their own; other columns are not read.  A shard has at most 65,536 documents.
    """
    most = min(shard_docs, 1 << 16)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for frame in frames:
            for doc, text in zip(frame["id"], frame["text"], strict=True):
                shard.add(doc, terms_of(text))
                if shard.words >= shard_words or len(shard.docs) >= most:
                    yield from shard.rows(number)
                    number, shard = number + 1, _Shard()
        if shard.docs:
            yield from shard.rows(number)

    # ids as strings: a frame with a NULL among them would hold floats
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("id"), whole_text(text_col).alias("text"))
    columns = {"shard": "long", "n": "long"} | _POSTINGS | _DOCUMENTS
    index = settle(rows.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in columns.items())))
    return Index(index.filter("term IS NOT NULL").select("shard", "n", *_POSTINGS),
                 index.filter("term IS NULL").select("shard", "n", *_DOCUMENTS))


class _Shard:
    """Documents until they are written as posting lists."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.docs: list[str | None] = []
        self.codes: list[np.ndarray] = []
        self.words = 0

    def add(self, doc: str | None, terms: list[bytes]) -> None:
        self.docs.append(doc)
        self.codes.append(np.fromiter(map(self.number.__getitem__, terms), np.int64, len(terms)))
        self.words += len(terms)

    def rows(self, shard: int) -> Iterator[pd.DataFrame]:
        lengths = np.array([len(c) for c in self.codes], "<i8")
        ids = np.array([int(d or 0) for d in self.docs], "<i8")
        nameless = np.array([d is None for d in self.docs], bool)
        none = dict.fromkeys(_POSTINGS)
        yield pd.DataFrame([{"shard": shard, "n": int((lengths > 0).sum())} | none | {
            "words": self.words, "docs": ids.tobytes(), "nameless": nameless.tobytes(), "lengths": lengths.tobytes()}])
        # a posting is (term, document); its count says how often that occurs
        both = np.concatenate(self.codes) << 16 | np.repeat(np.arange(len(lengths)), lengths)
        self.codes.clear()
        posting, count = np.unique(both, return_counts=True)
        term, ords, counts = posting >> 16, (posting & 0xFFFF).astype("<u2"), count.astype("<u4")
        bounds = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term)).tolist()
        names = list(self.number)
        for a in range(0, len(bounds) - 1, 10_000):
            spans = list(zip(bounds[a : a + 10_000], bounds[a + 1 : a + 10_001], strict=False))
            yield pd.DataFrame({"shard": shard, "n": [e - s for s, e in spans], "term": [names[term[s]] for s, _ in spans],
                                "ords": [ords[s:e].tobytes() for s, e in spans], "counts": [counts[s:e].tobytes() for s, e in spans],
                                "words": pd.array([pd.NA] * len(spans), "Int64"), "docs": None, "nameless": None, "lengths": None})


def _asked(items: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """q (a number of its own for each row), item_id, block, terms (distinct)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = TaskContext.get().partitionId() << 32
        for frame in frames:
            numbers = np.arange(q, q + len(frame))
            yield pd.DataFrame({"q": numbers, "item_id": frame["id"], "block": numbers // block,
                                "terms": [sorted(set(terms_of(t))) for t in frame["text"]]})
            q += len(frame)

    rows = items.select(F.col(id_col).cast("long").cast("string").alias("id"), whole_text(text_col).alias("text"))
    numbered = settle(rows.mapInPandas(run, "q long, item_id string, block long, terms array<binary>"))
    return numbered.withColumn("item_id", F.col("item_id").cast("long"))


def search(index: Index, items: DataFrame, best: int = BEST, id_col: str = "item_id", text_col: str = "text",
           block: int = ITEMS, window: int = WINDOW, short: float = SHORT) -> DataFrame:
    """The *best* documents of each item: item_id, rank (from 1), doc_id, score.

    With N documents that hold a term, L terms in all of them and df documents that
    hold a term, its weight is ``w = floor(1000 ln((2N+2)/(2df+1)))``; a document of n
    terms has ``m = 50 + 50nN div L`` and scores ``w * (10^9 tf div (1000 tf + 20 m))``
    summed over the item's distinct terms.  Only scores above 0 count; equal scores
    go by doc_id, rows without one last.

    Every row of *items* is an item, so repeated rows and rows with a NULL id are
    answered each; an item or a document without terms (NULL, empty) has no row;
    other columns are not read.  *block* (items answered together), *window* and *short*
    bound what is held and read at once; they change no result.
    """
    asked = _asked(items, id_col, text_col, block)
    n_docs, n_words = index.documents.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    # an item is in one block, so a row lists at most *block* of them
    wanted = settle(asked.select("q", "block", F.explode("terms").alias("term")).groupBy("term", "block").agg(F.collect_list("q").alias("qs")))
    df = index.postings.select("term", "n").join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = settle(wanted.join(df, "term").withColumn("w", weight))
    lists = salted_join(index.postings, weighted, ["term"]).select("block", "shard", "w", "qs", "ords", "counts")
    lists = settle(lists.withColumn("kind", F.lit(1)))
    # a shard's documents go wherever a list of it goes
    beside = index.documents.join(lists.select("block", "shard").distinct(), "shard").withColumn("kind", F.lit(0))
    rows = lists.unionByName(beside.drop("n", "words"), allowMissingColumns=True)
    dealt = rows.repartition("block", "shard").sortWithinPartitions("block", "shard", "kind")
    found = dealt.mapInPandas(_answers(_Corpus(n_docs, n_words), best, window, short), "q long, doc_id string, score long").withColumn("doc_id", F.col("doc_id").cast("long"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return top.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


class _Corpus(NamedTuple):
    docs: int
    words: int


class _Postings:
    """A list of scored documents, with its bound in each window between *edges*."""

    def __init__(self, ords: np.ndarray, scores: np.ndarray, edges: np.ndarray):
        self.ords, self.scores, self.edges = ords, scores, edges
        self.cuts = np.searchsorted(ords, edges)
        self.bounds = np.zeros(len(edges) - 1, np.int64)
        there = np.flatnonzero(np.diff(self.cuts))
        if len(there):
            self.bounds[there] = np.maximum.reduceat(scores, self.cuts[there])

    def add_to(self, sums: np.ndarray, window: int) -> None:
        s, e = self.cuts[window], self.cuts[window + 1]
        sums[self.ords[s:e] - self.edges[window]] += self.scores[s:e]


def _accumulated(lists: list[_Postings], edges: np.ndarray) -> _Postings:
    """Term at a time: the sums of all *lists* as one list."""
    ords, scores = np.concatenate([x.ords for x in lists]), np.concatenate([x.scores for x in lists])
    order = np.argsort(ords, kind="stable")
    ords = ords[order]
    first = np.flatnonzero(np.diff(ords, prepend=-1))
    return _Postings(ords[first], np.add.reduceat(scores[order], first), edges)


class _Best:
    """The best documents of an item so far."""

    def __init__(self, most: int):
        self.most = most
        self.scores, self.nameless, self.docs = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        # what a document needs: a positive score, and no less than the last of the best
        self.least = 1

    def take(self, scores: np.ndarray, nameless: np.ndarray, docs: np.ndarray) -> None:
        scores, nameless, docs = np.append(self.scores, scores), np.append(self.nameless, nameless), np.append(self.docs, docs)
        kept = np.lexsort((docs, nameless, -scores))[: self.most]
        self.scores, self.nameless, self.docs = scores[kept], nameless[kept], docs[kept]
        if len(kept) == self.most:
            self.least = max(1, int(self.scores[-1]))


def _document_at_a_time(lists: list[_Postings], best: _Best, nameless: np.ndarray, docs: np.ndarray) -> None:
    bounds, edges = np.stack([x.bounds for x in lists]), lists[0].edges
    total = bounds.sum(axis=0)
    for window in np.flatnonzero(total >= best.least).tolist():
        rest = int(total[window])
        if rest < best.least:
            continue
        sums = np.zeros(edges[window + 1] - edges[window], np.int64)
        # highest bounds first; once nothing can reach the best, the others are not read
        for k in np.argsort(-bounds[:, window], kind="stable").tolist():
            if int(sums.max()) + rest < best.least:
                break
            lists[k].add_to(sums, window)
            rest -= int(bounds[k, window])
        else:
            hit = np.flatnonzero(sums >= best.least)
            if len(hit):
                at = hit + edges[window]
                best.take(sums[hit], nameless[at], docs[at])


def _answer_shard(part: pd.DataFrame, found: dict[int, _Best], corpus: _Corpus, most: int, window: int, short: float) -> None:
    """Answers of one shard to the items of one block: its documents, then its lists."""
    own = part.iloc[0]
    docs, nameless, lengths = (np.frombuffer(own[c], t) for c, t in (("docs", "<i8"), ("nameless", bool), ("lengths", "<i8")))
    m = 50 + (50 * lengths * corpus.docs) // corpus.words
    edges = np.append(np.arange(0, len(docs), window), len(docs))
    lists, asking = [], defaultdict(list)
    for w, qs, ords, counts in zip(*(part[c].iloc[1:] for c in ("w", "qs", "ords", "counts")), strict=True):
        at, tf = np.frombuffer(ords, "<u2").astype(np.int64), np.frombuffer(counts, "<u4").astype(np.int64)
        for q in qs.tolist():
            asking[q].append(len(lists))
        lists.append(_Postings(at, int(w) * ((10**9 * tf) // (1000 * tf + 20 * m[at])), edges))
    for q, mine in asking.items():
        mine.sort(key=lambda k: len(lists[k].ords))
        n_short = int(np.searchsorted(np.cumsum([len(lists[k].ords) for k in mine]), short * len(docs), "right"))
        iterators = [lists[k] for k in mine[n_short:]]
        if n_short:
            iterators.append(_accumulated([lists[k] for k in mine[:n_short]], edges))
        _document_at_a_time(iterators, found.setdefault(q, _Best(most)), nameless, docs)


def _answers(corpus: _Corpus, most: int, window: int, short: float):
    def told(found: dict[int, _Best]) -> pd.DataFrame:
        rows = [(q, None if none else str(doc), score) for q, b in found.items()
                for none, doc, score in zip(b.nameless.tolist(), b.docs.tolist(), b.scores.tolist(), strict=True)]
        return pd.DataFrame(rows, columns=["q", "doc_id", "score"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, block, found = ["block", "shard"], None, {}
        for frame in runs_of_keys(frames, keys):
            for s, e in group_bounds(frame, keys):
                if frame["block"].iloc[s] != block:
                    yield told(found)
                    block, found = frame["block"].iloc[s], {}
                _answer_shard(frame.iloc[s:e], found, corpus, most, window, short)
        yield told(found)

    return run
