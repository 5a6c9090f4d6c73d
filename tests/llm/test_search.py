import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from swathmatch.llm import search
from swathmatch.llm.queries import QUERIES, SQL
from swathmatch.llm.shared import ship

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("rank", T.StringType())])


def terms(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, best):
    words = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in words if c), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in words:
            if not c:
                continue
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort(key=lambda x: x[:3])
        out += [(item, k, d, -s) for k, (s, _, _, d) in enumerate(scored[:best], 1)]
    return sorted(out, key=repr)


def answers(spark, docs, items, best=search.BEST, bounds=None, **shards):
    ship(spark)
    index = search.build_index(spark.createDataFrame([(*d, "clash") for d in docs], DOCS), **shards)
    found = search.search(index, spark.createDataFrame([(*i, "clash") for i in items], ITEMS), best, **(bounds or {}))
    return sorted(map(tuple, found.collect()), key=repr)


def test_terms():
    for t in ["", "A-bC_d9", "ÄÖ ßx\x7fy z\x00", "日本 a`b{c[d@e/f:g", "\u0085 é　"]:
        assert [x.decode() for x in search.terms_of(t)] == terms(t)


@pytest.mark.parametrize("short", [0.0, 0.25, 100.0])
def test_equals_brute_force(spark, short):
    """Common and rare words, copies, ties, NULLs, over many shards and windows."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    odds = [1 / (i + 1) for i in range(60)]

    def text(n):
        return " ".join(rng.choices(words, odds, k=n))

    docs = [(i * 7 - 300, text(rng.randint(0, 30))) for i in range(600)] + [(5000 + i, "w1 w2 W3") for i in range(40)]
    docs += [(None, "w1 w2 w59"), (None, None), (9000, None), (9001, ""), (9002, "w1 " * 5000), (77, "w5 w6"), (77, "w5 w6"), ((1 << 60) + 1, "w58 w59")]
    items = [(i, text(rng.randint(1, 12))) for i in range(12)] + [(3, "w1 w2 w59"), (None, "w58, W59"), (50, None), (51, "nothing here"), (52, "w0")]
    assert answers(spark, docs, items, 10, {"block": 5, "window": 16, "short": short}, shard_words=1000, shard_docs=100) == brute(docs, items, 10)


def test_windows_that_cannot_win_are_not_read():
    """Both kinds of skipping, on lists whose bounds are known."""
    edges = np.arange(0, 16, 4)
    read = []

    class Noting(search._Postings):
        def add_to(self, sums, window):
            read.append((self.name, window))
            super().add_to(sums, window)

    def postings(name, ords, scores):
        p = Noting(np.array(ords), np.array(scores), edges)
        p.name = name
        return p

    lists = [postings("high", [0, 5, 9], [10, 10, 1]), postings("low", [0, 1, 6, 9], [1, 1, 1, 1])]
    best = search._Best(1)
    search._document_at_a_time(lists, best, np.zeros(12, bool), np.arange(12))
    # the second window is given up after its first list, the third is skipped
    assert read == [("high", 0), ("low", 0), ("high", 1), ("low", 1)] and best.scores.tolist() == [11] and best.docs.tolist() == [0]


def test_empty_tables(spark):
    assert answers(spark, [], [(1, "a")]) == []
    assert answers(spark, [(1, "a")], []) == []
    assert answers(spark, [(1, ""), (2, None)], [(1, "a")]) == []
    # a term in every document still weighs a little
    assert len(answers(spark, [(1, "a"), (2, "a")], [(1, "a")])) == 2


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    want = con.execute(SQL["op11_search"])
    names = [c[0] for c in want.description]
    got = QUERIES["op11_search"](spark, folder).select(*names).collect()
    assert len(got) and sorted(map(tuple, got)) == sorted(want.fetchall())
