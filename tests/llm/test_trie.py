import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import types as T

from swathmatch.llm import trie
from swathmatch.llm.queries import QUERIES, SQL
from swathmatch.llm.shared import ship

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("depth", T.StringType())])
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in convs.items()}
    out = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + said[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, said in convs.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in below if len(m) == len(n) + 1)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes(spark, rows, openings=True, **bounds):
    ship(spark)
    said = trie.turns(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA))
    given = trie.with_openings(said) if openings else (said, said.select("conv").distinct())
    found = trie.prefix_trie(*given, **bounds)
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr)


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn, role, text))
    return {c: [t[1:] for t in sorted(ts)] for c, ts in convs.items()}


@pytest.mark.parametrize("bounds", [{}, {"size": 2, "cells": 8, "part": 2, "ids": 2}, {"size": 3, "part": 1}])
def test_equals_brute_force(spark, bounds):
    """Shared beginnings of all lengths, copies, a conversation inside another, over
    segments and matrices."""
    rng, rows = random.Random(13), []
    stems = [[(rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "é\U0001f600"])) for _ in range(9)] for _ in range(3)]
    for c in rng.sample(range(-40, 400), 50):
        said = rng.choice(stems)[: rng.randint(0, 9)] + [("user", str(rng.randint(0, 2))) for _ in range(rng.randint(0, 3))]
        rows += [(c, k * 3, r, t) for k, (r, t) in enumerate(said)]
    rows += [(500 + i, k, "user", "same") for i in range(7) for k in range(11)]
    assert nodes(spark, rows, False, **bounds) == brute(plain(rows))
    assert nodes(spark, rows, **bounds) == brute(rebuilt(rows))


def test_missing_values(spark):
    rows = [(100, None, None, None), (100, 1, "user", "x"), (101, 0, "user", "own"), (207, 0, "a", "only"), (None, 0, "user", "nobody"),
            (300, 0, "user", "x"), (300, 0, "user", "x"), (300, 2, "", "y"), (301, 0, "q", ""), (399, 5, "q", ""), (399, 6, "q", "z")]
    assert nodes(spark, rows) == brute(rebuilt(rows))
    assert nodes(spark, [(None, 0, "user", "nobody")]) == [] == nodes(spark, [])
    # a role does not run into a text
    assert len(nodes(spark, [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "1", "2:x")], False)) == 4


def test_turnless_conversations_end_at_the_root(spark):
    turnless = next(c for c in range(1001, 1100) if zlib.crc32(str(c).encode()) % 6 >= 1)
    found = nodes(spark, [(turnless, 0, "user", "gone")])
    assert found == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = con.execute(SQL["op13_trie"])
    names = [c[0] for c in want.description]
    found = QUERIES["op13_trie"](spark, folder)
    assert sorted(found.columns) == sorted(names)
    got = sorted(map(tuple, found.select(*names).collect()), key=repr)
    assert len(got) > 100 and got == sorted(want.fetchall(), key=repr)
