import random

from pyspark.sql import functions as F

from swathmatch.llm import ngram_join
from swathmatch.llm.components import components
from swathmatch.llm.queries import QUERIES
from swathmatch.llm.shared import ship

SCHEMA = "doc_id long, text string"


def brute(rows, n=5, similarity=0.8):
    """doc_id -> (class, links, size), by all pairs."""
    def grams(t):
        w = (t or "").split()
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for members in groups.values():
        name = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        out += [(rows[i][0], name, links[i], len(members)) for i in members]
    return sorted(out, key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for group in range(60):
        base = rng.choices(words, k=rng.choice([1, 3, 5, 30, 80, 300]))
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t)))
            i += 1
    base = rng.choices(words, k=120)
    for _ in range(300):  # more than a block
        t = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t)))
        i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \n "), (i + 3, "one"), (i + 4, "one"), (i + 4, "one"), (None, rows[0][1])]
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("bucket", F.lit(1))


def test_equals_all_pairs(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    monkeypatch.setattr(ngram_join, "GRAMS", 20_000)
    rows = corpus()
    got = ngram_join.near_duplicates(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in got), key=repr) == brute(rows)


def test_only_rows_without_id(spark):
    ship(spark)
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (None, "x y z")]
    got = ngram_join.near_duplicates(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in got), key=repr) == brute(rows)


def test_empty_table(spark):
    ship(spark)
    assert ngram_join.near_duplicates(table(spark, [])).count() == 0


def test_bands_reach_the_recall():
    b, r = ngram_join.choose_bands(0.8, 0.9999)
    assert b * r <= 128 and 1 - (1 - 0.8**r) ** b >= 0.9999


def test_components(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(120)] + [("x", "x"), ("m", "k"), ("k", "m")]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {f"{i:03}": "000" for i in range(121)} | {"m": "k", "k": "k"}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_query(spark, tmp_path):
    rows = corpus(2)[:150]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op8_ngram_join"](spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in got), key=repr) == brute(rows)
