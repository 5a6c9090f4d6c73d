import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from swathmatch.llm import repeats
from swathmatch.llm.queries import QUERIES
from swathmatch.llm.shared import ship

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    """doc_id, bytes, removed, spans, digest; by counting every string."""
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[s : s + length] for d in data for s in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if count[d[s : s + length]] > 1:
                gone[s : s + length] = b"\x01" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60, long=700):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choices("abcdé ", k=k))
    passages = [text(rng.randint(30, long)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [rng.choice([text(rng.randint(0, 200)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 60) :]]) for _ in range(rng.randint(0, 5))]
        t = "".join(parts)
        if t and rng.random() < 0.3:
            at = rng.randrange(len(t))
            t = t[:at] + "X" + t[at + 1 :]
        rows.append((i, t))
    rows += [(n, None), (n + 1, ""), (n + 2, "ab" * 900), (n + 3, "z" * 1500), (n + 4, "y" * 401), (n + 5, "x" * 400)]
    rows += [(n + 6, "twin" + passages[0]), (n + 6, "twin" + passages[0]), (None, rows[0][1] + "q" * 500), (None, rows[1][1])]
    rows += [(n + 7, passages[1] + "#" * 300), (n + 7, passages[1] + "#" * 300 + "other")]
    return rows


def run(spark, rows, length):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("doc", F.lit(1)).withColumn("data", F.lit("clash"))
    got = repeats.without_repeats(df, length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize(("seed", "length"), [(1, 400), (2, 100), (3, 37)])
def test_equals_counting_all_strings(spark, seed, length):
    ship(spark)
    rows = corpus(seed)
    assert run(spark, rows, length) == brute(rows, length)


def test_long_texts_in_segments(spark, monkeypatch):
    ship(spark)
    # a task reads the module's own value, so the text itself is longer than a segment
    rng = random.Random(4)
    base = "".join(rng.choices("abcdefgh", k=repeats.SEGMENT + 5000))
    rows = [(1, base), (2, "Q" + base[:-700] + "R"), (3, base[1000:3000])]
    got = {r[0]: r[1:4] for r in run(spark, rows, 400)}
    assert got == {1: (len(base), len(base) - 700, 1), 2: (len(base) - 698, len(base) - 700, 1), 3: (2000, 2000, 1)}


def test_empty_table(spark):
    ship(spark)
    assert run(spark, [], 400) == []


def test_query(spark, tmp_path):
    rows = corpus(5)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op3_suffix_dedup"](spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 400)


def without_passages(texts, length):
    """Each text without the words covered by a string of *length* words that occurs twice."""
    found = [list(re.finditer(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    count = Counter(tuple(m[0] for m in w[s : s + length]) for w in found for s in range(len(w) - length + 1))
    out = []
    for t, w in zip(texts, found, strict=True):
        gone, lost = bytearray(len(t)), bytearray(len(w))
        for s in range(len(w) - length + 1):
            if count[tuple(m[0] for m in w[s : s + length])] > 1:
                lost[s : s + length] = b"\x01" * length
        for k in (k for k, x in enumerate(lost) if x):
            # and the white space between two such words
            a, b = w[k - 1].end() if k and lost[k - 1] else w[k].start(), w[k].end()
            gone[a:b] = b"\x01" * (b - a)
        out.append("".join(c for c, g in zip(t, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize(("seed", "length"), [(6, 51), (7, 20), (8, 5)])
def test_passages_of_words_equal_counting_all(spark, seed, length):
    ship(spark)
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice(["a", "bé", "c", "d", "ee", "日"]) + rng.choice([" ", " ", "\n", " \t"]) for _ in range(k))
    passages = [text(rng.randint(length - 3, 3 * length)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([text(rng.randint(0, 60)), rng.choice(passages), rng.choice(passages)[2 * rng.randint(0, 9) :]]) for _ in range(rng.randint(0, 4))]
        texts.append("".join(parts).strip() if rng.random() < 0.5 else " ".join(parts))
    texts += ["", " \n", "w " * 200, "v " * length, "u " * (length - 1), texts[0], texts[1] + " end"]
    docs = spark.createDataFrame([*enumerate(texts), (900, None)], SCHEMA)
    # no string of so many bytes repeats, so only words count
    got = {r.doc_id: r.text for r in repeats.cut_texts(docs, 100_000, length).collect()}
    assert got.pop(900) is None
    assert [got[i] for i in range(len(texts))] == without_passages(texts, length)


def test_word_bounds_and_identifiers_see_the_same_words():
    for data in (b"", b" ", b"a", b" a\x0bb\x0c c\x1c\x85d\r\n", "é  ü\tß".encode()):
        starts, ends = repeats.word_bounds(data)
        assert [data[a:b] for a, b in zip(starts, ends, strict=True)] == data.split()
        assert len(repeats.word_ids(data)) == 8 * len(starts)


def test_texts_of_equal_hash_and_no_id_are_told_apart(spark):
    """Two texts without an id whose 32-bit hashes agree; only one of them repeats."""
    import random as r

    from pyspark.sql import functions as F
    rng = r.Random(32)
    filler = "".join(rng.choices("abcdefghij ", k=200))
    many = spark.range(250_000).select(F.concat(F.col("id").cast("string"), F.lit(" "), F.repeat(F.sha2(F.col("id").cast("string"), 256), 8), F.lit(filler)).alias("text"))
    same = many.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).filter("size(t) = 2").select("t").first()
    assert same, "no two of so many texts have the same hash"
    twice, once = same["t"]
    once = once[: -len(filler)]
    found = many.filter(F.hash("text") == F.hash(F.lit(twice))).count()
    assert found == 2
    rows = [(None, twice), (None, same["t"][1]), (7, twice)]
    got = {x.text: x.repeated_spans for x in repeats.with_spans(spark.createDataFrame(rows, "doc_id long, text string"), length=400).collect()}
    assert [(s.start, s.end) for s in got[twice]] == [(0, len(twice))]
    own = got[same["t"][1]] or []
    assert sum(s.end - s.start for s in own) < len(same["t"][1]) - 100


def test_texts_are_shuffled_once_for_bytes_and_words(spark):
    rows = [(i, f"alpha beta gamma delta {i} " * 3) for i in range(20)]
    cut = repeats.cut_texts(spark.createDataFrame(rows, SCHEMA), 12, 3)
    # the two tables of spans meet each other, then the texts meet both
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
    assert cut.count() == 20
