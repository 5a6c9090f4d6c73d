import math
import random
import re

from pyspark.sql import functions as F

from swathmatch.llm import quality
from swathmatch.llm.queries import QUERIES

SCHEMA = "doc_id long, lang string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    inside = set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside |= {i, i + 1, i + 2}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), n < 50 or 100 * len(inside) > 50 * n)


def texts(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "a", "b", "é", "ß.", "x|y", "##", "\U0001f600", "And"]
    out = []
    for _ in range(200):
        k = rng.choice([0, 1, 2, 3, 4, 10, 60, 120])
        out.append("".join(rng.choice(vocab[: rng.choice([2, 10])]) + rng.choice([" ", "  ", "\n", "\t", "\x0b", "\r\n", " "]) for _ in range(k)))
    return out + ["", " ", "\n\n", "a", "a a a a", "one line\none line\n one line\n", "w " * 20_000]


def test_counts_equal_brute_force(spark):
    rows = [(i, "en", t) for i, t in enumerate(texts(1))] + [(900, None, None), (None, "xx", "a b c"), (901, "en", "twin"), (901, "en", "twin")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("words", F.lit("clash")).withColumn("refs", F.lit(1))
    got = quality.judged(df).collect()
    have = sorted((tuple(r)[:7] for r in got), key=repr)
    assert have == sorted(((i, *brute(t)) for i, _, t in rows), key=repr)
    assert all(r.kept is not None and not (r.kept and r.base_failed) for r in got)


def test_distance(spark):
    def js(p, q):
        out = 0
        for a, b in zip(p, q, strict=True):
            m = (a + b) / 2
            out += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
        return math.sqrt(out / 2)

    rows = [([0.5, 0.5, 0.0], [0.2, 0.3, 0.5]), ([1.0, 0.0], [0.0, 1.0]), ([0.25, 0.75], [0.25, 0.75])]
    got = spark.createDataFrame(rows, "p array<double>, q array<double>").select(quality.distance(F.col("p"), F.col("q"))).collect()
    assert all(abs(g[0] - js(p, q)) < 1e-6 for g, (p, q) in zip(got, rows, strict=True))


def test_junk_goes_and_clean_texts_stay(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = QUERIES["op9_quality"](spark, folder).filter("NOT base_failed").join(labels, "doc_id")
    r = out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {x.quality: x.kept for x in r}
    assert kept[1] > 0.998 and kept[0] < 0.5


def test_junk_goes_in_each_class_of_length(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = QUERIES["op9_quality"](spark, folder).filter("NOT base_failed").join(labels, "doc_id")
    short = (F.col("n_words") < 200).alias("short")
    r = out.groupBy(short, "quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {(x.short, x.quality): x.kept for x in r}
    assert kept[True, 0] < 0.25 and kept[False, 0] < 0.03
    assert kept[True, 1] > 0.995 and kept[False, 1] > 0.998


def test_limit_of_common_words_widens_for_short_texts(spark):
    got = [r[0] for r in spark.createDataFrame([(50,), (100,), (199,), (200,), (5000,)], "n long").select(quality.common_limit(F.col("n"))).collect()]
    assert got == sorted(got, reverse=True) and abs(got[0] - 0.3065) < 1e-3 and abs(got[3] - 0.27) < 1e-9 and got[4] == got[3]


def test_empty_table(spark):
    assert quality.judged(spark.createDataFrame([], SCHEMA)).count() == 0
