"""Secret scans: fixed patterns and a battery of randomness tests.

Runs of encoded text that no pattern names are candidates.  Each is read in the
encoding it seems to have; chi-squared uniformity of its alphabet, a runs test and
the serial correlation ask whether it may be random.  How unlikely an ordinary
identifier of its length is to look like it gives a p-value, and false discoveries
are controlled over all candidates of a length class together.

DataFrame functions only: nothing leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathmatch.llm.shared import settle, whole_text
from swathmatch.operators.skew import attach_single

# fixed values: the patterns of the base scan
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
# level of the battery, false discovery rate, chance that an ordinary identifier
# goes on in the same class of signs
ALPHA, RATE, STAYS = 0.001, 0.01, 0.85
# width of the bins of -ln p, and the last bin
BIN, LAST_BIN = 0.25, 1000

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Encoding:
    pattern: str
    alphabet: str


# tried in this order; text in one class of signs only is not encoded text
ENCODINGS = (
    Encoding(r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + "abcdef"),
    Encoding(r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + "ABCDEF"),
    Encoding(r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", UPPER + "234567"),
    Encoding(r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", DIGITS + LOWER),
    Encoding(r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", DIGITS + UPPER),
    Encoding(r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$", UPPER + LOWER + DIGITS + "+/"),
)


def found(text: Column, pattern: str) -> Column:
    """start, end (code points) and text of the matches, leftmost and not overlapping."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,said:string>>")
    step = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m")))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("said")))).alias("out"))

    return F.when(F.size(matches) == 0, none).otherwise(
        F.aggregate(step, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda acc: acc["out"]))


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    long_enough = F.filter(found(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["said"], ASSIGN, 1)) >= ASSIGN_LEAST)
    return long_enough, found(text, ACCESS), found(text, HEX)


def _class(c: Column) -> Column:
    return F.when(c.between("0", "9"), 0).when(c.between("a", "z"), 1).when(c.between("A", "Z"), 2).otherwise(3)


def _at_least(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic form, to about 2e-4)."""
    return 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z))))


def _chars(token: Column) -> Column:
    return F.regexp_extract_all(token, F.lit("(?s)."), F.lit(0))


def battery(token: Column, alphabet: Column) -> Column:
    """p-value of the three tests together, were the token drawn at random.

    The squares of the three standardised statistics add up to about chi-squared
    with three degrees of freedom (Wilson-Hilferty).  One fold over the characters
    gives all sums, so a token costs its length, however long it is.
    """
    n, size = F.length(token).cast("double"), F.length(alphabet).cast("double")
    values = F.transform(_chars(token), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    squares = F.aggregate(_chars(alphabet), F.lit(0.0), lambda acc, c: acc + F.pow(n - F.length(F.replace(token, c, F.lit(""))), 2))
    uniform = (size / n * squares - n - (size - 1)) / F.sqrt(2 * (size - 1))
    none = F.lit(None).cast("double")
    zero = F.struct(none.alias("first"), none.alias("last"), *[F.lit(0.0).alias(c) for c in ("sum", "squares", "lagged", "ones", "runs")])

    def add(acc: Column, v: Column) -> Column:
        turned = F.when(acc["last"].isNull() | ((acc["last"] >= size / 2) != (v >= size / 2)), 1.0).otherwise(0.0)
        return F.struct(F.coalesce(acc["first"], v).alias("first"), v.alias("last"), (acc["sum"] + v).alias("sum"), (acc["squares"] + v * v).alias("squares"),
                        (acc["lagged"] + v * F.coalesce(acc["last"], F.lit(0.0))).alias("lagged"),
                        (acc["ones"] + F.when(v >= size / 2, 1.0).otherwise(0.0)).alias("ones"), (acc["runs"] + turned).alias("runs"))

    def ended(acc: Column) -> Column:
        expected = 2 * acc["ones"] * (n - acc["ones"]) / n + 1
        run_test = (acc["runs"] - expected) / F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
        mean = acc["sum"] / n
        variance = acc["squares"] - n * mean * mean
        lagged = acc["lagged"] - mean * (2 * acc["sum"] - acc["first"] - acc["last"]) + (n - 1) * mean * mean
        serial = lagged / F.greatest(variance, F.lit(1e-9)) * F.sqrt(n)
        return run_test * run_test + serial * serial

    total = F.aggregate(values, zero, add, ended) + uniform * uniform
    return _at_least((F.pow(total / 3, F.lit(1.0 / 3)) - (1 - 2.0 / 27)) / F.sqrt(F.lit(2.0 / 27)))


def surprise(token: Column, alphabet: Column) -> Column:
    """-ln p that an ordinary identifier looks so random.

    The likelihood ratio of a random draw to an identifier which mostly goes on in
    the same class of signs exceeds 1/p with probability p at most (Markov)."""
    classes = F.transform(_chars(token), _class)

    def step(acc: Column, c: Column) -> Column:
        size = F.when(c == 0, 10.0).when(c == 3, 4.0).otherwise(26.0)
        turn = F.when(acc["last"].isNull(), F.log(F.lit(4.0))).when(acc["last"] == c, -F.log(F.lit(STAYS))).otherwise(-F.log(F.lit((1 - STAYS) / 3)))
        return F.struct(c.alias("last"), (acc["sum"] + F.log(size) + turn).alias("sum"))

    ordinary = F.aggregate(classes, F.struct(F.lit(None).cast("int").alias("last"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"])
    return F.greatest(ordinary - F.length(token) * F.log(F.length(alphabet).cast("double")), F.lit(0.0))


def _tested(runs: Column, taken: Column) -> Column:
    """Candidates that touch no base span and pass the battery: start, end, size
    (length class), bin (of their surprise); the others are ruled out."""
    free = F.filter(runs, lambda m: ~F.exists(taken, lambda t: (t["start"] < m["end"]) & (m["start"] < t["end"])))
    alphabet = None
    for e in reversed(ENCODINGS):
        pick = lambda m, e=e, rest=alphabet: F.when(m.rlike(e.pattern), F.lit(e.alphabet)).otherwise(rest(m) if rest else F.lit(None))
        alphabet = pick
    read = F.transform(free, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"),
                                                F.translate(m["said"], "-_", "+/").alias("said"), alphabet(m["said"]).alias("alphabet")))
    read = F.filter(read, lambda m: m["alphabet"].isNotNull())
    tests = F.transform(read, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.floor(F.log2(F.length(m["said"]).cast("double"))).cast("int").alias("size"),
        F.least(F.floor(surprise(m["said"], m["alphabet"]) / BIN), F.lit(LAST_BIN)).cast("int").alias("bin"),
        battery(m["said"], m["alphabet"]).alias("p")))
    return tests


def _limits(tested: DataFrame) -> DataFrame:
    """One row, limits: by length class the least bin whose candidates are accepted
    (Benjamini-Hochberg on the bins of each class)."""
    bins = tested.select(F.explode("candidates").alias("c")).groupBy("c.size", "c.bin").agg(F.count("*").alias("n"))
    down = Window.partitionBy("size").orderBy(F.desc("bin"))
    ranked = bins.select("size", "bin", F.sum("n").over(down).alias("k"), F.sum("n").over(Window.partitionBy("size")).alias("m"))
    good = ranked.filter(F.exp(-F.col("bin") * BIN) <= RATE * F.col("k") / F.col("m")).groupBy("size").agg(F.min("bin").alias("bin"))
    # length classes are logarithms of lengths: there are 31 at most
    return good.agg(F.map_from_entries(F.collect_list(F.struct("size", "bin"))).alias("limits"))


def _listed(spans: Column) -> Column:
    at = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(at, ",")


def _as(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each row of *docs*: row (a struct of the columns in *keep*), base,
    spans (arrays of start, kind, end); see ``scan``."""
    text = F.col("text")
    assign, access, hexes = base_spans(text)
    rows = docs.select(F.struct(*keep).alias("row"), whole_text())
    rows = rows.select("row", assign.alias("a"), access.alias("k"), hexes.alias("h"), found(text, CANDIDATE).alias("runs"))
    bare = rows.select("row", *[F.transform(c, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias(c) for c in "akh"], "runs")
    tested = settle(bare.select("row", "a", "k", "h", _tested(F.col("runs"), F.concat("a", "k", "h")).alias("candidates")))
    limit = lambda m: F.coalesce(F.element_at(F.col("limits"), m["size"]), F.lit(LAST_BIN + 1))
    random = F.filter("candidates", lambda m: (m["p"] >= ALPHA) & (m["bin"] >= limit(m)))
    base = F.concat(_as(F.col("a"), 0), _as(F.col("k"), 1), _as(F.col("h"), 2))
    return attach_single(tested, _limits(tested)).select("row", F.array_sort(base).alias("base"), F.array_sort(F.concat(base, _as(random, 3))).alias("spans"))


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of *docs*: doc_id, n_assign, n_access, n_hex, base, spans
    (arrays of start, kind, end; code points, end exclusive; kind as in KINDS).

    ``base`` holds the matches of the fixed patterns, ``spans`` also the random
    tokens accepted over all documents.  A NULL text counts as empty and has no
    span; a NULL doc_id stays NULL; repeated rows each count; columns beside doc_id
    and text are not read.
    """
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    out = scanned(docs, ["doc_id"])
    counts = [count(k) for k in range(3)]
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), *counts, "base", "spans")


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns of *docs*, with *mask* in the place of each span of
    ``scan`` in the text (spans which overlap share one).  A NULL text stays NULL."""
    out = scanned(docs, docs.columns)
    text = F.coalesce("row.text", F.lit(""))

    def cut(acc: Column, s: Column) -> Column:
        gap = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
        new = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), new.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", start, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return out.withColumn("clean", F.when(F.size("spans") == 0, F.col("row.text")).otherwise(clean)).select(
        *[F.col("clean").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def listed(found_spans: DataFrame) -> DataFrame:
    """The result of ``scan`` with its spans as text (``kind:start:end``, by comma)."""
    return found_spans.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                          _listed(F.col("spans")).alias("spans"))
