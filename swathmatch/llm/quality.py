"""Quality rules: counts, and how far a text is from its language.

Each document's shares of character classes and of common words are compared with
the mean shares of every language's documents by Jensen-Shannon distance; a text
far from all of them is not kept.  The fewer words a text has, the farther chance
takes its shares of common words, so short texts have a wider limit.  Texts below
LEAST_WORDS fail by their counts.

DataFrame functions only: nothing leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathmatch.llm.shared import settle, whole_text
from swathmatch.operators.skew import attach_single

# fixed values: white space and symbols of the counts
SPACE, SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED = 50, 50

# common words of the languages that have a reference
COMMON = {
    "de": ("der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "des", "dem", "nicht", "ein", "sich", "auf"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with", "as", "on", "be", "this"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una", "para"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"),
}
# words from which shares of character classes and of common words mean something
CLASS_WORDS, COMMON_WORDS = 50, 50
# distances (0 to 1) beyond which a text is too far from every language
CLASS_LIMIT, COMMON_LIMIT = 0.30, 0.27
# words from which COMMON_LIMIT holds as it is; below, its square is wider by COMMON_SPREAD
# times what 1 / words is more than there, as the squared distance of a sample grows
SETTLED_WORDS, COMMON_SPREAD = 200, 1.4


def _repeated_words(words: Column) -> Column:
    """Words inside the windows of three words which occur twice or more."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.transform(at, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    none = F.array().cast("array<int>")

    def found(s: Column) -> Column:
        same = lambda k, j: F.coalesce(F.get(s, k)["h"] == F.get(s, j)["h"], F.lit(False))
        hit = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        return F.transform(hit, lambda k: F.get(s, k)["i"])

    # a lambda of one element names the sorted windows once
    starts = F.element_at(F.transform(F.array(F.sort_array(windows)), lambda s: F.sort_array(found(s))), 1)
    starts = F.when(F.size(words) < 3, none).otherwise(starts)
    return starts


def _covered(starts: Column) -> Column:
    step = F.aggregate(F.sequence(F.lit(0), F.size(starts) - 2), F.lit(0), lambda acc, k: acc + F.least(F.lit(3), F.get(starts, k + 1) - F.get(starts, k)))
    return F.when(F.size(starts) == 0, 0).when(F.size(starts) == 1, 3).otherwise(step + 3)


def _shares(counts: list[Column]) -> Column:
    values = F.array(*[c.cast("double") for c in counts])
    total = F.greatest(reduce(lambda a, b: a + b, [c.cast("double") for c in counts]), F.lit(1.0))
    return F.transform(values, lambda v: v / total)


def _listed() -> list[str]:
    return sorted({w for words in COMMON.values() for w in words})


def features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, counts and histograms of each row of *docs*."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), whole_text())
    rows = rows.select("doc_id", "lang", "text", F.filter(F.split(text, SPACE, -1), lambda w: w != "").alias("words"),
                       F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    rows = rows.select("*", _repeated_words(F.col("words")).alias("starts"),
                       F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: w.isin(_listed())).alias("common"))
    n = F.size("words")
    chars = F.aggregate("words", F.lit(0), lambda acc, w: acc + F.length(w))
    rows = rows.select(
        "doc_id", "lang", n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), _covered(F.col("starts")).cast("long").alias("n_repeat_words"),
        F.length("text").alias("chars"), F.regexp_count("text", F.lit(r"\p{Lu}")).alias("upper"), F.regexp_count("text", F.lit("[0-9]")).alias("digits"),
        F.regexp_count("text", F.lit(r"[.,;:!?'\"()-]")).alias("marks"), F.length(F.regexp_replace("text", r"\P{L}+", "")).alias("letters"),
        F.transform(F.array(*map(F.lit, _listed())), lambda c: F.size(F.filter("common", lambda w: w == c))).alias("hits"), F.size("common").alias("n_common"))
    known = [F.col("letters") - F.col("upper"), F.col("upper"), F.col("digits"), F.col("chars") - F.col("word_chars"), F.col("marks")]
    classes = _shares([*known, F.greatest(F.col("chars") - reduce(lambda a, b: a + b, known), F.lit(0))])
    words = F.transform(F.concat("hits", F.array(F.col("n_words").cast("int") - F.col("n_common"))), lambda v: v / F.greatest(F.col("n_words"), F.lit(1)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       classes.alias("classes"), words.alias("common"))


def references(found: DataFrame) -> DataFrame:
    """One row: for each language with a reference the mean shares of its documents.

    Means over all documents which pass the counts, each document with one voice."""
    n = len(_listed()) + 1
    good = found.filter(~F.col("base_failed") & F.col("lang").isin(sorted(COMMON)))
    means = good.groupBy("lang").agg(F.array(*[F.avg(F.get("classes", F.lit(i))) for i in range(6)]).alias("classes"),
                                     F.array(*[F.avg(F.get("common", F.lit(i))) for i in range(n)]).alias("common"))
    # as many entries as there are languages in COMMON
    return means.agg(F.sort_array(F.collect_list(F.struct("lang", "classes", "common"))).alias("refs"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms, from 0 to 1."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    both = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(both, F.lit(0.0), lambda acc, x: acc + x) / 2, F.lit(0.0)))


def nearest(column: str) -> Column:
    """Distance to the nearest reference; none where there is no reference."""
    return F.array_min(F.transform("refs", lambda r: distance(F.col(column), r[column])))


def common_limit(n: Column) -> Column:
    """Limit of the distance of common words for a text of *n* words."""
    more = F.greatest(1 / F.greatest(n, F.lit(1)) - 1 / SETTLED_WORDS, F.lit(0.0))
    return F.sqrt(COMMON_LIMIT**2 + COMMON_SPREAD * more)


def judged(docs: DataFrame) -> DataFrame:
    """One row for each row of *docs*: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, class_distance, common_distance, kept.

    The nearest language counts, whatever ``lang`` says, so a wrong or missing
    language costs a document nothing; ``lang`` only says whose reference a document
    belongs to.  A NULL text counts as empty (no words, so it fails); a NULL doc_id
    stays NULL; repeated rows each count; columns beside doc_id, text and lang are
    not read.
    """
    found = settle(features(docs))
    rows = attach_single(found, references(found)).withColumns({"class_distance": nearest("classes"), "common_distance": nearest("common")})
    far = ((F.col("n_words") >= CLASS_WORDS) & (F.coalesce("class_distance", F.lit(0.0)) > CLASS_LIMIT)) | (
        (F.col("n_words") >= COMMON_WORDS) & (F.coalesce("common_distance", F.lit(0.0)) > common_limit(F.col("n_words"))))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance",
                       "common_distance", (~F.col("base_failed") & ~far).alias("kept"))
