import hashlib
import random

import numpy as np
import public_tokenizers
from pyspark.sql import types as T
from tokenizers import Tokenizer

from swathmatch.llm import bpe
from swathmatch.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = ["", " ", "  x", "a\n\n b", "it's we'll )'s %'s 'S", "x y  z", "é \U0001f600 \U0001f600a", "<|endoftext|>",
        "a<|endoftext|>b <|endof", "12345 6,7.8", "\t\tif (x) {\r\n}", "ünïcödé ßß 日本語 text", "don't’s", "a" * 5000, " " * 3000, "\x00\x01\x85"]


def ids_of(text):
    return list(np.frombuffer(b"".join(bpe.boundaries(PATH).encode(text)), "<u4"))


def test_equals_the_library_on_hard_and_random_texts():
    tok, rng = Tokenizer.from_file(PATH), random.Random(5)
    letters = list("abstq XY'’,.!?<|>()[]{}0129 \n\t\r  éß日\U0001f600́　") + ["'s", "'ll", "<|endoftext|>", "  ", " the"]
    texts = HARD + ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    for t in texts:
        want = tok.encode(t, add_special_tokens=False).ids
        assert ids_of(t) == want, t
        assert bpe.boundaries(PATH).decode(np.array(want, "<u4").tobytes()).decode("utf-8", "replace") == tok.decode(want, skip_special_tokens=False)


def test_pairs_inside_tokens_are_never_cut():
    coder = bpe.boundaries(PATH)
    for t in coder.token_bytes.values():
        assert coder.cuts(t) == [0, len(t)]


def test_rows(spark):
    from swathmatch.llm.shared import ship
    ship(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())])
    rows = [(1, None, "clash"), (None, "a b", "clash"), (2, "same", None), (2, "same", None)]
    df = spark.createDataFrame(rows, schema)
    out = bpe.encode_documents(df, PATH).collect()
    assert len(out) == 4 and {(r.doc_id, r.decoded) for r in out} == {(1, ""), (None, "a b"), (2, "same")}
    assert bpe.digests(df.limit(0), PATH).count() == 0


def test_query(spark, tmp_path):
    texts = [(i, t) for i, t in enumerate(HARD)] + [(99, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    tok = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in QUERIES["op2_bpe"](spark, str(tmp_path)).collect()}
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
