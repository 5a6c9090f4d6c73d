import hashlib
import random

import numpy as np
import public_tokenizers
from pyspark.sql import types as T

from swathmatch.llm import pieces
from swathmatch.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["", " ", "  x ", "a ", "   ", "▁", "a▁ b", "▁▁x", "\x00a", "<s> </s>", "<unk>", "<0x41>", "\n\n a\tb", "日本語 text", "é\U0001f600 ß", "a" * 5000, " " * 3000,
        "word " * 4000, "퟿￿"]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_equals_the_library_on_hard_and_random_texts():
    coder, rng = pieces.ChunkTable(PATH), random.Random(3)
    assert coder.independent
    letters = list("abstq XY'’,.!? \n\t  éß日\U0001f600▁▁ ") + ["  ", "<s>", "</s>", " the", "<0x41>", "\x00", "<unk>"]
    for t in HARD + ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]:
        want = coder.library.encode(t, add_bos=True, add_eos=True)
        ids = b"".join(coder.encode(t))
        assert ids == packed(want), t
        assert coder.decode(ids) == coder.library.decode(want)


def test_decodes_any_ids_as_the_library():
    coder, rng = pieces.ChunkTable(PATH), random.Random(4)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300), 28705, 259]) for _ in range(rng.randint(0, 12))]
        assert coder.decode(packed(ids)) == coder.library.decode(ids), ids


def test_each_word_is_segmented_once(monkeypatch):
    coder = pieces.ChunkTable(PATH)
    asked, library = [], coder.library

    class Counting:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode(self, words, **kw):
            asked.extend(words)
            return library.encode(words, **kw)

    coder.library = Counting()
    monkeypatch.setattr(pieces, "AT_ONCE", 7)
    text = "one two  two one three " * 50
    assert b"".join(coder.encode(text)) == packed(library.encode(text, add_bos=True, add_eos=True))
    assert len(asked) == len(set(asked))


def test_a_full_table_is_begun_anew(monkeypatch):
    coder = pieces.ChunkTable(PATH, table=5)
    monkeypatch.setattr(pieces, "AT_ONCE", 3)
    text = " ".join(f"w{i % 17}" for i in range(200))
    assert b"".join(coder.encode(text)) == packed(coder.library.encode(text, add_bos=True, add_eos=True))
    assert len(coder.ids) <= 5 + 3 + 1


def test_rows(spark):
    from swathmatch.llm.shared import ship
    ship(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())])
    rows = [(1, None, "clash"), (None, "a b", "clash"), (2, "same", None), (2, "same", None)]
    df = spark.createDataFrame(rows, schema)
    out = pieces.encode_documents(df, PATH)
    assert sorted((r.doc_id or 0, r.decoded) for r in out.collect()) == [(0, "a b"), (1, ""), (2, "same"), (2, "same")]
    again = pieces.decode_ids(out, PATH).collect()
    assert sorted(r.decoded for r in again) == ["", "a b", "same", "same"]
    assert pieces.digests(df.limit(0), PATH).count() == 0


def test_query(spark, tmp_path):
    texts = [(i, t) for i, t in enumerate(HARD)] + [(99, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    library = pieces.ChunkTable(PATH).library
    got = {r.doc_id: r for r in QUERIES["op12_pieces"](spark, str(tmp_path)).collect()}
    for i, t in texts:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
