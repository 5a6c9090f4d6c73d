import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from swathmatch.llm import packing
from swathmatch.llm.queries import QUERIES
from swathmatch.llm.shared import ship

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(pieces, docs, window):
    tok = Tokenizer.from_file(PATH)
    want = sorted((d, tuple([*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID])) for d, _, t in docs)
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length > 0
        by_seq[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append((p.start, tuple(np.frombuffer(p.ids, "<u4"))))
    for at in by_seq.values():
        end = 0
        for o, n in sorted(at):
            assert o == end
            end += n
        assert end == window or (end < window and end & (end - 1) == 0)
    assert sum(len(w) for _, w in want) == sum(p.length for p in pieces)
    for d, ids in want:
        if sum(x == d for x, _ in want) == 1:
            assert sum((part for _, part in sorted(by_doc[d])), ()) == ids


def docs_of(n):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 5}", "The cat's   mat\n" * (i % 37) + "é 12<|endoftext|>") for i in range(n)]
    return rows + [(n, None, None), (n + 1, "s1", ""), (n + 2, "s1", "word " * 6000), (n + 3, "s2", "twin"), (n + 3, "s2", "twin")]


@pytest.mark.parametrize("targets", [None, {"hot": 0.2, "s1": 0.8}])
def test_every_id_once_and_no_padding(spark, targets):
    ship(spark)
    docs = docs_of(150)
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("ids", F.lit("clash"))
    check(packing.pack(df, PATH, 1024, targets).collect(), docs, 1024)


def variations(pieces, window, shares):
    """Total variation between the mixture of each full window and *shares*."""
    held = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        held[p.sequence_id][p.source] += p.length
    return {q: sum(abs(by.get(s, 0) / window - x) for s, x in shares.items()) / 2
            for q, by in held.items() if sum(by.values()) == window}


def mixed(rng, n, sources, longest):
    """Documents of very uneven length, a third of them of one source."""
    return [(i, "hot" if rng.random() < 0.33 else f"s{rng.randrange(sources)}", "word " * int(longest ** rng.random())) for i in range(n)]


def test_every_window_holds_the_target_shares(spark):
    ship(spark)
    docs = mixed(random.Random(7), 1300, 9, 3000)
    out = packing.pack(spark.createDataFrame(docs, "doc_id long, source string, text string"), PATH).collect()
    check(out, docs, 4096)
    tokens = defaultdict(int)
    for p in out:
        tokens[p.source] += p.length
    found = variations(out, 4096, {s: n / sum(tokens.values()) for s, n in tokens.items()})
    assert len(found) == sum(tokens.values()) // 4096 > 100
    assert max(found.values()) < 0.05


def test_given_targets_while_all_sources_last(spark):
    ship(spark)
    docs = [(i, "ab"[i % 4 == 0], "word " * (900 if i % 10 == 0 else 20)) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    out = packing.pack(df, PATH, 1024, {"a": 1, "b": 1}).collect()
    check(out, docs, 1024)
    last = {s: max(p.sequence_id for p in out if p.source == s) for s in "ab"}
    found = variations(out, 1024, {"a": 0.5, "b": 0.5})
    until = min(last.values())
    assert until > 50 and max(x for q, x in found.items() if q < until) < 0.01


def test_small_sources_save_up_and_come_in_turn(spark):
    """A source whose share is below the least number of tokens is not cut into crumbs."""
    ship(spark)
    docs = [(i, f"s{i % 300}" if i % 2 else "hot", "word " * 150) for i in range(1800)]
    out = packing.pack(spark.createDataFrame(docs, "doc_id long, source string, text string"), PATH, 1024, least=64).collect()
    check(out, docs, 1024)
    sizes = sorted(p.length for p in out if p.source != "hot")
    assert np.median(sizes) >= 40
    hot = defaultdict(int)
    for p in out:
        hot[p.sequence_id] += p.length * (p.source == "hot")
    full = [hot[q] / 1024 for q in range(sum(p.length for p in out) // 1024)]
    assert abs(np.mean(full) - 0.5) < 0.02 and np.percentile(full, 95) < 0.8


def test_targets_above_zero(spark):
    df = spark.createDataFrame(docs_of(3), "doc_id long, source string, text string")
    with pytest.raises(ValueError):
        packing.pack(df, PATH, 1024, {"hot": 0.0, "s1": 1.0})


def test_empty_table(spark):
    ship(spark)
    assert packing.pack(spark.createDataFrame([], "doc_id long, source string, text string"), PATH).count() == 0


def test_pieces_at_window_ends():
    tail = packing.window_starts(4096 + 7, 4096)
    assert tail == [4096, 4100, 4102]
    assert packing.pieces_of(4090, 13, 4103, 4096, tail) == [(0, 6, 0, 4090), (6, 4, 1, 0), (10, 2, 2, 0), (12, 1, 3, 0)]


def test_query(spark, tmp_path):
    docs = docs_of(40)
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    tok = Tokenizer.from_file(PATH)
    texts = {d: t for d, _, t in docs}
    rows = QUERIES["op7_packing"](spark, str(tmp_path)).collect()
    for r in rows:
        ids = [*tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_chunks_equal_the_library():
    rng, tok = random.Random(3), Tokenizer.from_file(PATH)
    letters = [*"abstXYÉéßµªﬁİǅ日 ,.!%|'-<>09 \n\t\r  ́", "'s", "'ll", "<|endoftext|>", "<|startoftext|>", " the", "Word,", "Über."]
    coder = packing.chunks(PATH)
    for _ in range(4000):
        t = "".join(rng.choices(letters, k=rng.randint(0, 40)))
        assert np.frombuffer(coder.encode(t), coder.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t
