"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathmatch.llm import bpe, chat, html_text, knn, ngram_join, packing, pieces, quality, repeats, search, secrets, toxicity, trie
from swathmatch.llm.shared import ship, table

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.held_out()
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op1_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL["op1_knn"] = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
               FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and number -7, whose texts are nothing but control strings."""
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.windows(convs, public_tokenizers.path("byte_bpe_50k.json")))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.listed(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


@query
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


SQL["op11_search"] = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[0-9a-z\x{80}-\x{10FFFF}]+') AS words FROM documents WHERE text IS NOT NULL),
    sized AS (SELECT doc_id, len(words) AS n FROM d WHERE len(words) > 0),
    corpus AS (SELECT count(*) AS n_docs, sum(n) AS n_words FROM sized),
    posting AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) GROUP BY ALL),
    weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
               FROM posting, corpus GROUP BY term, n_docs),
    asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
    scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words)))) AS BIGINT) AS score
               FROM asked JOIN weight USING (term) JOIN posting USING (term) JOIN sized USING (doc_id), corpus GROUP BY item_id, doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""


@query
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trie.prefix_trie(*trie.with_openings(trie.turns(table(spark, sf_dir, "conversations"))))
    return found.drop("node", "parent")


SQL["op13_trie"] = """
    WITH own AS (SELECT conv_id, struct_pack(said_by := coalesce(role, ''), said := coalesce(text, '')) AS t,
                        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
                 FROM conversations WHERE conv_id IS NOT NULL),
    conv AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
                    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), range(0, 8 * len(CAST(conv_id AS VARCHAR)))), lambda r, i:
                        ((CASE WHEN i % 8 = 0 THEN xor(r, ascii(substr(CAST(conv_id AS VARCHAR), i // 8 + 1, 1))) ELSE r END) >> 1)
                        .xor(3988292384 * ((CASE WHEN i % 8 = 0 THEN xor(r, ascii(substr(CAST(conv_id AS VARCHAR), i // 8 + 1, 1))) ELSE r END) & 1))),
                        4294967295) % 6 AS h
             FROM own GROUP BY conv_id),
    said AS (SELECT c.conv_id, o.pos, o.t FROM conv AS c JOIN own AS o ON o.conv_id = c.base WHERE o.pos < c.h
             UNION ALL SELECT c.conv_id, o.pos + 1000000, o.t FROM conv AS c JOIN own AS o ON o.conv_id = c.conv_id WHERE o.pos >= c.h),
    whole AS (SELECT c.conv_id, coalesce(s.ts, []) AS ts
              FROM conv AS c LEFT JOIN (SELECT conv_id, list(t ORDER BY pos) AS ts FROM said GROUP BY conv_id) AS s USING (conv_id)),
    part AS (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS depth FROM whole),
    node AS (SELECT ts[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                    sha256(coalesce(string_agg(CASE WHEN len(ts) = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
             FROM part GROUP BY ts[1:depth], depth),
    child AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
    full_node AS (SELECT node.*, coalesce(child.n, 0) AS n_children,
                         CASE WHEN node.depth > 0 THEN (n_convs - 1) * length(node.prefix[node.depth].said) ELSE 0 END AS saved
                  FROM node LEFT JOIN child ON child.depth = node.depth AND child.prefix = node.prefix),
    subtree AS (SELECT v.prefix, v.depth, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, CAST(sum(u.saved) AS BIGINT) AS saved_tokens
                FROM full_node AS v JOIN full_node AS u ON u.prefix[1:v.depth] = v.prefix GROUP BY v.prefix, v.depth)
    SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
    FROM full_node AS v JOIN subtree AS s ON s.depth = v.depth AND s.prefix = v.prefix
    LEFT JOIN node AS up ON up.depth = v.depth - 1 AND up.prefix = v.prefix[1:v.depth - 1]"""
