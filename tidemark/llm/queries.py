"""The registered queries: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import license_scan
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Where the public vocabularies are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


@query("op1_exact_dedup", """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import bpe

    path = tokenizer_file("byte_bpe_50k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, may_learn=~langid.held_out("doc_id", 4, 2))
    scored = langid.predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", langid.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"))


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import pii

    return pii.digests(pii.detect(table(spark, sf_dir, "documents")))


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import quality_mil

    docs = table(spark, sf_dir, "documents")
    model = quality_mil.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_mil.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality_mil.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import ann

    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op7_chat_formatting", """
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(replace(text, '\\', '\\\\'), '([<\\[])((?:/?s>)|(?:/?INST\\])|(?:</?(?:SYS|ROLE)>>))',
             '\\1\\\\\\2', 'g') AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       CAST(sum(length(escaped) + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 4 ELSE 33 END) AS BIGINT)
           AS formatted_chars
FROM e GROUP BY conv_id
""")
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    path = tokenizer_file("byte_bpe_50k.json")
    return chat.digests(chat.build_forest(rows.unionByName(extra), path), path)


@query("op6_license_scan", license_scan.oracle_sql())
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query("op11_source_mixing", """
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
                  (('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13))::BIGINT)
                  / 4503599627370496.0::DOUBLE AS draw FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
f AS (SELECT *, 2 * size AS cap, sum(size) OVER () AS all_size, sum(w) OVER () AS all_w,
             coalesce(sum(size) OVER before, 0) AS size_before, coalesce(sum(w) OVER before, 0) AS w_before
      FROM s WINDOW before AS (ORDER BY 2 * size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, size_before * 2.0::DOUBLE + cap / w * (all_w - w_before) <= 1.5::DOUBLE * all_size AS is_full FROM f),
t AS (SELECT source, size, CASE WHEN is_full THEN cap ELSE least(cap, w * (1.5::DOUBLE * all_size
             - 2 * coalesce(sum(size) FILTER (is_full) OVER (), 0)) / greatest(all_w - coalesce(sum(w) FILTER (is_full) OVER (), 0), 1)) END
             AS target FROM g),
r AS (SELECT *, CASE WHEN size > 0 THEN target / size ELSE 0 END AS rate FROM t)
SELECT doc_id, d.size AS size, CAST(r.size AS BIGINT) AS source_size, target, rate,
       CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies,
       (CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT)) * d.size AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
""")
def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op13_hard_negatives", """
WITH e AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                  CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM pos p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


@query("op12_prefix_trie", """
WITH t AS (SELECT conv_id, words, md5, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5) AS d FROM (
             SELECT *, md5(length(r) || ':' || r || x) AS md5, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words
             FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
                   WHERE conv_id IS NOT NULL))),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
             xor(4294967295, list_reduce([4294967295] || list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
                 lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS BIGINT), 1)) AS BIGINT)), lambda acc, b:
                 list_reduce([xor(acc, b)] || range(8), lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384)
                             ELSE y >> 1 END))) % 4 AS h FROM t GROUP BY conv_id),
w AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS k FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT w.conv_id, t.d, t.md5, t.words FROM w JOIN t ON t.conv_id = w.base AND t.d <= w.k
      UNION ALL SELECT w.conv_id, t.d - w.h + w.k, t.md5, t.words FROM w JOIN t ON t.conv_id = w.conv_id AND t.d > w.h),
p AS (SELECT conv_id, d, words, list(md5) OVER (PARTITION BY conv_id ORDER BY d) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, [] FROM c),
e AS (SELECT conv_id, max(d) AS last FROM p GROUP BY conv_id),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = last), '')) AS ends_sha256
      FROM p JOIN e USING (conv_id) GROUP BY path, d),
k AS (SELECT path[:-2] AS path, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
a AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path, d)),
s AS (SELECT path[:anc] AS path, anc AS d, sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM a, LATERAL (SELECT unnest(range(CAST(a.d AS BIGINT) + 1)) AS anc) GROUP BY 1, 2)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, CAST(a.n_convs AS BIGINT) AS n_convs,
       CAST(a.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, a.ends_sha256
FROM a JOIN s ON s.path = a.path AND s.d = a.d LEFT JOIN n parent ON parent.path = a.path[:-2] AND parent.d = a.d - 1
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import prefix_trie as trie
    from tidemark.llm.common import materialise

    turns = materialise(trie.ordered_turns(table(spark, sf_dir, "conversations")), "trie-ordered")
    conv = F.col("conv")
    rebuilt = trie.splice(turns, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, longest=3)
    return trie.prefix_trie(rebuilt, turns.select("conv"))
