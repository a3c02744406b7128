"""The operators over the given tables with production parameters, and their SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import (
    chat,
    decontam,
    jaccard,
    language,
    packing,
    pages,
    passages,
    repair,
    rules,
    simhash,
    tokens,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.is_held_out(F.col("doc_id")))
    parser = language.train(docs.filter(~F.col("held_out")))
    return language.identify(docs.drop("lang"), parser).drop("text")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.extract(rows, pages.train(rows)).drop("html")


#: A conversation of the contract: both turns say what could be taken for marks.
MARKED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED, "conv_id bigint, turn bigint, role string, text string")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return chat.digests(chat.format_turns(turns.union(marked), ranks), ranks)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit")
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, chain).drop("text")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        rules.fails(rules.BASE).alias("base_failed"),
        (~rules.fails(rules.BASE) & ~rules.fails(rules.STRICT)).alias("kept"),
        "failed_bits",
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, width=4, max_bits=4, keep_text=False)
    return found.select("doc_id", "fingerprint", "component_id")


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_join(docs, width=4, similarity=85)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.summary(repair.repaired(repair.damaged(turns), copy="copy"))
    convs = turns.select("conv_id").distinct()
    rows = convs.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return rows.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, k=4)
    rows = whitening.whiten(vectors, model)
    explained = F.array(*(F.lit(float(x)) for x in model.explained)).cast("array<double>")
    return rows.select(
        "vec_id", F.posexplode("whitened").alias("at", "whitened"), F.col("deviation").cast("long").alias("deviation")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_html_extraction": op3_html_extraction,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_token_counts": op5_token_counts,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_embedding_whitening": op13_embedding_whitening,
}

OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(regexp_replace(role, '(<\\*)(/?s>)', '\1\\\2', 'g'),
                           '(\[\\*)(/?INST\])', '\1\\\2', 'g') AS r,
         regexp_replace(regexp_replace(text, '(<\\*)(/?s>)', '\1\\\2', 'g'),
                        '(\[\\*)(/?INST\])', '\1\\\2', 'g') AS x
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                         ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(length(r) + length(x) + length('[INST][/INST]</s>')) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

OP6_SQL = r"""
WITH word AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS pattern,
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), upper, lower), pattern) AS w
  FROM documents, word
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower), pattern) AS w
  FROM benchmark, word
), wanted AS (
  SELECT item_id, list_slice(w, i, i + 9) AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT len(words) AS n FROM wanted
), there AS (
  SELECT row, i, n, list_slice(w, i, i + n - 1) AS words
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), found AS (
  SELECT DISTINCT row, i, there.n, item_id FROM there JOIN wanted USING (words)
), hits AS (
  SELECT row, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT row, unnest(range(i, i + n)) AS p FROM found) GROUP BY row
), items AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (row) LEFT JOIN items USING (row)
"""

OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS row
  FROM documents
), windows AS (
  SELECT row, unnest(range(1, len(w) - 1)) AS i, w FROM t
), repeated AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, w[i], w[i + 1], w[i + 2]) AS n FROM windows
), covered AS (
  SELECT row, count(DISTINCT i + k) AS n
  FROM repeated, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY row
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclaimed,
         CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM t LEFT JOIN covered USING (row)
), bits AS (
  SELECT *,
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars > 16 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END
    + CASE WHEN 10 * n_exclaimed > 3 * n_words THEN 128 ELSE 0 END AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed_bits
FROM bits
"""

OP11_SQL = r"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT row, array_to_string(list_slice(w, i, i + 3), ' ') AS gram
  FROM (SELECT row, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM t WHERE len(w) > 0)
), sizes AS (
  SELECT row, count(*) AS n, list(gram ORDER BY gram) AS grams FROM grams GROUP BY row
), sets AS (SELECT min(row) AS s, any_value(n) AS n, grams FROM sizes GROUP BY grams
), member AS (SELECT row, s FROM sizes JOIN sets USING (grams)
), own AS (SELECT s, gram FROM grams JOIN sets ON row = s
), overlap AS (
  SELECT a.s AS a, b.s AS b, count(*) AS shared
  FROM own a JOIN own b ON a.gram = b.gram AND a.s <> b.s GROUP BY a.s, b.s
), link AS (
  SELECT a, b FROM overlap JOIN sets x ON x.s = a JOIN sets y ON y.s = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach AS (
  SELECT s, s AS r FROM sets
  UNION SELECT reach.s, link.b FROM reach JOIN link ON reach.r = link.a
), lowest AS (
  SELECT reach.s, min(doc_id) AS component_id
  FROM reach JOIN member ON member.s = reach.r JOIN t ON t.row = member.row GROUP BY reach.s
)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
       CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM t LEFT JOIN sizes USING (row) LEFT JOIN member USING (row) LEFT JOIN lowest ON lowest.s = member.s
"""

ORACLE: dict[str, str] = {
    "op4_chat_formatting": OP4_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_ngram_jaccard_join": OP11_SQL,
}
