"""The operators of this subpackage over the whole intended tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.alignment import align_tokenizers
from tallyflow.llm.chat import format_conversations, read_conversations
from tallyflow.llm.embedding_dedup import embedding_dedup
from tallyflow.llm.hard_negatives import hard_negatives
from tallyflow.llm.line_dedup import line_dedup
from tallyflow.llm.minhash_dedup import minhash_dedup
from tallyflow.llm.mixing import mix_shares
from tallyflow.llm.packing import pack_documents
from tallyflow.llm.quality_nbsvm import quality_scores
from tallyflow.llm.quality_rules import quality_rules
from tallyflow.llm.secrets import find_secrets, secret_digest
from tallyflow.llm.token_counts import token_counts
from tallyflow.llm.toxicity import toxicity_scores


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file of that name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_lines, n_kept and the SHA-256 of the text that is left."""
    return line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("text_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(_table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_shares(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(find_secrets(_table(spark, sf_dir, "documents")))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, number -7, whose texts hold control strings."""
    odd = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    tokenizer = tokenizer_path("byte_bpe_50k.json")
    return read_conversations(format_conversations(turns, tokenizer), tokenizer)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every fiftieth vec_id. Every seventh row's label is moved on by one; components are whole 256ths."""
    rows = _table(spark, sf_dir, "embeddings").where("not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return hard_negatives(rows.select("vec_id", label.alias("label"), whole.alias("vector"), (F.col("vec_id") % 50 == 0).alias("anchor")))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def quality_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op4 that SQL can state."""
    return op4_quality_rules(spark, sf_dir).drop("kept", "posterior")


def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op8 that SQL can state."""
    return op8_secret_scan(spark, sf_dir).drop("base_sha256", "spans")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op6 that SQL can state."""
    return op6_source_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 4).alias("target"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_line_dedup, op2_token_counts, op3_quality_classifier, op4_quality_rules, op5_minhash_dedup, op6_source_mixing, op7_toxicity, op8_secret_scan, op9_best_fit_packing, op10_embedding_dedup, op11_chat_format, op12_hard_negatives, op13_tokenizer_alignment, quality_base_columns, secret_base_counts, mix_targets)
    return {f.__name__: f for f in every}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def oracle_sql() -> dict[str, str]:
    """SQL for the parts that it can state; ``tests/llm`` holds the operators against brute force."""
    return {
        "quality_base_columns": rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
 w AS (SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS win FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)),
 g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM w),
 r AS (SELECT rid, count(DISTINCT i + o) AS n FROM g, (VALUES (0), (1), (2), (3), (4)) AS v(o) WHERE c > 1 GROUP BY rid),
 b AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines, coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN r ON d.rid = r.rid)
 SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b""",
        "secret_base_counts": r"""SELECT doc_id, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:(password|passwd|secret|token|api_?key))["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 12)) AS BIGINT) AS n_assign,
 CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS BIGINT) AS n_access, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 16)) AS BIGINT) AS n_hex FROM documents""",
        "op12_hard_negatives": """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * r.x[i])) AS BIGINT) AS score FROM v a, v r WHERE a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
 SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s ON p.anchor_id = s.anchor_id
 WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3""",
        "mix_targets": rf"""WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
 n AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS no, CAST([3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS w FROM s),
 f AS (SELECT *, 2.0::DOUBLE * source_size AS cap, coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM n),
 l AS (SELECT level FROM (SELECT greatest((total - before) / open, 0) AS level, cap, w, no FROM f) WHERE level * w <= cap ORDER BY cap / w, no LIMIT 1)
 SELECT d.doc_id, d.size, f.source_size, round(least(f.cap, coalesce((SELECT level FROM l) * f.w, f.cap)), 4) AS target FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source""",
    }
