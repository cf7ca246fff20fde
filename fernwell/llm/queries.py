"""The queries of this subpackage: opN_<name>(spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


@_query
def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import mismatched_replies, preference_pairs

    turns = table(spark, sf_dir, "conversations")
    return preference_pairs(
        turns.withColumn("pair_id", F.col("conv_id")),
        mismatched_replies(turns).withColumn("pair_id", F.col("conv_id")),
    )


ORACLE["op8_preference_pairs"] = """
WITH c AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
), l AS (
  SELECT conv_id, max(turn) AS last_turn FROM c WHERE role = 'assistant' GROUP BY conv_id
), reply AS (
  SELECT c.conv_id, max(c.text) AS reply, max(l.last_turn) AS last_turn
  FROM c JOIN l ON c.conv_id = l.conv_id AND c.turn = l.last_turn WHERE c.role = 'assistant' GROUP BY c.conv_id
), swap AS (
  SELECT a.conv_id, a.last_turn, b.reply FROM reply a JOIN reply b ON b.conv_id = xor(a.conv_id, 1)
), r AS (
  SELECT DISTINCT c.conv_id, c.turn, c.role,
    CASE WHEN c.role = 'assistant' AND c.turn = s.last_turn THEN s.reply ELSE c.text END AS text
  FROM c LEFT JOIN swap s ON s.conv_id = c.conv_id
), cn AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM c),
rn AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM r),
cut AS (
  SELECT coalesce(cn.conv_id, rn.conv_id) AS conv_id,
    min(CASE WHEN cn.text IS DISTINCT FROM rn.text OR cn.role IS DISTINCT FROM rn.role
        THEN coalesce(cn.i, rn.i) END) - 1 AS k, max(greatest(coalesce(cn.i, 0), coalesce(rn.i, 0))) AS n
  FROM cn FULL OUTER JOIN rn ON cn.conv_id = rn.conv_id AND cn.i = rn.i GROUP BY 1
), both_sides AS (
  SELECT cut.conv_id, coalesce(k, n) AS k, 'c' AS side, i, role, text FROM cut JOIN cn ON cn.conv_id = cut.conv_id
  UNION ALL
  SELECT cut.conv_id, coalesce(k, n) AS k, 'r' AS side, i, role, text FROM cut JOIN rn ON rn.conv_id = cut.conv_id
), m AS (
  SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS whole FROM both_sides
), p AS (
  SELECT *, coalesce(sum(CASE WHEN i > k THEN length(whole) END)
    OVER (PARTITION BY conv_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM m
)
SELECT conv_id AS pair_id, max(k) AS n_prompt_turns,
  coalesce(string_agg(whole, '' ORDER BY i) FILTER (WHERE side = 'c' AND i <= k), '') AS prompt,
  coalesce(string_agg(whole, '' ORDER BY i) FILTER (WHERE side = 'c' AND i > k), '') AS chosen,
  coalesce(string_agg((pos + 13 + length(role))::BIGINT || ':' || (pos + length(whole) - 1)::BIGINT, ',' ORDER BY i)
    FILTER (WHERE side = 'c' AND i > k AND role = 'assistant'), '') AS chosen_loss,
  coalesce(string_agg(whole, '' ORDER BY i) FILTER (WHERE side = 'r' AND i > k), '') AS rejected,
  coalesce(string_agg((pos + 13 + length(role))::BIGINT || ':' || (pos + length(whole) - 1)::BIGINT, ',' ORDER BY i)
    FILTER (WHERE side = 'r' AND i > k AND role = 'assistant'), '') AS rejected_loss
FROM p GROUP BY conv_id
"""


@_query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import scan

    return scan(table(spark, sf_dir, "documents"))


@_query
def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@_query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import link_components

    return link_components(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """Where the installed public tokenizers have a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .grammar import through_files

    return through_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@_query
def op10_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op3_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@_query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find

    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
