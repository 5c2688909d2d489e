"""The queries of the ten operators, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import chat, decontamination, jaccard, langid, mixing, neardup, repeats, secrets, tokenids, toxicity
from linkloom.llm.common import Workspace

PROBE = "\\### Assistant: </turn> ok"


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_id_output(table(spark, sf_dir, "documents"), vocabulary())


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    with Workspace(spark, "op2") as ws:
        return chat.digests(ws.keep(chat.format_chats(rows.unionByName(probe)), "formatted"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


#: The tokens of the input, by domain, then language; sources of a language alike. A text is taken twice at most.
WEIGHTS = {"d0": (0.4, {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}), "d1": (0.3, {"en": 0.4, "*": 0.2}), "d2": 0.2, "d3": 0.1}


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.join(table(spark, sf_dir, "embeddings"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix_sources(docs, WEIGHTS, seed=7, max_epochs=2).select("doc_id", "mix_domain", "mix_lang", "mix_source", "mix_tokens", "mix_epoch")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_ids": op1_token_ids,
    "op2_chat_format": op2_chat_format,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_secret_scan": op4_secret_scan,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
}

OP2_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), turns AS (
  SELECT *, (contains(role || text, '</turn>') OR regexp_matches(role || chr(10) || text, '(?s)\\\\[^\\n]') OR contains(role, ': ')
    OR regexp_matches(text, '(?s)\\\\.')) AS hard FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN hard THEN length(replace(replace(text, '\\', '\\\\'), '</turn>', '<\\/turn>'))
      + length(replace(replace(replace(role, '\\', '\\\\'), '</turn>', '<\\/turn>'), ':', '\\c'))
    ELSE length(role) + length(text) END + 14)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES: dict[str, str] = {"op2_chat_format": OP2_SQL}
