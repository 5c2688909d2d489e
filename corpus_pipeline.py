"""From raw documents to token-id files: five stages, each on all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``. Its
result is written as Parquet to the folder that the cluster shares and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import decontamination, jaccard, langid, mixing, tokenids
from linkloom.llm.common import Workspace
from linkloom.llm.queries import WEIGHTS, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts without a letter (null and empty ones too), for which no language can be told; fills a null lang.

    Where no row has a lang nothing is learned, and lang stays null.
    """
    model = langid.fit(docs, F.col("doc_id").isNotNull())
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    kept = langid.score(docs, model, COLUMNS).where(F.col("lang_pred") != langid.UND)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that of the least doc_id."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that overlap a benchmark item."""
    return decontamination.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, by the target weights; a document may come twice."""
    return mixing.mix_sources(docs.select(*COLUMNS), WEIGHTS, seed=7, max_epochs=2).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token-id files and returns a row for each document in them."""
    return tokenids.token_id_output(docs, vocabulary())


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("mix_sources", mixture),
    ("token_ids", token_ids),
]

#: SQL cannot express the language model, the seeded mixture or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Workspace(spark, "pipeline") as ws:
        for name, stage in STAGES[:-1]:
            docs = ws.save(stage(spark, docs, sf_dir), name)
        return ws.keep(STAGES[-1][1](spark, docs, sf_dir))
