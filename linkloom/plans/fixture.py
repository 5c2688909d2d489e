"""Person-like records made of the documents table, for the queries over generated data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators import records as rec
from linkloom.sources.tables import cut

JOBS = ["Cultivateur / Pasteur", "Commerçant", "Elève", "Enfant", "Inconnu", "Zork", "Infirmière", "Taxi moto"]


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    ws = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    n = F.col("n_chars")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("row"),
        F.when(F.expr("doc_id div 20") % 4 == 3, "d2").otherwise("d1").alias("source_dataset"),
        F.array_join(F.slice(ws, 1, 4), " ").alias("name"),
        (n % 120).cast("int").alias("age"),
        F.when(F.col("quality") == 1, "Male").when(F.col("quality") == 0, "Female").otherwise("Unknown").alias("sex"),
        F.col("lang").alias("adm1"),
        F.col("source").alias("adm2"),
        F.concat("source", F.lit(" "), (n % 7).cast("string")).alias("adm3"),
        F.when(n % 5 != 0, F.concat(F.lit("Q. "), F.array_join(F.slice(ws, 5, 2), " / "), F.lit(" N"), (n % 90).cast("string"))).alias("adm4"),
        F.when(n % 3 != 0, F.concat(F.lit("0"), (800000000 + (n * 7919) % 100000000).cast("string"))).alias("phone_raw"),
        F.get(F.array(*map(F.lit, JOBS)), (n % 8).cast("int")).alias("job_raw"),
        F.md5(F.col("text").cast("binary")).alias("truth"),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.clean(rows(spark, sf_dir))


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = clean(spark, sf_dir)
    return c.where("source_dataset = 'd1'"), c.where("source_dataset = 'd2'")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once to the shared folder: both sides of every join read it. The export reads the clean rows many times, so these are written too."""
    c = cut(clean(spark, sf_dir))
    return cut(rec.export(c.where("source_dataset = 'd1'"), c.where("source_dataset = 'd2'")))
