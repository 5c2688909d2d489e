"""From harmonised rows to clean records, and to the records that a model compares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import occupations, phones, places, text
from linkloom.operators import vocab
from linkloom.sources.tables import cut

EXPORT = ["unique_id", "source_dataset", "name_tokens", "block_tokens", "tf_tokens", "tf_bits", "name_key", "date", "age", "sex", "adm1", "adm2", "adm3", "adm4_tokens", "job_cats", "phones"]


def clean(rows: DataFrame) -> DataFrame:
    """rows: row, name, date, age, sex, adm1 to adm4, phone_raw, job_raw and any others, which stay."""
    return rows.withColumns({
        "name_tokens": text.name_tokens(F.col("name")),
        "age": text.in_range(F.col("age").cast("int")),
        "sex": text.in_domain(F.col("sex")),
        "adm1": text.std_text(F.col("adm1")),
        "adm2": text.std_text(F.col("adm2")),
        "adm3": text.std_text(F.col("adm3")),
        "adm4_tokens": places.adm4_tokens(F.col("adm4")),
        "phones": phones.phone_set(F.col("phone_raw")),
        "job_cats": occupations.from_text(F.col("job_raw")),
    }).drop("name", "adm4", "phone_raw", "job_raw")


def harmonize(d1: DataFrame, d2: DataFrame, theta: float = 0.94, max_n: int = 5, max_records: int = 10) -> tuple[DataFrame, DataFrame]:
    """Spelling variants of places aligned between two clean tables, and phone numbers of many records dropped.

    Each step reads both tables several times, so what it makes is written before the next one.
    """
    d1, d2 = (cut(vocab.snap_rare_levels(d, "adm1")) for d in (d1, d2))
    for c in ("adm2", "adm3", "adm4_tokens"):
        d1, d2, _, _ = vocab.align_both(d1, d2, c, theta=theta, max_n=max_n, tokens=c == "adm4_tokens")
        d1, d2 = cut(d1), cut(d2)
    gone = vocab.shared_values(d1, d2, "phones", "row", max_records)
    return vocab.drop_values(d1, "phones", gone, "row"), vocab.drop_values(d2, "phones", gone, "row")


def export(d1: DataFrame, d2: DataFrame) -> DataFrame:
    """The model's input records of both tables; empty sets are null."""
    surprisal = vocab.token_surprisal(d1, d2)
    stop = vocab.stop_tokens(d1, d2)
    out = []
    for name, d in (("d1", d1), ("d2", d2)):
        full = text.full_tokens(F.col("name_tokens"))
        d = d.withColumn("block_tokens", F.array_distinct(full)).withColumn("name_key", text.name_key(F.col("name_tokens")))
        d = vocab.token_bits(vocab.drop_values(d, "block_tokens", stop.withColumnRenamed("token", "value"), "row"), surprisal)
        d = d.withColumn("job_cats", occupations.compared(F.col("job_cats")))
        d = d.withColumns({c: text.null_if_empty(F.col(c)) for c in ("name_tokens", "block_tokens", "adm4_tokens", "job_cats", "phones")})
        d = d if "date" in d.columns else d.withColumn("date", F.lit(None).cast("date"))
        out.append(d.withColumn("unique_id", F.col("row")).withColumn("source_dataset", F.lit(name)).select(*EXPORT))
    return out[0].unionByName(out[1])
