"""Aggregates for looking at fields before and after cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.similarity import jaro_winkler


def missingness(df: DataFrame) -> DataFrame:
    """col, n_missing, pct_missing; one pass over all columns."""
    got = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return got.unpivot(["_n"], list(df.columns), "col", "n_missing").select("col", "n_missing", F.round(F.try_divide(100.0 * F.col("n_missing"), F.col("_n")), 1).alias("pct_missing"))


def field_summary(df: DataFrame) -> DataFrame:
    tokens = df.select(F.explode("adm4_tokens").alias("t")).agg(F.count_distinct("t").alias("adm4_distinct_tokens"))
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    got = df.agg(F.count("*").alias("records"), F.count_distinct("adm2").alias("adm2_distinct"), F.count_distinct("adm3").alias("adm3_distinct"), F.count_if(n("adm4_tokens") >= 1).alias("adm4_any_token"), F.count_if(n("phones") >= 1).alias("phone_any"), F.count_if(n("phones") >= 2).alias("phone_two_plus"), F.max(n("phones")).cast("long").alias("phone_max"))
    return got.join(F.broadcast(tokens))


def alignment_summary(maps: DataFrame) -> DataFrame:
    """maps: field, direction, from, to, n."""
    return maps.groupBy("field", "direction").agg(F.count("*").alias("values"), F.sum("n").alias("records"))


def top(df: DataFrame, n: int, by: list[str], order: str = "n", *ties: str) -> DataFrame:
    """The first n rows of each group in descending order; ties broken, not kept."""
    w = Window.partitionBy(*by).orderBy(F.desc(order), *ties)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def phone_yield(df: DataFrame, raw: str = "phone_raw") -> DataFrame:
    n = F.coalesce(F.size("phones"), F.lit(0))
    return df.agg(F.count(raw).alias("raw_non_missing"), F.count_if(n >= 1).alias("one_plus"), F.count_if(n >= 2).alias("two_plus"), F.count_if(F.col(raw).isNotNull() & (n == 0)).alias("raw_but_no_number"))


def phone_digits(df: DataFrame) -> DataFrame:
    return df.select(F.explode("phones").alias("p")).groupBy(F.length("p").alias("digits")).agg(F.count("*").alias("n"))


def numbers_by_sharing(df: DataFrame) -> DataFrame:
    return df.select(F.explode("phones").alias("p")).groupBy("p").agg(F.count("*").alias("records")).groupBy("records").agg(F.count("*").alias("numbers"))


def reach(d1: DataFrame, d2: DataFrame, values: str) -> DataFrame:
    """distinct_d1, distinct_d2, in_both, d2_records, d2_records_sharing: how far sets of two tables meet."""
    v1, v2 = (d.select(F.explode(values).alias("v")).distinct() for d in (d1, d2))
    own = d2.select("row", F.explode(values).alias("v"))
    parts = [v1.agg(F.count("*").alias("distinct_d1")), v2.agg(F.count("*").alias("distinct_d2")), v1.join(v2, "v").agg(F.count("*").alias("in_both")), own.agg(F.count_distinct("row").alias("d2_records")), own.join(v1, "v", "left_semi").agg(F.count_distinct("row").alias("d2_records_sharing"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))
    return out


def distribution(df: DataFrame, value: str, by: str) -> DataFrame:
    """by, value, n, pct within by."""
    n = df.groupBy(by, value).agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(by)), 1))


def set_sizes(df: DataFrame, values: str, by: str) -> DataFrame:
    return df.groupBy(by, F.coalesce(F.size(values), F.lit(0)).alias("members")).agg(F.count("*").alias("n"))


def membership(df: DataFrame, values: str, by: str) -> DataFrame:
    return df.select(by, F.explode(values).alias("member")).groupBy(by, "member").agg(F.count("*").alias("n"))


def wide(df: DataFrame, key: str, by: str, names: list[str], value: str = "n") -> DataFrame:
    """One row for each key, one column for each name of by; 0 where there is none."""
    return df.groupBy(key).pivot(by, names).agg(F.sum(value)).fillna(0, names)


def mapping(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def agreement(df: DataFrame, a: str, b: str, cut: float = 0.85) -> DataFrame:
    """Two spellings of a field: agree, spelling_variant, different, either_missing, joined_missing."""
    jw = jaro_winkler(F.col(a), F.col(b))
    differ = F.col(a) != F.col(b)
    return df.agg(F.count_if(F.col(a) == F.col(b)).alias("agree"), F.count_if(differ & (jw >= cut)).alias("spelling_variant"), F.count_if(differ & (jw < cut)).alias("different"), F.count_if(F.col(a).isNull() | F.col(b).isNull()).alias("either_missing"), F.count_if(F.col(b).isNull()).alias("joined_missing"))


def dominant(df: DataFrame, child: str, parent: str, least: int = 3, share: float = 0.8) -> DataFrame:
    """child and its parent, where one holds that share of least records or more (ties: first in order)."""
    n = df.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).groupBy(child, parent).agg(F.count("*").alias("n"))
    n = n.withColumn("tot", F.sum("n").over(Window.partitionBy(child)))
    return top(n, 1, [child], "n", parent).where((F.col("tot") >= least) & (F.col("n") / F.col("tot") >= share)).select(child, parent)


def arbitration(df: DataFrame, dominants: DataFrame, child: str, parent: str, a: str, b: str, cut: float = 0.85) -> DataFrame:
    """Where two spellings differ, which one the child's dominant parent agrees with."""
    x = df.join(dominants.select(child, F.col(parent).alias("_parent")), child).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).where(jaro_winkler(F.col(a), F.col(b)) < cut)
    return x.agg(F.count("*").alias("records"), F.count_if(F.col("_parent") == F.col(a)).alias("agrees_a"), F.count_if(F.col("_parent") == F.col(b)).alias("agrees_b"), F.count_if((F.col("_parent") != F.col(a)) & (F.col("_parent") != F.col(b))).alias("neither"))


def token_yield(df: DataFrame, tokens: str, raw: str) -> DataFrame:
    n = F.coalesce(F.size(tokens), F.lit(0))
    distinct = df.select(F.explode(tokens).alias("t")).agg(F.count_distinct("t").alias("distinct_tokens"))
    return df.agg(F.count(raw).alias("raw_non_missing"), F.count_if(n >= 1).alias("one_plus"), F.count_if(n >= 2).alias("two_plus")).join(F.broadcast(distinct))
