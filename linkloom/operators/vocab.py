"""Vocabularies: counting values, snapping variants, aligning two tables, shared and stop values, surprisal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.similarity import jaro_winkler
from linkloom.functions.text import full_tokens
from linkloom.sources.tables import cut

#: Above this many values a vocabulary is no longer broadcast.
BROADCAST_VALUES = 200_000


def small(df: DataFrame, most: int = BROADCAST_VALUES) -> DataFrame:
    """df, marked for broadcast if a count shows it small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def value_counts(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))


def likely_pairs(left: DataFrame, right: DataFrame, theta: float) -> DataFrame:
    """Pairs (a, b) whose Jaro-Winkler similarity is theta or more, with sim. left: a; right: b.

    For theta above 0.5 the first of these must hold, so the join is on it and not on everything: a similarity of
    theta needs a Jaro of (theta - 0.4) / 0.6, hence lengths within that ratio and a common character; the pairs meet on a
    shared character that is among the rarest of both (prefix filter over characters).
    """
    least = max(0.0, (theta - 0.4) / 0.6)
    share = max(0.0, 3 * least - 2)  # matched share of either side at least

    def keyed(df: DataFrame, c: str) -> DataFrame:
        chars = F.split(F.col(c), "")
        seen = F.transform(chars, lambda x, i: F.concat(x, F.size(F.filter(F.slice(chars, 1, i + 1), lambda y: y == x)).cast("string")))
        need = F.greatest(F.ceil(F.length(c) * share), F.lit(1))
        return df.withColumn("key", F.explode(F.slice(F.array_sort(seen), 1, (F.length(c) - need + 1).cast("int"))))

    pairs = keyed(left, "a").join(keyed(right, "b"), "key").drop("key").dropDuplicates(["a", "b"])
    return pairs.withColumn("sim", jaro_winkler(F.col("a"), F.col("b"))).where(F.col("sim") >= theta - 1e-12)


def best(pairs: DataFrame, *ties: str) -> DataFrame:
    w = Window.partitionBy("a").orderBy(F.desc(F.round("sim", 12)), *ties)
    return pairs.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def snap_map(df: DataFrame, value: str, min_share: float = 0.01, theta: float = 0.9) -> DataFrame:
    """from, to, sim: rare values and the frequent value that each resembles most (ties: the first in order)."""
    counts = value_counts(df, value)
    counts = counts.join(F.broadcast(counts.agg(F.sum("n").alias("total"))))
    frequent = F.col("n") >= min_share * F.col("total")
    pairs = likely_pairs(counts.where(~frequent).select(F.col(value).alias("a")), counts.where(frequent).select(F.col(value).alias("b")), theta)
    return best(pairs, "b").select(F.col("a").alias("from"), F.col("b").alias("to"), "sim")


def mapped(df: DataFrame, value: str, table: DataFrame) -> DataFrame:
    """df with each value that has an entry (from, to) replaced."""
    t = small(table.select(F.col("from").alias(value), F.col("to").alias("_to")))
    return df.join(t, value, "left").withColumn(value, F.coalesce("_to", value)).select(*df.columns)


def snap_rare_levels(df: DataFrame, value: str, min_share: float = 0.01, theta: float = 0.9) -> DataFrame:
    return mapped(df, value, snap_map(df, value, min_share, theta))


def align_map(x: DataFrame, ref: DataFrame, value: str, row: str, theta: float = 0.94, max_n: int | None = None) -> DataFrame:
    """from, to, n, jw: values of x that ref lacks, and ref's most similar value (ties: that of the first row)."""
    vocabulary = ref.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("b")).agg(F.min(row).alias("first"))
    own = value_counts(x, value).select(F.col(value).alias("a"), "n")
    own = own if max_n is None else own.where(F.col("n") < max_n)
    own = own.join(vocabulary.select(F.col("b").alias("a")), "a", "left_anti")
    return best(likely_pairs(own, vocabulary, theta), "first", "b").select(F.col("a").alias("from"), F.col("b").alias("to"), "n", F.round("sim", 3).alias("jw"))


def align_vocab(x: DataFrame, ref: DataFrame, value: str, row: str, theta: float = 0.94, max_n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """x with its values aligned to ref's, and the map."""
    table = align_map(x, ref, value, row, theta, max_n)
    return mapped(x, value, table), table


def token_rows(df: DataFrame, tokens: str, row: str) -> DataFrame:
    """Distinct (row, token)."""
    return df.select(row, F.explode(tokens).alias("token")).distinct()


def align_tokens(x: DataFrame, ref: DataFrame, tokens: str, row: str, theta: float = 0.94, max_n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The same over the tokens of sets; sets lose duplicates, order kept."""
    table = align_map(token_rows(x, tokens, row), token_rows(ref, tokens, row), "token", row, theta, max_n)
    t = small(table.select(F.col("from").alias("token"), "to"))
    moved = x.select(row, F.posexplode(tokens).alias("pos", "token")).join(t, "token", "left")
    moved = moved.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("to", "token").alias("token")))).alias("s"))
    moved = moved.select(row, F.array_distinct(F.transform("s", lambda p: p["token"])).alias("_tokens"))
    out = x.join(moved, row, "left").withColumn(tokens, F.coalesce("_tokens", F.when(F.col(tokens).isNotNull(), F.array().cast("array<string>"))))
    return out.select(*x.columns), table


def align_both(d1: DataFrame, d2: DataFrame, value: str, row: str = "row", theta: float = 0.94, max_n: int = 5, tokens: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Second table to the first, then rare values of the first to the second as it is then; both maps."""
    f = align_tokens if tokens else align_vocab
    d2, to_1 = f(d2, d1, value, row, theta)
    d2, to_1 = cut(d2), cut(to_1)  # the second step reads them more than once
    d1, to_2 = f(d1, d2, value, row, theta, max_n)
    return d1, d2, to_1, to_2


def shared_values(d1: DataFrame, d2: DataFrame, values: str, row: str, most: int = 10) -> DataFrame:
    """value, records: members of sets on more than so many records of both tables together."""
    every = token_rows(d1, values, row).select("token").union(token_rows(d2, values, row).select("token"))
    return every.groupBy(F.col("token").alias("value")).agg(F.count("*").alias("records")).where(F.col("records") > most)


def drop_values(df: DataFrame, values: str, gone: DataFrame, row: str) -> DataFrame:
    """df whose sets lack the values of gone; a few hold them, and only those are touched."""
    hit = df.select(row, F.explode(values).alias("value")).join(gone.select("value"), "value").groupBy(row).agg(F.collect_set("value").alias("_gone"))
    out = df.join(hit, row, "left")
    return out.withColumn(values, F.when(F.col("_gone").isNull(), F.col(values)).otherwise(F.array_except(values, "_gone"))).select(*df.columns)


def token_long(df: DataFrame, row: str = "row", tokens: str = "name_tokens") -> DataFrame:
    return df.select(row, F.explode(full_tokens(F.col(tokens))).alias("token")).distinct()


def stop_tokens(d1: DataFrame, d2: DataFrame, share: float = 0.05, row: str = "row", tokens: str = "name_tokens") -> DataFrame:
    """Full tokens on more than that share of either table's records."""
    out = []
    for d in (d1, d2):
        total = d.agg((F.count("*") * share).alias("most"))
        out.append(token_long(d, row, tokens).groupBy("token").agg(F.count("*").alias("n")).join(F.broadcast(total)).where("n > most").select("token"))
    return out[0].union(out[1]).distinct()


def token_surprisal(d1: DataFrame, d2: DataFrame, add: int = 2, row: str = "row", tokens: str = "name_tokens") -> DataFrame:
    """token, n, s: records that hold the token, over both tables, and its surprisal in bits."""
    every = token_long(d1, row, tokens).select("token").union(token_long(d2, row, tokens).select("token"))
    total = d1.select(row).union(d2.select(row)).agg(F.count("*").alias("records"))
    return every.groupBy("token").agg(F.count("*").alias("n")).join(F.broadcast(total)).select("token", "n", (-F.log2((F.col("n") + add) / F.col("records"))).alias("s"))


def token_bits(df: DataFrame, surprisal: DataFrame, row: str = "row", tokens: str = "name_tokens") -> DataFrame:
    """df with tf_tokens and, parallel to it, tf_bits; null where a name has no full token."""
    long = df.select(row, F.posexplode(F.array_distinct(full_tokens(F.col(tokens)))).alias("pos", "token")).join(surprisal.select("token", "s"), "token")
    s = long.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("pos", "token", "s"))).alias("x"))
    s = s.select(row, F.transform("x", lambda p: p["token"]).alias("tf_tokens"), F.transform("x", lambda p: p["s"]).alias("tf_bits"))
    return df.join(s, row, "left")


def vocabulary_shape(surprisal: DataFrame) -> DataFrame:
    return surprisal.agg(F.count("*").alias("tokens"), F.count_if(F.col("n") == 1).alias("singletons"), F.max("s").alias("max_bits"), F.percentile("s", F.lit(0.5)).alias("median_bits"), F.min("s").alias("min_bits"))


def literal(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")
