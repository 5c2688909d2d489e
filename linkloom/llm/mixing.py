"""Mixing sources to target weights: hierarchical budgets over domain, language and source.

Targets. A token budget goes down the tree domain -> language -> source. At each node the children share the node's
budget by their weights, none more than it can give: its tokens times max_epochs. What a child can't take goes to its
siblings, by their weights; what a node as a whole can't take was never given to it, for its own limit is the sum of its
children's, so a shortage is met by siblings before ancestors share it out.

Selection. A leaf with target t and s tokens gives whole epochs while they fit, then the longest prefix of one more epoch
that stays within t. The order of an epoch is that of a hash of seed, epoch and doc_id (then of the text's hash; rows
alike in all of these count as one step). Prefix sums are found in three levels: sums over ranges of the hash that hold
about RANGE rows each; of the one range where a leaf's prefix ends, sums over its PARTS parts; and row by row in the one
part where it ends. Sums are aggregates with partial sums, so no task orders more of a leaf than such a part.

Weights: a nested mapping name -> weight or (weight, children); names without an entry take the weight of "*", or 1.
Tokens are words parted by white space. A null language or source is a leaf of its own, named "". A leaf without tokens is
kept once. A null text has no tokens; a null id hashes as null. Repeated rows are kept or left together. An empty table
gives no rows. It adds columns whose names begin with mix_; columns of docs with such names are left out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import Workspace

KEYS = ["mix_domain", "mix_lang", "mix_source"]
RANGE, PARTS = 20_000, 128


def domain_of(source: Column) -> Column:
    """The four domains of numbered sources: by the number's rest; d0 where there is none."""
    return F.concat(F.lit("d"), F.coalesce(F.regexp_extract(source, r"(\d+)$", 1).try_cast("int") % 4, F.lit(0)).cast("string"))


def weight(tree: Mapping, path: list[str]) -> Column:
    """The weight of the node that the columns of path name, among its siblings."""

    def at(level: Mapping, i: int) -> Column:
        own = lambda x: float(x[0] if isinstance(x, tuple) else x)
        rest = level.get("*", 1.0)
        if i == len(path) - 1:
            out = F.lit(own(rest))
            for name, x in level.items():
                if name != "*":
                    out = F.when(F.col(path[i]) == name, F.lit(own(x))).otherwise(out)
            return out
        out = at(rest[1] if isinstance(rest, tuple) else {}, i + 1)
        for name, x in level.items():
            if name != "*":
                out = F.when(F.col(path[i]) == name, at(x[1] if isinstance(x, tuple) else {}, i + 1)).otherwise(out)
        return out

    return at(tree, 0)


def share_out(nodes: DataFrame, parent: list[str], name: str, budget: str) -> DataFrame:
    """Adds mix_target: the parent's budget shared by mix_weight with limits mix_limit.

    Children reach their limits in the order of limit / weight; the k-th has reached it if the budget covers the limits
    of those before and its ratio times the weights from it on.
    """
    ratio = F.when(F.col("mix_weight") > 0, F.col("mix_limit") / F.col("mix_weight"))
    w = Window.partitionBy(*parent)
    order = w.orderBy(F.col("mix_ratio").asc_nulls_last(), name)
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.withColumn("mix_ratio", ratio).withColumn("mix_before", F.sum("mix_limit").over(up_to) - F.col("mix_limit")).withColumn("mix_left", F.sum("mix_weight").over(w) - F.sum("mix_weight").over(up_to) + F.col("mix_weight"))
    full = (F.col("mix_weight") > 0) & (F.col("mix_before") + F.col("mix_ratio") * F.col("mix_left") <= F.col(budget) * (1 + 1e-12))
    nodes = nodes.withColumn("mix_full", full)
    spent = F.coalesce(F.sum(F.when(F.col("mix_full"), F.col("mix_limit"))).over(w), F.lit(0.0))
    open_ = F.sum(F.when(~F.col("mix_full"), F.col("mix_weight"))).over(w)
    level = F.when(open_ > 0, F.greatest(F.col(budget) - spent, F.lit(0.0)) / open_)
    return nodes.withColumn("mix_target", F.when(F.col("mix_full"), F.col("mix_limit")).otherwise(F.coalesce(level * F.col("mix_weight"), F.lit(0.0)))).drop("mix_ratio", "mix_before", "mix_left", "mix_full")


def targets(leaves: DataFrame, tree: Mapping, budget: float | None, max_epochs: int) -> DataFrame:
    """leaves: KEYS, mix_tokens, mix_rows. Adds mix_target, in tokens. No budget: all tokens once."""
    n = leaves.withColumn("mix_limit", F.col("mix_tokens").cast("double") * max_epochs)
    total = leaves.agg(F.coalesce(F.sum("mix_tokens"), F.lit(0)).cast("double")).head()[0] if budget is None else float(budget)
    got, above = None, None
    for i, key in enumerate(KEYS):
        level = n.groupBy(*KEYS[: i + 1]).agg(F.sum("mix_limit").alias("mix_limit"), F.sum("mix_tokens").alias("mix_tokens"), F.sum("mix_rows").alias("mix_rows"))
        level = level.withColumn("mix_weight", weight(tree, KEYS[: i + 1]))
        level = level.withColumn("mix_budget", F.lit(total)) if above is None else level.join(above, KEYS[:i])
        got = share_out(level, KEYS[:i] or [F.lit(0)], key, "mix_budget")
        above = got.select(*KEYS[: i + 1], F.col("mix_target").alias("mix_budget"))
    return got.select(*KEYS, "mix_tokens", "mix_rows", "mix_target")


def mix_sources(docs: DataFrame, tree: Mapping, budget: float | None = None, seed: int = 0, max_epochs: int = 4, domain: Column | None = None) -> DataFrame:
    """The rows of docs (doc_id, text, lang, source and any others), once for each epoch that takes them.

    Adds mix_domain, mix_lang, mix_source, mix_tokens and mix_epoch (from 0).
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    with Workspace(docs.sparkSession, "mixing") as ws:
        lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
        keyed = docs.withColumns({"mix_domain": domain if domain is not None else domain_of(source), "mix_lang": lang, "mix_source": source, "mix_tokens": F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long")})
        leaves = keyed.groupBy(*KEYS).agg(F.sum("mix_tokens").alias("mix_tokens"), F.count("*").alias("mix_rows"))
        leaves = ws.save(leaves, "leaves")
        plan = targets(leaves, tree, budget, max_epochs)
        epochs = F.when(F.col("mix_tokens") > 0, F.floor(F.col("mix_target") * (1 + 1e-12) / F.col("mix_tokens"))).otherwise(1).cast("int")
        plan = plan.withColumn("mix_whole", F.least(epochs, F.lit(max_epochs)))
        plan = plan.withColumn("mix_rest", F.when(F.col("mix_tokens") > 0, F.floor(F.col("mix_target") - F.col("mix_whole") * F.col("mix_tokens") + 1e-6)).otherwise(0).cast("long"))
        plan = plan.withColumn("mix_ranges", F.ceil(F.col("mix_rows") / RANGE).cast("long"))
        plan = ws.save(plan.select(*KEYS, "mix_whole", "mix_rest", "mix_ranges"), "plan")

        def placed(rows: DataFrame) -> DataFrame:
            """Where rows stand in their leaf's last, partial epoch."""
            h = F.xxhash64(F.lit(seed), "mix_whole", "doc_id")
            fine = F.floor(F.pmod(F.shiftrightunsigned(h, 33), F.lit(1 << 31)) * F.col("mix_ranges") * PARTS / (1 << 31))
            return rows.withColumns({"mix_hash": h, "mix_text": F.xxhash64("text"), "mix_part": fine.cast("long")})

        def ending(rows: DataFrame, place: Column, room: str) -> DataFrame:
            """KEYS, at, room: the place where the prefix of each leaf ends, and what is left of its room there."""
            order = Window.partitionBy(*KEYS).orderBy("at")
            sums = rows.groupBy(*KEYS, room, place.alias("at")).agg(F.sum("mix_tokens").alias("n")).withColumn("upto", F.sum("n").over(order))
            ends = sums.where(f"upto - n <= {room} and upto > {room}").select(*KEYS, "at", (F.col(room) - F.col("upto") + F.col("n")).alias("room"))
            return ends.groupBy(*KEYS).agg(F.min_by(F.struct("at", "room"), "at").alias("x")).select(*KEYS, "x.*")

        slim = keyed.select("doc_id", "text", *KEYS, "mix_tokens").join(plan.where("mix_rest > 0"), KEYS)
        slim = ws.save(placed(slim).select(*KEYS, "mix_rest", "mix_part", "mix_hash", "mix_text", "mix_tokens", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("mix_id")), "places")
        ranges = ending(slim, F.floor(F.col("mix_part") / PARTS), "mix_rest")
        own = slim.drop("mix_rest").withColumn("at", F.floor(F.col("mix_part") / PARTS)).join(ranges.withColumnRenamed("room", "mix_room"), [*KEYS, "at"])
        ends = ws.save(ending(own.drop("at"), F.col("mix_part"), "mix_room").withColumnRenamed("at", "mix_part"), "ends")
        one = slim.join(ends, [*KEYS, "mix_part"]).withColumn("upto", F.sum("mix_tokens").over(Window.partitionBy(*KEYS).orderBy("mix_hash", "mix_id", "mix_text")))
        last = one.where("upto <= room").groupBy(*KEYS).agg(F.max(F.struct("mix_hash", "mix_id", "mix_text")).alias("mix_last"))
        cut = ws.save(plan.join(ends.select(*KEYS, F.col("mix_part").alias("mix_end")), KEYS, "left").join(last, KEYS, "left"), "cuts")
        rows = placed(keyed.join(cut, KEYS))
        here = F.struct("mix_hash", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("mix_id"), "mix_text")
        part = (F.col("mix_rest") > 0) & F.coalesce((F.col("mix_part") < F.col("mix_end")) | ((F.col("mix_part") == F.col("mix_end")) & (here <= F.col("mix_last"))), F.col("mix_end").isNull(), F.lit(False))
        times = F.col("mix_whole") + F.coalesce(part, F.lit(False)).cast("int")
        rows = rows.withColumn("mix_epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
        ws.spare(cut)  # the result reads it
        return rows.select(*docs.columns, *KEYS, "mix_tokens", "mix_epoch")
