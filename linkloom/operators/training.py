"""Estimation: level shares over the cross product (u), and expectation-maximisation in blocks (m)."""

from __future__ import annotations

import json
import logging
import math
import os
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.blocking import block, met, sides
from linkloom.operators.comparisons import Comparison, gammas
from linkloom.operators.model import LinkModel, signature
from linkloom.operators.tiling import cross_counts


#: Set up by sources.tables.log_to().
LOG = logging.getLogger("linkloom.fit")
#: Columns that stand for others in a block.
STANDS_FOR = {"name_key": "name_tokens"}


def level_counts(records: DataFrame, c: Comparison) -> DataFrame:
    """gamma, n: pairs of the whole cross product at each level.

    A level depends on the comparison's own columns only, so distinct values of these meet, weighted with the number of
    records that hold them: exact, and far fewer than all pairs where values repeat. The smaller side is broadcast if
    its count shows it small, else the join is split by Spark.
    """
    left, right = (d.groupBy(*c.inputs).agg(F.count("*").alias("w")) for d in sides(records))
    if c.tile:
        return cross_counts(left, right, c)
    left = left.select(*[F.col(x).alias(f"{x}_l") for x in c.inputs], F.col("w").alias("w_l"))
    right = right.select(*[F.col(x).alias(f"{x}_r") for x in c.inputs], F.col("w").alias("w_r"))
    if right.limit(100_001).count() <= 100_000:
        right = F.broadcast(right)
    left = left.repartition(left.sparkSession.sparkContext.defaultParallelism)  # few bytes, but much work each
    pairs = left.crossJoin(right)  # of distinct values; the operator's meaning is all pairs
    return gammas(pairs, [c]).groupBy(F.col(f"gamma_{c.name}").alias("gamma")).agg(F.sum(F.col("w_l") * F.col("w_r")).alias("n"))


def sampled(records: DataFrame, max_pairs: float, seed: int) -> DataFrame:
    """Records of both tables, each thinned alike, so that about max_pairs pairs are left."""
    n = {r[0]: r[1] for r in records.groupBy("source_dataset").count().collect()}
    share = min(1.0, (max_pairs / max(1, n.get("d1", 0) * n.get("d2", 0))) ** 0.5)
    return records if share == 1 else records.where(F.pmod(F.xxhash64("unique_id", "source_dataset", F.lit(seed)), F.lit(1_000_003)) < share * 1_000_003)


def estimate_u(records: DataFrame, comparisons: list[Comparison], max_pairs: float = float("inf"), seed: int = 0, cache: str | None = None) -> dict[str, list[float]]:
    """Level shares among pairs with evidence. cache: a JSON file of earlier results, by the comparison's signature."""
    known = json.load(open(cache)) if cache and os.path.exists(cache) else {}  # noqa: SIM115
    some = sampled(records, max_pairs, seed) if max_pairs != float("inf") else records
    out = {}
    for c in comparisons:
        key = signature(c, max_pairs=str(max_pairs), seed=seed)
        if key not in known:
            n = {r[0]: r[1] for r in level_counts(some, c).collect()}
            total = sum(v for k, v in n.items() if k >= 0)
            known[key] = [n.get(i, 0) / total if total else 0.0 for i in range(len(c.levels))]
        out[c.name] = known[key]
    if cache:
        with open(cache, "w") as f:
            json.dump(known, f)
    return out


def floored(u: dict[str, list[float]], n_pairs: float) -> dict[str, list[float]]:
    return {k: [max(x or 0.0, 1 / n_pairs) for x in v] for k, v in u.items()}


def patterns(pairs: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    """Pairs (with record columns) counted by their levels: a few thousand rows however many pairs."""
    return gammas(pairs, comparisons).groupBy(*[f"gamma_{c.name}" for c in comparisons]).agg(F.count("*").alias("n"))


@dataclass
class Session:
    prior: float
    m: dict[str, list[float]]
    iterations: int


def em(counts: dict[str, np.ndarray], n: np.ndarray, u: dict[str, list[float]], prior: float, start: dict[str, list[float]] | None = None, fixed: tuple[str, ...] = (), fix_prior: bool = False, tolerance: float = 1e-4, most: int = 200) -> Session:
    """EM over level patterns. counts: each comparison's level per pattern (-1: no evidence); n: pairs per pattern.

    u is fixed, and so are the m of the comparisons in fixed. Without a start, agreement levels begin high and fall off.
    Stops where no parameter moves by the tolerance; without pairs, all stays as it begins.
    """
    m = {c: np.array(start[c], float) if start and c in start else initial(len(u[c])) for c in counts}
    step = 0
    for step in range(1, most + 1 if n.sum() > 0 else 1):
        ratio = np.log(prior / (1 - prior)) * np.ones(len(n))
        for c, g in counts.items():
            with np.errstate(divide="ignore"):
                ratio += np.where(g >= 0, np.log(m[c])[g] - np.log(np.array(u[c]))[g], 0.0)
        p = 1 / (1 + np.exp(-np.clip(ratio, -700, 700)))
        weight, moved = n * p, 0.0
        for c, g in counts.items():
            if c in fixed:
                continue
            got = np.bincount(g[g >= 0], weight[g >= 0], len(u[c]))
            new = got / got.sum() if got.sum() > 0 else m[c]
            moved, m[c] = max(moved, float(np.abs(new - m[c]).max())), new
        if not fix_prior:
            new_prior = float(weight.sum() / n.sum())
            moved, prior = max(moved, abs(new_prior - prior)), min(max(new_prior, 1e-12), 1 - 1e-12)
        LOG.info("iteration %d: largest change %.3g, share of matches %.4g", step, moved, prior)
        if moved < tolerance:
            break
    return Session(prior, {c: x.tolist() for c, x in m.items()}, step)


def initial(k: int) -> np.ndarray:
    x = 0.25 ** np.arange(k)
    return x / x.sum()


def collected(df: DataFrame, comparisons: list[Comparison]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    rows = df.collect()
    return {c.name: np.array([r[f"gamma_{c.name}"] for r in rows], int) for c in comparisons}, np.array([r["n"] for r in rows], float)


def posterior(counts: dict[str, np.ndarray], session: Session, u: dict[str, list[float]]) -> np.ndarray:
    """The chance of a match for each pattern."""
    x = np.full(len(next(iter(counts.values()))), np.log(session.prior / (1 - session.prior)))
    for c, g in counts.items():
        with np.errstate(divide="ignore"):
            x += np.where(g >= 0, (np.log(np.array(session.m[c])) - np.log(np.array(u[c])))[g], 0.0)
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def corrected(u: dict[str, list[float]], m: dict[str, list[float]], prior: float, floor: float) -> dict[str, list[float]]:
    """u freed of the matches among the pairs that it was counted on."""
    return {c: [max((x - prior * y) / (1 - prior), floor) for x, y in zip(u[c], m[c], strict=True)] for c in u}


def moved_levels(u: dict[str, list[float]], new: dict[str, list[float]], comparisons: list[Comparison], bits: float = 0.05) -> list[tuple[str, str, float]]:
    """variable, level and change in bits of the levels that the correction moves by more than that."""
    out = [(c.name, x.label, math.log2(b / a)) for c in comparisons for x, a, b in zip(c.levels, u[c.name], new[c.name], strict=True)]
    return [x for x in out if abs(x[2]) > bits]


def estimable(comparisons: list[Comparison], *keys: str) -> list[Comparison]:
    """Comparisons that read none of a block's columns; within a block, the others tell nothing."""
    used = {STANDS_FOR.get(k, k) for k in keys}
    return [c for c in comparisons if not used & set(c.inputs)]


def pairs_in_block(records: DataFrame, *keys: str) -> int:
    return block(records, *keys).count()


def train(records: DataFrame, comparisons: list[Comparison], n_matches: float, max_pairs: float = float("inf"), seed: int = 0, cache: str | None = None) -> tuple[LinkModel, dict]:
    """Two sessions: pairs with the same name key, match share free, estimate all but the name; pairs of the same area and
    age estimate the name, all else fixed, with the match share held at what the first fit implies. A session whose block has no pairs
    leaves its parameters as they begin; without records on a side there is nothing to fit, which is an error.
    """
    n = {r[0]: r[1] for r in records.groupBy("source_dataset").count().collect()}
    total = n.get("d1", 0) * n.get("d2", 0)
    if not total:
        raise ValueError(f"no pairs to learn from: {n}")
    prior = n_matches / total
    u = floored(estimate_u(records, comparisons, max_pairs, seed, cache), min(max_pairs, total))
    others = estimable(comparisons, "name_key")
    key = met(records, ("name_key",))
    area: Column = F.coalesce((F.col("adm3_l") == F.col("adm3_r")) & (F.col("age_l") == F.col("age_r")), F.lit(False))
    rows = gammas(key, others).withColumn("area", area).groupBy(*[f"gamma_{c.name}" for c in others], "area").agg(F.count("*").alias("n")).collect()
    counts = {c.name: np.array([r[f"gamma_{c.name}"] for r in rows], int) for c in others}
    pairs, inside = np.array([r["n"] for r in rows], float), np.array([r["area"] for r in rows])
    first = em(counts, pairs, u, 0.5)
    weight = pairs * posterior(counts, first, u)
    share = float(weight[inside].sum() / weight.sum()) if weight.sum() > 0 else 0.0
    counts2, pairs2 = collected(patterns(met(records, (("adm3", "age"),)), comparisons), comparisons)
    held = min(max(n_matches * share / max(1.0, pairs2.sum()), 1e-9), 1 - 1e-9)
    active = {c.name: counts2[c.name] for c in estimable(comparisons, "adm3", "age")}
    second = em(active, pairs2, u, held, start=first.m, fixed=tuple(c for c in active if c in first.m), fix_prior=True)
    if abs(second.prior / held - 1) > 1e-6:
        raise AssertionError(f"share of matches {second.prior}, held at {held}")
    m = first.m | {c: x for c, x in second.m.items() if c not in first.m}
    m = {c.name: m[c.name] for c in comparisons}
    u_new = corrected(u, m, prior, 1 / min(max_pairs, total))
    model = LinkModel(prior, m, u_new, comparisons)
    info = {"key_pairs": int(pairs.sum()), "key_prior": first.prior, "area_pairs": int(pairs2.sum()), "area_prior": held, "area_share": share, "iterations": [first.iterations, second.iterations], "moved": moved_levels(u, u_new, comparisons)}
    info["sanity"] = sanity(model, min(max_pairs, total), n_matches) | {"implied_key": pairs.sum() * first.prior, "implied_area": float(pairs2.sum() * held)}
    LOG.info("fit: %s", info)
    return model, info


def sanity(model: LinkModel, n_pairs: float, n_matches: float) -> dict:
    """Checks that need no reference linkage."""
    m = {(v, x): y or 0.0 for v, x, y, *_ in model.rows()}
    sparse = [(v, x) for v, x, _, u, *_ in model.rows() if round(u * n_pairs) < 20]
    return {"m_sex_agree": m.get(("sex", "agree")), "m_name_high": sum(y for (v, x), y in m.items() if v == "name" and x.startswith(("agree", "strong"))), "sparse_levels": sparse, "matches": n_matches}
