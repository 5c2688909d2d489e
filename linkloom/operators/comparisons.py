"""Comparisons: ordered levels over two records, the first that holds wins.

A level is numbered from 0 in order; a comparison without evidence (its null level) is -1.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import similarity as sim
from linkloom.functions.tiles import Batch


def l(name: str) -> Column:  # noqa: E743
    return F.col(f"{name}_l")


def r(name: str) -> Column:
    return F.col(f"{name}_r")


def empty(name: str) -> Column:
    """No set on a side, or one without members."""
    return l(name).isNull() | r(name).isNull() | (F.size(l(name)) == 0) | (F.size(r(name)) == 0)


def overlap(name: str) -> Column:
    return F.arrays_overlap(l(name), r(name))


@dataclass(frozen=True)
class Level:
    label: str
    #: Builds the predicate; none for the level of all that is left.
    when: Callable[[], Column] | None = None
    #: The column whose value's share adjusts the level.
    tf: str | None = None


@dataclass(frozen=True)
class Comparison:
    name: str
    missing: Callable[[], Column]
    levels: tuple[Level, ...]
    #: Columns of a record that it reads.
    inputs: tuple[str, ...]
    #: The same levels of many pairs at once, from rows of a batch.
    tile: Callable[[Batch, np.ndarray, np.ndarray], np.ndarray] | None = None
    #: What a block needs before its tiles: cuts and levels of the name.
    names: tuple | None = None

    def gamma(self) -> Column:
        out = F.when(self.missing(), F.lit(-1))
        for i, level in enumerate(self.levels):
            out = out.when(level.when(), F.lit(i)) if level.when else out.otherwise(F.lit(i))
        return out

    def labels(self) -> list[str]:
        return [x.label for x in self.levels]


def name(bins: tuple[float, float] = (20, 12)) -> Comparison:
    """Similarity split by the surprisal of the shared tokens. Reads the columns name_sim and shared_bits of staged()."""
    hi, lo = bins
    at = lambda s, b=None: lambda: (F.col("name_sim") >= s) & (F.col("shared_bits") >= b) if b is not None else F.col("name_sim") >= s
    levels = [Level(f"{k}_bits{hi}", at(s, hi)) if b == hi else Level(f"{k}_bits{lo}", at(s, lo)) if b == lo else Level(k, at(s)) for k, s in (("agree", 0.94), ("strong", 0.85)) for b in (hi, lo, None)]
    levels += [Level(f"weak_bits{lo}", at(0.75, lo)), Level("weak", at(0.75)), Level("disagree")]
    cuts = (0.94, 0.85, 0.75)

    def level(place, bits):
        """By place among the cuts: three levels by bits, three, two, and one for all that is left."""
        by = np.where(np.asarray(bits) >= hi, 0, np.where(np.asarray(bits) >= lo, 1, 2))
        return np.select([place == 0, place == 1, place == 2], [by, 3 + by, 6 + (by == 2)], 8).astype(np.int8)

    return Comparison("name", lambda: empty("name_tokens"), tuple(levels), ("name_tokens", "tf_tokens", "tf_bits"), lambda t, i, j: t.name_levels(i, j, cuts, level), (cuts, level))


def age(offset: int = 0) -> Comparison:
    gap = lambda: F.abs(r("age") - l("age") - offset)

    def tile(t: Batch, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        x = t.once("age", lambda: t.column("age").cast("int32").fill_null(0).to_numpy(zero_copy_only=False))
        far = np.abs(x[j] - x[i] - offset)
        return t.apart((far > 0).view(np.int8) + (far > 2).view(np.int8) + (far > 5).view(np.int8), "age", i, j)

    return Comparison("age", lambda: l("age").isNull() | r("age").isNull(), (Level("0", lambda: gap() == 0), Level("1-2", lambda: gap() <= 2), Level("3-5", lambda: gap() <= 5), Level(">5")), ("age",), tile)


def agree(name: str) -> Callable:
    return lambda t, i, j: t.apart((~t.equal(name, i, j)).view(np.int8), name, i, j)


def shared(name: str) -> Callable:
    return lambda t, i, j: t.apart((~t.overlap(name, i, j)).view(np.int8), name, i, j)


def shared_or_near(name: str) -> Callable:
    def tile(t: Batch, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = 2 * (~t.overlap(name, i, j)).view(np.int8)
        near = t.any_near(name, i, j)
        if near is not None:
            out[near & (out == 2)] = 1
        return t.apart(out, name, i, j)

    return tile


SEX = Comparison("sex", lambda: l("sex").isNull() | r("sex").isNull(), (Level("agree", lambda: l("sex") == r("sex")), Level("disagree")), ("sex",), agree("sex"))


def geo(depth: int = 4, tf: tuple[str, ...] = ("adm3", "adm2")) -> Comparison:
    """The finest level of place that agrees; without evidence only where no level can be compared."""
    flat = [f"adm{k}" for k in range(1, min(depth, 3) + 1)]

    def missing() -> Column:
        out = empty("adm4_tokens") if depth >= 4 else F.lit(True)
        for c in flat:
            out = out & (l(c).isNull() | r(c).isNull())
        return out

    levels = [Level("adm4", lambda: overlap("adm4_tokens"))] if depth >= 4 else []
    levels += [Level(c, lambda c=c: l(c) == r(c), c if c in tf else None) for c in reversed(flat)]

    def tile(t: Batch, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        last = len(levels)
        out = np.full(np.broadcast_shapes(i.shape, j.shape), last, np.int8)
        for c in flat:  # finer levels last: the least level that holds
            at = last - int(c[-1])
            np.minimum(out, last - (last - at) * t.equal(c, i, j).view(np.int8), out=out)
        if depth >= 4:
            np.minimum(out, last * (~t.overlap("adm4_tokens", i, j)).view(np.int8), out=out)
        gone = None
        for c in (*flat, *(["adm4_tokens"] if depth >= 4 else [])):
            none = t.null(c)
            if not none[i].any() and not none[j].any():
                return out
            gone = none[i] | none[j] if gone is None else gone & (none[i] | none[j])
        out[gone] = -1
        return out

    return Comparison("geo", missing, (*levels, Level("different")), (*flat, *(["adm4_tokens"] if depth >= 4 else [])), tile)


JOB = Comparison("job", lambda: empty("job_cats"), (Level("agree", lambda: overlap("job_cats")), Level("disagree")), ("job_cats",), shared("job_cats"))
PHONE = Comparison("phone", lambda: empty("phones"), (Level("agree", lambda: overlap("phones")), Level("near", lambda: sim.any_one_edit(l("phones"), r("phones"))), Level("disagree")), ("phones",), shared_or_near("phones"))


def default() -> list[Comparison]:
    return [name(), age(), SEX, geo(), JOB, PHONE]


def staged(pairs: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    """pairs with the costly values that levels share, each computed once, rounded so that engines agree at a cut."""
    if any(c.name == "name" for c in comparisons):
        pairs = pairs.withColumn("name_sim", F.round(sim.name_sim(l("name_tokens"), r("name_tokens")), 9)).withColumn("shared_bits", F.round(sim.shared_bits(l("tf_tokens"), l("tf_bits"), r("tf_tokens")), 9))
    return pairs


def gammas(pairs: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    """pairs (with record columns _l and _r) with a column gamma_<name> for each comparison."""
    return staged(pairs, comparisons).withColumns({f"gamma_{c.name}": c.gamma() for c in comparisons})
