"""Levels of all candidate pairs, block by block: counted, or listed, without a row in the engine for each pair compared.

The rows of both tables that meet in one group (blocking.meetings) come to one task as they are; there functions/tiles.py
compares all pairs of the group. A pair's levels are one small number, so pairs are counted, or dropped for a low weight, before
they become rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.tiles import FEW, TILE, Batch
from linkloom.operators.blocking import PASSES, meetings, named, sides
from linkloom.operators.comparisons import Comparison

#: Rows whose columns are numbered together, about.
ROWS = 1 << 13
#: Records of one table that meet those of the other in one group where all meet all, about.
WIDE = 1 << 14
#: Pairs that are listed at once, and ids in one list.
LISTED, PIECE = 1 << 20, 256
#: What a pruned pair's weight may lie above the bound, as that is summed in another order.
SLACK = 1e-6
#: Combinations of levels and carried values that are told apart by a flag each; more of them by sorting.
FLAGS = 1 << 22
#: From combinations of levels (as numbers, and each comparison's) and carried values (nan: none) to columns (nan: null).
Told = Callable[[np.ndarray, list[np.ndarray], list[np.ndarray]], list[np.ndarray]]


def tiled(comparisons: list[Comparison]) -> bool:
    return all(c.tile for c in comparisons)


def changes(table: pa.Table, by: list[str]) -> np.ndarray:
    """The rows at which a new group begins, and the end."""
    new = np.zeros(max(0, table.num_rows - 1), bool)
    for c in by:
        x = table[c].combine_chunks()
        new |= pc.not_equal(x.slice(1), x.slice(0, max(0, len(x) - 1))).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(new) + 1, [table.num_rows]])


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Rows come in order of groups; all but the last group, which may go on, are handed on once there are enough."""
    held, n = [], 0
    for got in batches:
        held.append(got)
        n += got.num_rows
        if n < ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = int(changes(table, by)[-2])
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).to_batches(), table.num_rows - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def blocks(table: pa.Table, by: list[str], batch: Batch) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Row numbers of both sides, as a column and a row, of each group with enough pairs; single pairs of all others together. And whether it is a group."""
    at = changes(table, by)
    side = table["side"].to_numpy()
    few, n = [], 0
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        mid = a + int(np.searchsorted(side[a:b], 1))
        if mid in (a, b):
            continue
        i, j = np.arange(a, mid), np.arange(mid, b)
        if len(i) * len(j) >= FEW:
            yield i[:, None], j[None], True
            continue
        few.append((np.repeat(i, len(j)), np.tile(j, len(i))))
        n += len(i) * len(j)
        if n >= TILE:
            yield (*(np.concatenate(x) for x in zip(*few, strict=True)), False)
            few, n = [], 0
    if few:
        yield (*(np.concatenate(x) for x in zip(*few, strict=True)), False)


def coded(batch: Batch, comparisons: list[Comparison], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """All levels of each pair as one number."""
    out = np.zeros(np.broadcast_shapes(i.shape, j.shape), np.int32)
    for c in comparisons:
        out *= len(c.levels) + 1
        out += c.tile(batch, i, j)
        out += 1
    return out


def decoded(code: np.ndarray, comparisons: list[Comparison]) -> list[np.ndarray]:
    out = []
    for c in comparisons[::-1]:
        code, level = np.divmod(code, len(c.levels) + 1)
        out.append(level.astype(np.int32) - 1)
    return out[::-1]


def unpacked(comparisons: list[Comparison]) -> list[Column]:
    """The levels of the column code, in the engine."""
    out, over = [], 1
    for c in comparisons[::-1]:
        n = len(c.levels) + 1
        out.append((F.expr(f"code div {over} % {n}").cast("int") - 1).alias(f"gamma_{c.name}"))
        over *= n
    return out[::-1]


def compact(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (below size), and each key's place among them."""
    if size > FLAGS:
        return np.unique(key, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[key] = True
    some = np.flatnonzero(seen)
    place = np.empty(size, np.int32)
    place[some] = np.arange(len(some), dtype=np.int32)
    return some, place[key]


def cells(comparisons: list[Comparison]) -> int:
    return int(np.prod([len(c.levels) + 1 for c in comparisons]))


def earlier(batch: Batch, keys: list[tuple[str, str]], before: list[tuple[str, ...]], sets: set[str], i: np.ndarray, j: np.ndarray, member: np.ndarray | None = None) -> np.ndarray | None:
    """Pairs that an earlier pass reaches, or a smaller member of a set that is the key (or, of each pair, member). None: there are none."""
    out = None
    for k, own in keys:
        got = batch.below(k, own, i, j) if member is None else batch.below_member(k, member, i, j)
        out = got if out is None else out | got
    for x in before:
        got = None
        for k in x:
            here = batch.overlap(k, i, j) if k in sets else batch.equal(k, i, j)
            got = here if got is None else got & here
        out = got if out is None else out | got
    return out


def ids_of(batch: Batch, i: np.ndarray, j: np.ndarray, at: np.ndarray | None = None) -> tuple[pa.Array, pa.Array]:
    """The ids of the pairs of rows i and j, of all or of those at these places."""
    ids = batch.once("ids", lambda: batch.column("unique_id"))
    plain = batch.once("plain ids", lambda: ids.to_numpy() if pa.types.is_integer(ids.type) and not ids.null_count else None)
    take = (lambda x: ids.take(pa.array(x))) if plain is None else (lambda x: pa.array(plain[x]))
    if at is None and i.ndim == 2 and plain is not None:
        return pa.array(np.repeat(plain[i.ravel()], j.size)), pa.array(np.tile(plain[j.ravel()], i.size))
    return take(left_of(i, j, at)), take((np.tile(j.ravel(), i.size) if at is None else j.ravel()[at % j.size]) if i.ndim == 2 else j if at is None else j[at])


def left_of(i: np.ndarray, j: np.ndarray, at: np.ndarray | None) -> np.ndarray:
    if i.ndim == 2:
        return np.repeat(i.ravel(), j.size) if at is None else i.ravel()[at // j.size]
    return i if at is None else i[at]


def doubles(x: np.ndarray) -> pa.Array:
    """Null where there is no number."""
    gone = np.isnan(x)
    return pa.array(x, mask=gone if gone.any() else None)


Kept = Callable[[Batch, np.ndarray, np.ndarray], np.ndarray]


def paired(comparisons: list[Comparison], by: list[str], rule: Callable[..., np.ndarray | None], lists: Callable, counts: Callable | None = None) -> Callable:
    """The task's work: each tile of pairs that rule does not leave out goes to lists, as batch, i, j and code (flat)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, by):
            batch = Batch(table)
            for i, j, whole in blocks(table, by, batch):
                if not whole:
                    gone = rule(batch, i, j)
                    if gone is not None:
                        i, j = i[~gone], j[~gone]
                    if len(i):
                        yield from lists(batch, i, j, coded(batch, comparisons, i, j), None)
                    continue
                for c in comparisons:
                    if c.names:
                        batch.begin(i.ravel(), j.ravel(), *c.names)
                step = max(1, TILE // j.size)
                for a in range(0, len(i), step):
                    own = i[a : a + step]
                    yield from lists(batch, own, j, coded(batch, comparisons, own, j), rule(batch, own, j))
        if counts:
            yield from counts()

    return run


def levels(records: DataFrame, comparisons: list[Comparison], carry: tuple[str, ...] = (), passes: tuple = PASSES, bits: np.ndarray | None = None, least: float | None = None, lift: str | None = None, count: bool = False, told: tuple[tuple[str, ...], Told] | None = None) -> DataFrame:
    """Of all candidate pairs id_l, id_r, gamma_<comparison> and the columns of carry of the left record (doubles), as <name>_l.

    bits, least, lift: a pair is left out if bits of its levels and the left record's column lift come to less than least. count: how many
    pairs (n) have the same levels and carried values instead. told: names of columns instead of the carried ones, and what makes
    them, for each combination of levels and carried values once a tile.
    """
    kinds = dict(records.dtypes)
    out = None
    gammas, size = [f"gamma_{c.name}" for c in comparisons], cells(comparisons)
    for p, keys in enumerate(passes):
        keys, before = named(keys), [named(x) for x in passes[:p]]
        sets = {k for k in kinds if kinds[k].startswith("array")}
        columns = sorted({x for c in comparisons for x in c.inputs} | set(carry) | ({lift} if lift else set()) | {k for x in before for k in x} | {k for k in keys if k in sets})
        met, by = meetings(records, keys, columns)
        own = [(k, f"key_{n}") for n, k in enumerate(keys) if k in sets]
        rule = lambda batch, i, j, own=own, before=before, sets=sets: earlier(batch, own, before, sets, i, j)
        carried = [*told[0]] if told else [f"{c}_l" for c in carry]

        def listed(batch: Batch, i: np.ndarray, j: np.ndarray, code: np.ndarray, gone: np.ndarray | None) -> Iterator[pa.RecordBatch]:
            keep = None if gone is None else ~gone
            if least is not None:
                up = batch.once("lift", lambda: batch.column(lift).fill_null(0.0).to_numpy(zero_copy_only=False)) if lift else None
                high = bits[code] + (up[i] if lift else 0.0) >= least - SLACK
                keep = high if keep is None else keep & high
            at = None if keep is None else np.flatnonzero(keep)
            if at is not None and not len(at):
                return
            if told:
                values, number = batch.once("carried", lambda: distinct([batch.column(c) for c in carry], batch.table.num_rows))
                some, place = np.unique(number[i.ravel()], return_inverse=True)
                key = (place.astype(np.int64).reshape(i.shape) * size + code).ravel()
                key, back = compact(key if at is None else key[at], len(some) * size)
                which, cell = np.divmod(key, size)
                with_ = np.array([values[k] for k in some], np.float64).reshape(len(some), len(carry))[which].T
                extra = [doubles(x).take(pa.array(back)) for x in told[1](cell, decoded(cell, comparisons), list(with_))]
            else:
                left = pa.array(left_of(i, j, at)) if carry else None
                extra = [batch.column(c).take(left) for c in carry]
            code = code.ravel() if at is None else code.ravel()[at]
            yield pa.RecordBatch.from_arrays([*ids_of(batch, i, j, at), pa.array(code), *extra], names=["id_l", "id_r", "code", *carried])

        def counting() -> tuple[Callable, Callable]:
            held: dict[tuple, np.ndarray] = {}

            def add(batch: Batch, i: np.ndarray, j: np.ndarray, code: np.ndarray, gone: np.ndarray | None) -> Iterator[pa.RecordBatch]:
                values, number = batch.once("carried", lambda: distinct([batch.column(c) for c in carry], batch.table.num_rows))
                if gone is not None:
                    code[gone] = size
                own = number[i.ravel()]
                for k in np.unique(own):
                    into = held.setdefault(values[k], np.zeros(size, np.int64))
                    into += np.bincount(code[own == k].ravel(), minlength=size + 1)[:size]
                return iter(())

            def end() -> Iterator[pa.RecordBatch]:
                for value, n in held.items():
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, decoded(at, comparisons)), *[pa.array([v] * len(at), pa.float64()) for v in value], pa.array(n[at])], names=[*gammas, *carried, "n"])

            return add, end

        by_task = [c for c in comparisons]

        def run(batches: Iterator[pa.RecordBatch], by=by, rule=rule, listed=listed, counting=counting) -> Iterator[pa.RecordBatch]:
            work = paired(by_task, by, rule, *(counting() if count else (listed,)))
            yield from work(batches)

        shape = [*[f"{g} int" for g in gammas], *[f"{c} double" for c in carried], "n long"] if count else [*[f"id_{s} {kinds['unique_id']}" for s in "lr"], "code int", *[f"{c} double" for c in carried]]
        got = met.mapInArrow(run, ", ".join(shape))
        got = got if count else got.select("id_l", "id_r", *unpacked(comparisons), *carried)
        out = got if out is None else out.union(got)
    if count:
        out = out.groupBy(*[c for c in out.columns if c != "n"]).agg(F.sum("n").alias("n"))
    return out


def names(records: DataFrame, c: Comparison, keys: str | tuple[str, ...]) -> DataFrame:
    """Of the pairs of one pass: id_l, id_r, name_sim, shared_bits and gamma_<comparison>, as comparisons.gammas() has them, for a comparison of names."""
    kinds, keys = dict(records.dtypes), named(keys)
    sets = {k for k in keys if kinds[k].startswith("array")}
    own = [(k, f"key_{n}") for n, k in enumerate(keys) if k in sets]
    met, by = meetings(records, keys, sorted({*c.inputs, *sets}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, by):
            batch = Batch(table)
            for i, j, whole in blocks(table, by, batch):
                for left, values in ((x[:, None], v) for x, *v in batch.name_values(i.ravel(), j.ravel(), *c.names)) if whole else ((i, batch.name_values_of(i, j, *c.names)),):
                    gone = earlier(batch, own, [], sets, left, j)
                    at = None if gone is None else np.flatnonzero(~gone)
                    sim, shared, gamma = (x.ravel() if at is None else x.ravel()[at] for x in values)
                    yield pa.RecordBatch.from_arrays([*ids_of(batch, left, j, at), doubles(sim), pa.array(shared), pa.array(gamma)], names=["id_l", "id_r", "name_sim", "shared_bits", "gamma"])

    got = met.mapInArrow(run, f"id_l {kinds['unique_id']}, id_r {kinds['unique_id']}, name_sim double, shared_bits double, gamma byte")
    return got.select("id_l", "id_r", "name_sim", "shared_bits", F.col("gamma").cast("int").alias(f"gamma_{c.name}"))


def lists(records: DataFrame, passes: tuple[str, ...] = PASSES) -> DataFrame:
    """All candidate pairs, each once, as lists: id_l, ids_r (some ids of the second table) and cell.

    Chunks of both tables meet whatever their keys, so all that is known of a pair is in one task: a pair's cell is in one
    partition, its rows one after another, and records are shuffled, pairs are not. Which pass and member has a pair is told by the rule of levels().
    """
    kinds = dict(records.dtypes)
    met, by = meetings(records.withColumn("all", F.lit(0)), ("all",), list(passes), WIDE)
    sets, size = {k for k in passes if kinds[k].startswith("array")}, (LISTED, PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = 0
        for table in whole_groups(batches, by):
            at = changes(table, by)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                batch = Batch(table.slice(a, b - a))
                for got in listed(batch, passes, sets, *size):
                    yield from (pa.RecordBatch.from_arrays([*x, pa.array(np.full(len(x[0]), cell))], names=["id_l", "ids_r", "cell"]) for x in got)
                    cell += 1

    return met.mapInArrow(run, f"id_l {kinds['unique_id']}, ids_r array<{kinds['unique_id']}>, cell long")


def listed(batch: Batch, passes: tuple[str, ...], sets: set[str], most: int, piece: int) -> Iterator[list[tuple[pa.Array, pa.Array]]]:
    """The pairs of one group, for some rows of the left after others (about most pairs): the lists of each pass, of piece ids at most."""
    ids, mid = batch.column("unique_id"), int(np.searchsorted(batch.table["side"].to_numpy(), 1))
    keyed, work = [], np.zeros(mid + 1, np.int64)
    for k in passes:
        code, row = batch.members(k, k in sets)
        left, size = row < mid, int(code.max(initial=0)) + 1
        order = np.argsort(code[~left], kind="stable")
        n = np.bincount(code[~left], minlength=size)
        keyed.append((code[left], row[left], row[~left][order], np.cumsum(n) - n, n))
        work[1:] += np.bincount(row[left], n[code[left]], minlength=mid)[:mid].astype(np.int64)
    a, upto = 0, np.cumsum(work)
    while a < mid:
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + most, "right")) - 1)
        out = []
        for p, (code, row, others, begin, n) in enumerate(keyed):
            own = slice(*np.searchsorted(row, [a, b]).tolist())
            c = code[own]
            many = n[c]
            i = np.repeat(row[own], many)
            if not len(i):
                continue
            j = others[np.arange(len(i)) + np.repeat(begin[c] - np.cumsum(many) + many, many)]
            k = passes[p]
            gone = earlier(batch, [(k, k)] if k in sets else [], [named(x) for x in passes[:p]], sets, i, j, np.repeat(c, many))
            if gone is not None:
                i, j = i[~gone], j[~gone]
            if not len(i):
                continue
            new = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
            place = np.arange(len(i)) - np.repeat(new, np.diff([*new, len(i)]))
            first = np.flatnonzero(place % piece == 0)
            out.append((ids.take(pa.array(i[first])), pa.ListArray.from_arrays(pa.array(np.append(first, len(i)).astype(np.int32)), ids.take(pa.array(j)))))
        if out:
            yield out
        a = b


def distinct(columns: list[pa.Array], rows: int) -> tuple[list[tuple], np.ndarray]:
    """The distinct rows of some columns, and each row's number among them."""
    known: dict[tuple, int] = {}
    number = np.array([known.setdefault(x, len(known)) for x in (zip(*[c.to_pylist() for c in columns], strict=True) if columns else [()] * rows)], np.int64)
    return list(known), number


def cross_counts(left: DataFrame, right: DataFrame, c: Comparison) -> DataFrame:
    """gamma, n: the pairs of all rows of left and right (c.inputs and w), each counted w times w, at each level."""
    both = left.withColumn("source_dataset", F.lit("d1")).unionByName(right.withColumn("source_dataset", F.lit("d2")))
    both = both.withColumn("unique_id", F.xxhash64(*c.inputs)).withColumn("all", F.lit(0))
    met, by = meetings(both, ("all",), [*c.inputs, "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(c.levels) + 1, np.int64)

        def add(batch: Batch, i: np.ndarray, j: np.ndarray, code: np.ndarray, gone: None) -> Iterator[pa.RecordBatch]:
            w = batch.once("w", lambda: batch.column("w").to_numpy().astype(np.int64))
            one = code.ndim == 1
            for k in range(len(total)):  # by products of whole numbers, as a float would be inexact for many records
                here = code == k
                total[k] += int((w[i] * w[j])[here].sum()) if one else int(w[i].ravel() @ (here @ w[j].ravel()))
            return iter(())

        for x in paired([c], by, lambda *_: None, add)(batches):
            yield x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(c.levels)).astype(np.int32)), pa.array(total)], names=["gamma", "n"])

    return met.mapInArrow(run, "gamma int, n long").groupBy("gamma").agg(F.sum("n").alias("n")).where("n > 0")


__all__ = ["cells", "cross_counts", "decoded", "levels", "lists", "names", "sides", "tiled"]
