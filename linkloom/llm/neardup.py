"""Embedding near-duplicates: subspace pigeonhole join, exact.

Unit vectors with cosine >= t are at squared distance <= 2 - 2t. The vectors are rotated (principal axes of a bounded
sample; any rotation gives the same result) and the axes dealt to blocks of about BLOCK dimensions. A block's budget is
that squared distance times its share of the variance; the budgets sum to the whole, so two near vectors are within
budget in at least one block (pigeonhole). Each block is range-joined: vectors are cut into runs along the block's first
axis, runs into chunks of about CHUNK vectors, and two chunks meet if their runs are no farther apart than the budget
allows. Within a meeting, pairs within the block's budget are candidates, and candidates are verified on the whole vectors
in double precision. A pair counts in the first block where it is within budget, so in one meeting only.

A block's chunks are written to the shared folder once, its meetings read their two chunks from there, and the files go before
the next block (of few vectors, all blocks are met at once); so disk grows with the vectors, not with the meetings.

Exact copies are one vector with a multiplicity. A meeting hands on a count for each of its vectors, and of its links only
a spanning set (all links where they are few), so near copies by the thousand never become rows for all their pairs.
The number of meetings follows the spread of the data: on directions spread evenly over many dimensions, runs lie close
together and most chunks meet.

Null, empty or zero vectors, and those with null or non-finite components, link with nothing; vectors of different lengths
don't link. Rows of one vec_id are rows of their own with one component id; a null id takes no part and has no component.
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Workspace, components, release, remove, shuffle_parts
from linkloom.llm.textarrays import frugal
from linkloom.llm.tokenids import mapped, sink

BLOCK, CHUNK, TILE = 16, 4096, 2048
SAMPLE = 10_000
#: Up to so many vectors all blocks are met at once, which needs the disk of all and waits for none.
TOGETHER = 100_000
#: A meeting of two chunks within a block.
KEYS = ("run_1", "chunk_1", "run_2", "chunk_2")


def rotation(sample: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Axes as columns, the axes of each block, and each block's share of the budget."""
    d = sample.shape[1]
    value, axes = np.linalg.eigh(np.cov(sample.T).reshape(d, d) if len(sample) > 1 else np.eye(d))
    order = np.argsort(-value, kind="stable")
    m = max(1, -(-d // BLOCK))
    blocks = [order[i::m] for i in range(m)]
    share = np.array([np.maximum(value[b], 0).sum() for b in blocks]) + 1e-3
    return axes, blocks, share / share.sum()


def spanning(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as pairs of ids) that connect what the mask connects."""
    if mask.sum() <= 4 * sum(mask.shape):
        i, j = np.nonzero(mask)
        return left[i], right[j]
    rows, cols = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    m = mask[np.ix_(rows, cols)]
    far = np.iinfo(np.int64).max
    label = left[rows].copy()
    while True:
        col = np.where(m, label[:, None], far).min(0)
        new = np.where(m, col[None, :], far).min(1)
        if (new == label).all():
            break
        label = np.minimum(label, new)
    return np.concatenate([label, col]), np.concatenate([left[rows], right[cols]])


def join(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding)."""
    spark = vectors.sparkSession
    with Workspace(spark, "neardup") as ws:
        kept = F.col("embedding") if dict(vectors.dtypes)["embedding"] == "array<float>" else F.col("embedding").cast("array<double>")
        vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), kept.alias("v"))
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        norm = F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
        valid = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~bad & (norm > 0), F.lit(False))
        rows = ws.save(vectors.select("vec_id", F.when(valid, F.col("v")).alias("v")), "vectors")
        distinct = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("times"))
        distinct = ws.save(distinct.select(F.monotonically_increasing_id().alias("node"), "v", "least", "times"), "distinct", tidy=True)
        counts, links = [], []
        for d, n in sorted(map(tuple, distinct.groupBy(F.size("v").alias("d")).count().collect())):  # a row for each length
            folder = f"{ws.root}/chunks-{d}"
            for met in meetings(distinct.where(F.size("v") == d), d, n, threshold, folder):  # a block after another
                found = ws.save(met, "found", tidy=True)
                remove(spark, folder)
                counts.append(found.where("count is not null").select("a", "count"))
                links.append(found.where("count is null").select("a", "b"))
        if not counts:
            empty = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
            return ws.keep(empty)
        every, total = links[0], counts[0]
        for x, c in zip(links[1:], counts[1:], strict=True):
            every, total = every.union(x), total.union(c)
        total = total.groupBy("a").agg(F.sum("count").alias("n"))
        inner = components(ws, every)
        least = distinct.join(inner, "node").groupBy("component").agg(F.min("least").alias("component_id"))
        named = distinct.join(inner.join(least, "component"), "node", "left").join(total.withColumnRenamed("a", "node"), "node", "left")
        named = named.select("v", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
        out = rows.join(named, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        return ws.keep(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def meetings(distinct: DataFrame, d: int, n: int, threshold: float, folder: str) -> Iterator[DataFrame]:
    """Counts (a, count) and links (a, b) of vectors (node, v, times) of length d, for each block; n: their number.

    folder: for the files of a block's chunks, which the caller removes when it has written the block's rows.
    """
    spark = distinct.sparkSession
    kind = "<f4" if dict(distinct.dtypes)["v"] == "array<float>" else "<f8"
    some = np.array([r[0] for r in distinct.orderBy(F.xxhash64("node")).select("v").limit(SAMPLE).collect()], np.float64).reshape(-1, d)
    some /= np.linalg.norm(some, axis=1, keepdims=True)
    axes, blocks, share = rotation(some)
    whole = 2 - 2 * threshold + 1e-9
    budget = whole * share
    runs = max(1, -(-n // CHUNK))
    edges = [np.quantile(some @ axes[:, b[0]], np.arange(1, runs) / runs) for b in blocks]
    held = spark.sparkContext.broadcast((axes, blocks, budget, edges))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The run of each vector in each block."""
        axes, blocks, _, edges = held.value
        for batch in batches:
            x = unit(batch)
            for k, b in enumerate(blocks):
                run = np.searchsorted(edges[k], x @ axes[:, b[0]], "right")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), k)), pa.array(run)], names=["block", "run"])

    sizes = np.zeros((len(blocks), runs), np.int64)
    for r in distinct.select("v").mapInArrow(place, "block long, run long").groupBy("block", "run").count().collect():  # a row for each run
        sizes[r.block, r.run] = r["count"]
    chunks = spark.sparkContext.broadcast(-(-sizes // CHUNK))

    def reach(k: int, r: int, edges: list[np.ndarray], budget: np.ndarray) -> int:
        """The last run that is near enough to meet run r."""
        return max(r, int(np.searchsorted(edges[k], (edges[k][r] if r < runs - 1 else np.inf) + budget[k] ** 0.5 + 1e-6, "right")))

    def partners(k: int, r: int, i: int, edges: list[np.ndarray], budget: np.ndarray, many: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """The meetings of a chunk: the first chunk (run, number), the second, and which of the two it is itself."""
        low = r
        while low > 0 and reach(k, low - 1, edges, budget) >= r:
            low -= 1
        for q in range(low, reach(k, r, edges, budget) + 1):
            for j in range(many[k, q]):
                first, second = sorted([(r, i), (q, j)])
                yield (*first, *second, int((r, i) != first))

    def dealt(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vectors of each chunk of block k, packed; once, however many meetings the chunk has."""
        axes, blocks, _, edges = held.value
        many = chunks.value
        for batch in batches:
            raw = np.ascontiguousarray(vectors_of(batch), kind)
            node, times = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            run = np.searchsorted(edges[k], unit(batch) @ axes[:, blocks[k][0]], "right")
            for r in np.unique(run):
                own = np.flatnonzero(run == r)
                salt = (node[own] * 2654435761 >> 7) % many[k, r]
                for i in np.unique(salt):
                    at = own[salt == i]
                    yield pa.RecordBatch.from_arrays([pa.array([y], pa.int64()) for y in (k, r, i)] + [pa.array([y[at].tobytes()], pa.binary()) for y in (node, times, raw)], names=["block", "run", "chunk", "node", "times", "raw"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by chunk; a chunk is a file of its nodes, their multiplicities and the vectors."""

        def written(key: tuple, rows: list) -> pa.RecordBatch:
            stem = f"{'-'.join(map(str, key))}-{uuid.uuid4().hex}"
            with sink(f"{folder}/{stem}") as f:
                for part in gathered(rows, d, kind):
                    f.write(part.tobytes())
            return pa.RecordBatch.from_pydict({"block": [key[0]], "run": [key[1]], "chunk": [key[2]], "stem": [stem]})

        key, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is not None and row[:3] != key:
                    yield written(key, rows)
                    rows = []
                key = row[:3]
                rows.append(row[3:])
        if key is not None:
            yield written(key, rows)

    def pair(stems: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The meetings of each chunk that it is the first of."""
        _, _, budget, edges = held.value
        for batch in batches:
            for k, r, i in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                to = [(k, *x[:4]) for x in partners(k, r, i, edges, budget, chunks.value) if not x[4] and (k, *x[2:4]) in stems.value]
                yield pa.RecordBatch.from_arrays([pa.array(y, pa.int64()) for y in zip(*to, strict=True)], names=["block", *KEYS])

    def meet(stems: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row is a meeting; its two chunks are read from their files."""
        axes, blocks, budget, _ = held.value
        known: dict[tuple, tuple] = {}

        def read(key: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            if key not in known:
                data = mapped(f"{folder}/{stems.value[key]}", "u1")
                n = len(data) // (16 + d * np.dtype(kind).itemsize)
                known[key] = data[: 8 * n].view(np.int64), data[8 * n : 16 * n].view(np.int64), data[16 * n :].view(kind).reshape(n, d)
            return known[key]

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, two = (row[0], *row[1:3]), (row[0], *row[3:5])
                for gone in known.keys() - {one, two}:
                    del known[gone]
                for a, b, count, _ in within(read(one), read(two), one == two, axes, blocks, budget, row[0], threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b) if b is not None else pa.nulls(len(a), pa.int64()), pa.array(count) if count is not None else pa.nulls(len(a), pa.int64())], names=["a", "b", "count"])

    every_block = None
    for k in range(len(blocks)):
        packed = distinct.select("node", "v", "times").mapInArrow(frugal(partial(dealt, k)), "block long, run long, chunk long, node binary, times binary, raw binary")
        packed = packed.repartition(min(shuffle_parts(spark), int(chunks.value[k].sum())), "block", "run", "chunk").sortWithinPartitions("block", "run", "chunk")
        listed = packed.mapInArrow(frugal(write), "block long, run long, chunk long, stem string").collect()  # a row for each chunk
        del packed
        release(spark)
        stems = spark.sparkContext.broadcast({(r.block, r.run, r.chunk): r.stem for r in listed})
        every = spark.createDataFrame([tuple(r[:3]) for r in listed], "block long, run long, chunk long")
        met = every.mapInArrow(partial(pair, stems), "block long, run_1 long, chunk_1 long, run_2 long, chunk_2 long")
        met = met.repartition(min(4 * shuffle_parts(spark), len(listed) * (len(listed) + 1) // 2)).mapInArrow(frugal(partial(meet, stems)), "a long, b long, count long")
        if n > TOGETHER:
            yield met
        else:
            every_block = met if every_block is None else every_block.union(met)
    if every_block is not None:
        yield every_block


def vectors_of(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column("v")
    return np.asarray(col.flatten()).reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def unit(batch: pa.RecordBatch) -> np.ndarray:
    x = vectors_of(batch).astype(np.float64)
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300) if len(x) else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def gathered(rows: list[list], d: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, multiplicities and vectors, by node."""
    node, times, raw = (np.concatenate([np.frombuffer(r[i], t) for r in rows]) for i, t in enumerate((np.int64, np.int64, kind)))
    order = np.argsort(node)
    return node[order], times[order], raw.reshape(-1, d)[order]


def within(left, right, same: bool, axes, blocks, budget, k: int, threshold: float) -> Iterator[tuple]:
    """Counts and links of one meeting of two chunks, or of a chunk with itself."""
    (na, ta, xa), (nb, tb, xb) = left, right
    prep = []
    for x in (xa, xb):
        x = x.astype(np.float64)
        x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        turned = (u[:, :, None] * axes[None]).sum(1) if len(u) <= 1 else u @ axes
        prep.append((u, turned))
    (ua, ra), (ub, rb) = prep
    fa, fb = ra[:, blocks[k]].astype(np.float32), rb[:, blocks[k]].astype(np.float32)
    # Squared distances as one product: (-2 a, |a|^2, 1) times (b, 1, |b|^2).
    fa = np.column_stack([-2 * fa, (fa * fa).sum(1), np.ones(len(fa), np.float32)])
    fb = np.column_stack([fb, np.ones(len(fb), np.float32), (fb * fb).sum(1)])
    total = [np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64)]
    for i in range(0, len(na), TILE):
        for j in range(i if same else 0, len(nb), TILE):
            p, q = slice(i, i + TILE), slice(j, j + TILE)
            near = fa[p] @ fb[q].T <= budget[k] + 1e-4
            if same and i == j:
                near &= np.arange(near.shape[0])[:, None] < np.arange(near.shape[1])[None]
            y, z = np.nonzero(near)
            good = np.zeros(len(y), bool)
            for c in range(0, len(y), 50_000):
                yy, zz = y[c : c + 50_000] + i, z[c : c + 50_000] + j
                ok = np.einsum("ij,ij->i", ua[yy], ub[zz]) >= threshold
                yy, zz = yy[ok], zz[ok]
                diff = ua[yy] - ub[zz]
                # First block within budget: sums over axes one by one, so alike in every meeting.
                first = np.full(len(yy), -1)
                for b in range(k + 1):
                    gap = np.zeros(len(yy))
                    for axis in blocks[b]:
                        turn = np.zeros(len(yy))
                        for e in range(diff.shape[1]):
                            turn += diff[:, e] * axes[e, axis]
                        gap += turn * turn
                    first[(first < 0) & (gap <= budget[b])] = b
                ok[ok] = first == k
                good[c : c + 50_000] = ok
            y, z = y[good], z[good]
            if not len(y):
                continue
            total[0][p] += np.bincount(y, tb[q][z], len(na[p])).astype(np.int64)
            total[1][q] += np.bincount(z, ta[p][y], len(nb[q])).astype(np.int64)
            mask = np.zeros(near.shape, bool)
            mask[y, z] = True
            yield *spanning(mask, na[p], nb[q]), None, None
    for node, count in zip((na, nb), total, strict=True):
        some = np.flatnonzero(count)
        if len(some):
            yield node[some], None, count[some], None
