"""N-gram Jaccard join: exact, on an inverted index with set-relation skipping.

A document's set is its distinct k-word shingles, as 64-bit hashes. Two documents link where
``den * |intersection| >= num * |union|``. Steps, all on whole texts and all rows:

1. Every document's set size and 128-bit signature; documents of one signature are one class, linked without further work.
   In the same pass tasks count shingles in a sketch of fixed size; its counts only set the order below, never a result.
2. Each set's shingles in a global order, rare first. Two linked sets share a shingle within their prefixes of
   ``n - ceil(num * n / den) + 1`` shingles. The prefixes make the index; lists with a single class are left at once.
3. Skipping in lists. A list is ordered by set size and cut into blocks of about STEP entries. Of each block the sizes and
   the farthest that its sets reach behind the shared shingle are known, so two blocks meet only if size and position leave
   a pair of them possible; each meeting is a group of its own, which any task may take. In a meeting entries are stepped in
   order of size until none is near enough, and pairs are skipped by position. Before the other lists are read, each long list compares its sets with one pivot, the set with the fewest rarer
   shingles. Sets that link so form families, and for each the distance to the family's leader is known. From then on
   families stand for their sets: two families are compared by their leaders, whose answer settles all pairs of members
   by the triangle inequality of the Jaccard distance (linked leaders join the families; leaders farther than the bound
   plus both radii rule out every pair). What this leaves open goes back to the lists: members are compared where a list
   makes just these two candidates and their distances to the leaders do not rule the pair out.
4. Candidates are verified on the sets; links make components, found by distributed star contraction.

Empty or null texts: no shingles, linked with nothing, a component of their own. Fewer than k words: the whole sequence is
the one shingle. Rows are what is linked: repeated rows are copies, and rows of one id with different texts are linked only
if their texts are. A row with a null id is linked with nothing and its component is null. Other columns are ignored.

The operator yields components and no links: pairs within a family are never compared, nor are members of linked families, so
neither the links nor the number of a document's links can be had from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.common import Workspace, components, shuffle_parts
from linkloom.llm.textarrays import frugal, mix, shingle_rows, slices

#: Cells of the sketch; its blocks.
CELLS, BLOCK = 1 << 22, 1 << 16
#: Lists longer than this are first compared with a pivot.
LONG = 16
#: Entries of a block of a list.
STEP = 1 << 10
#: Index entries that a task holds at once while it looks for lists of one class.
HELD = 1 << 21
#: Cells with more sets than this, and with far more than the others, are dealt over all parts; their lists are all kept.
HEAVY = 1 << 16
#: Pairs that a task gathers before it drops repeated ones and hands them on; entries that it holds besides a last meeting.
PAIRS, ENTRIES = 1 << 20, 1 << 18


def overlap_needed(a, b, num: int, den: int):
    """The least intersection with which sets of these sizes link."""
    return -(-num * (a + b) // (num + den))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """Rows of documents (doc_id, n, sig) and of the sketch (block, cells: counts of 32 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(CELLS, np.uint32)
        for batch in batches:
            n, sig, todo = [], [], []
            for _, data, off in slices(batch.column(1)):
                for s in shingle_rows(data, off, k):
                    n.append(len(s))
                    sig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    todo.append(s)
                cell, count = np.unique((np.concatenate(todo) if todo else np.zeros(0, np.uint64)) & np.uint64(CELLS - 1), return_counts=True)
                sketch[cell.astype(np.int64)] += count.astype(np.uint32)
                todo = []
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary())], names=["doc_id", "n", "sig", "block", "cells"])
        blocks = np.flatnonzero(sketch.reshape(-1, BLOCK).any(1))
        none = pa.nulls(len(blocks), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(blocks), pa.binary()), pa.array(blocks), pa.array([sketch[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in blocks], pa.binary())], names=["doc_id", "n", "sig", "block", "cells"])

    return docs.mapInArrow(frugal(run), "doc_id long, n long, sig binary, block long, cells binary")


def levels(made: DataFrame) -> np.ndarray:
    """For each cell of the summed sketch the rank, up to 255, of its count (eight to a doubling)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[b] = held.get(b, 0) + np.frombuffer(c, np.uint32).astype(np.uint64)
        for b, c in held.items():
            yield pa.RecordBatch.from_pydict({"block": [b], "level": [np.minimum(255, 8 * np.log2(1 + c)).astype(np.uint8).tobytes()]})

    n = CELLS // BLOCK
    got = made.where("block is not null").select("block", "cells").repartition(n, "block").mapInArrow(frugal(add), "block long, level binary")
    out = np.zeros(CELLS, np.uint8)
    for b, c in got.collect():  # a byte for each cell, whatever the input
        out[b * BLOCK : (b + 1) * BLOCK] = np.frombuffer(c, np.uint8)
    return out


def prefix_of(n, num: int, den: int):
    """How many of a set's n shingles are indexed."""
    return n - -(-num * n // den) + 1


def shared_prefixes(docs: DataFrame, level: np.ndarray, rows: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The index without lists of one class: key, sig, n, pos (position in the set's order).

    rows: n of every document; their number of prefix shingles sets how many parts there are, so that a part is of HELD
    entries at most. A key goes to one part, but where its cell of the sketch is heavy: there the set counts too, and lists
    of one class, which make no pair, stay.
    """
    spark = docs.sparkSession
    entries, shingles = rows.where("n > 0").agg(F.sum(F.expr(f"n - ceil({num} * n / {den}) + 1")), F.sum("n")).head()
    parts = max(shuffle_parts(spark), -(-int(entries or 0) // HELD))
    heavy = 8 * np.log2(1 + max(HEAVY, 16 * int(shingles or 0) / CELLS))
    held = spark.sparkContext.broadcast(level)
    kinds = (np.uint64, "V16", np.uint32, np.uint32)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = held.value
        seen: set[bytes] = set()
        for batch in batches:
            for _, data, off in slices(batch.column(0)):
                key, sig, size = [], [], []
                for s in shingle_rows(data, off, k):
                    if not len(s):
                        continue
                    mark = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if mark in seen:  # copies within a task
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(mark)
                    order = np.sort((rank[(s & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8)))
                    key.append(order[: prefix_of(len(s), num, den)])
                    sig.append(mark)
                    size.append(len(s))
                if not key:
                    continue
                count = np.array([len(x) for x in key])
                pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                key = np.concatenate(key)
                marks = np.repeat(np.array(sig, "V16"), count)
                salt = np.where(key >> np.uint64(56) > heavy, mix(marks.view(np.uint64)[::2]), np.uint64(0))
                to = (mix(key ^ salt) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cut = np.searchsorted(to[order], np.arange(parts + 1))
                columns = [x[order] for x in (key, marks, np.repeat(np.array(size, np.uint32), count), pos.astype(np.uint32))]
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array([c[cut[b] : cut[b + 1]].tobytes() for b in some], pa.binary()) for c in columns]], names=["part", "key", "sig", "n", "pos"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[], [], [], []]
        for batch in batches:
            for into, col in zip(held, batch.columns[1:], strict=True):
                into += col.to_pylist()
        if not held[0]:
            return
        key, sig, n, pos = (np.frombuffer(b"".join(x), t) for x, t in zip(held, kinds, strict=True))
        high, low = sig.view(np.uint64).reshape(-1, 2).T
        order = np.lexsort((pos, low, high, key))
        key, high, low = key[order], high[order], low[order]
        once = np.append(True, (key[1:] != key[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
        key, order = key[once], order[once]
        same = key[1:] == key[:-1]
        more = np.append(False, same) | np.append(same, False) | (key >> np.uint64(56) > heavy)
        key, at = key[more], order[more]
        sig, n, pos = sig[at], n[at], pos[at]
        for a in range(0, len(key), 100_000):
            s = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(key[s].view(np.int64)), pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(sig[s]), [None, pa.py_buffer(sig[s].tobytes())]).cast(pa.binary()), pa.array(n[s].astype(np.int32)), pa.array(pos[s].astype(np.int32))], names=["key", "sig", "n", "pos"])

    packed = docs.select("text").mapInArrow(frugal(prefixes), "part int, key binary, sig binary, n binary, pos binary")
    return packed.repartitionById(parts, "part").mapInArrow(frugal(shared), "key long, sig binary, n int, pos int")


def possible(a: str, b: str, num: int, den: int) -> str:
    """The bound of sizes and positions on two entries or blocks, of which n_high_a is not above n_high_b."""
    return f"{den} * n_high_{a} >= {num} * n_low_{b} and (1 + least(left_{a}, left_{b})) * {num + den} >= {num} * (n_low_{a} + n_low_{b})"


def with_pivots(index: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b): each node of a list longer than LONG with the list's pivot, if size and position allow it.

    The pivot is the set with the fewest rarer shingles: of edited copies the least edited one, in most lists of a family.
    It comes from an aggregate with partial sums, and the join may be split by adaptive execution.
    """
    pivot = index.groupBy("key").agg(F.count("*").alias("many"), F.min(F.struct((F.col("n") - F.col("left")).alias("rarer"), "node", "n", "left")).alias("p")).where(F.col("many") > LONG)
    both = index.join(pivot.select("key", "p"), "key").where("node <> p.node")
    fits = f"{den} * least(n, p.n) >= {num} * greatest(n, p.n) and (1 + least(left, p.left)) * {num + den} >= {num} * (n + p.n)"
    return both.where(fits).select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()


def meetings(ws: Workspace, index: DataFrame, num: int, den: int) -> DataFrame:
    """Entries as key, x, y (the blocks that meet), side (1 in the block of larger sets), node, n_low, n_high, left.

    index: key, node, n_low, n_high, left. A list of up to STEP entries is one block that meets itself.
    """
    entry = ["node", "n_low", "n_high", "left"]
    long = ws.save(index.groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > STEP).select("key"), "long", tidy=True)
    whole = lambda df: df.select("key", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(0).alias("side"), *entry)
    if long.isEmpty():
        return whole(index)
    listed = index.join(long, "key", "left_semi")
    # Where the entries of a size begin, by a running sum over the list's sizes; they are dealt among the blocks they reach.
    sizes = listed.groupBy("key", "n_high").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("key").orderBy("n_high")) - F.col("c")
    placed = listed.join(sizes.select("key", "n_high", "c", before.alias("before")), ["key", "n_high"])
    placed = ws.save(placed.select("key", F.expr(f"(before + pmod(xxhash64(node), c)) div {STEP}").alias("block"), *entry), "placed", tidy=True)
    blocks = placed.groupBy("key", "block").agg(F.min("n_low").alias("n_low"), F.max("n_high").alias("n_high"), F.max("left").alias("left"))
    b = lambda c: blocks.select("key", F.col("block").alias(c), *[F.col(f).alias(f"{f}_{c}") for f in entry[1:]])
    met = ws.save(b("x").join(b("y"), "key").where("x <= y").where(possible("x", "y", num, den)).select("key", "x", "y"), "meetings", tidy=True)
    sides = [placed.join(met.withColumn("block", F.col(c)), ["key", "block"]).where("x < y" if side else "true").select("key", "x", "y", F.lit(side).alias("side"), *entry) for side, c in enumerate("xy")]
    return whole(index.join(long, "key", "left_anti")).union(sides[0]).union(sides[1])


def in_lists(met: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b) that skipping leaves, of the entries of meetings."""
    most, enough = PAIRS, ENTRIES

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key, x, y, side, node, low, high, left = (table.column(i).to_numpy() for i in range(8))
        order = np.lexsort((high, side, y, x, key))
        key, x, y, side, node, low, high, left = (c[order] for c in (key, x, y, side, node, low, high, left))
        here = np.arange(len(key))
        begin = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
        mark = np.repeat(begin, np.diff(np.append(begin, len(key))))
        # Within a block an entry meets all before it, from the nearest in size on; else those of the other block.
        smaller = np.add.reduceat(side == 0, begin)
        nearest = np.where(x == y, here - 1, mark + np.repeat(smaller, np.diff(np.append(begin, len(key)))) - 1)

        def batch(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = node[a], node[b]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
            for i in range(0, len(pairs), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[i : i + 100_000, c]) for c in (0, 1)], names=["a", "b"])

        live = np.flatnonzero(((x == y) | (side == 1)) & (nearest >= mark))
        other, found, gathered = nearest[live], [], 0
        while len(live):
            near = den * high[other] >= num * low[live]
            live, other = live[near], other[near]
            hit = 1 + np.minimum(left[other], left[live]) >= overlap_needed(low[other], low[live], num, den)
            found.append(np.stack([other[hit], live[hit]]))
            gathered += found[-1].shape[1]
            if gathered > most:
                yield from batch(*np.concatenate(found, axis=1))
                found, gathered = [], 0
            more = other > mark[live]
            live, other = live[more], other[more] - 1
        if found:
            yield from batch(*np.concatenate(found, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of meetings; all but the last meeting, which may go on, are compared once there are enough."""
        held, n = [], 0
        for got in batches:
            held.append(got)
            n += got.num_rows
            if n < enough:
                continue
            table = pa.Table.from_batches(held)
            group = np.stack([table.column(i).to_numpy() for i in range(3)])
            cut = np.flatnonzero((group != group[:, -1:]).any(0))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            if cut:
                yield from compared(table.slice(0, cut))
                held, n = table.slice(cut).to_batches(), table.num_rows - cut
        if n:
            yield from compared(pa.Table.from_batches(held))

    by = ["key", "x", "y"]
    return met.repartition(*by).sortWithinPartitions(*by).mapInArrow(frugal(run), "a long, b long").distinct()


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """sig, doc_id and set (sorted hashes) of the wanted classes (doc_id), read again from the texts, without a shuffle.

    A filter of fixed size, broadcast, keeps most other documents from being cut into shingles; a few pass, and what
    joins the result by sig and doc_id leaves them out.
    """
    spark = docs.sparkSession
    bits = np.zeros(1 << 23, np.uint8)  # at most 2^26 bits
    marks = wanted.select((F.xxhash64("doc_id").bitwiseAND((1 << 26) - 1)).cast("int").alias("h")).distinct()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << 23, np.uint8)
        for batch in batches:
            h = batch.column(0).to_numpy()
            np.bitwise_or.at(own, h >> 3, (128 >> (h & 7)).astype(np.uint8))
        packed = own.reshape(64, -1)
        some = np.flatnonzero(packed.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([packed[i].tobytes() for i in some], pa.binary())], names=["i", "bits"])

    for i, x in marks.coalesce(4).mapInArrow(frugal(fold), "i long, bits binary").collect():
        bits.reshape(64, -1)[i] |= np.frombuffer(x, np.uint8)
    held = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((held.value[h >> 3] >> (7 - (h & 7))) & 1 == 1))
            at = 0
            for _, data, off in slices(batch.column(1)):
                got = list(shingle_rows(data, off, k))
                ids, at = batch.column(0).slice(at, len(got)), at + len(got)
                sig = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in got]
                yield pa.RecordBatch.from_arrays([pa.array(sig, pa.binary()), ids, pa.array([s.view(np.int64) for s in got], pa.list_(pa.int64()))], names=["sig", "doc_id", "set"])

    rows = docs.select("doc_id", "text", (F.xxhash64("doc_id").bitwiseAND((1 << 26) - 1)).cast("int").alias("h")).where("doc_id is not null")
    return rows.mapInArrow(frugal(run), "sig binary, doc_id long, set array<bigint>")


def distances(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, and the sizes of their intersection (same) and union (all). classes: node, sig, doc_id; sets: sig, doc_id, set."""
    both = pairs.select("a", "b")
    for c in ("a", "b"):
        both = both.join(classes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("doc_id").alias(f"doc_{c}")), c)
    for c in ("a", "b"):
        both = both.join(sets.select(F.col("sig").alias(f"sig_{c}"), F.col("doc_id").alias(f"doc_{c}"), F.col("set").alias(f"set_{c}")), [f"sig_{c}", f"doc_{c}"])
    same = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    return both.select("a", "b", same.alias("same"), (F.size("set_a") + F.size("set_b")).alias("both")).select("a", "b", "same", (F.col("both") - F.col("same")).alias("all"))


def join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    linked = F.expr(f"same * {den} >= all * {num}")
    bound = 1 - num / den
    with Workspace(spark, "jaccard") as ws:
        made = ws.save(signatures(docs, k), "signatures")
        rank = levels(made)
        rows = made.where("block is null").select("doc_id", "n", "sig")
        classes = rows.where("n > 0 and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
        classes = ws.save(classes.select("sig", "doc_id", F.monotonically_increasing_id().alias("node")), "classes")
        index = ws.save(shared_prefixes(docs.where("doc_id is not null"), rank, rows.where("doc_id is not null"), k, num, den), "index", tidy=True)
        index = ws.save(index.join(classes, "sig").select("key", "node", "n", (F.col("n") - F.col("pos") - 1).alias("left")), "lists")

        def sets_for(pairs: DataFrame, name: str) -> DataFrame:
            nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            return ws.save(sets_of(docs, nodes.join(classes, "node"), k), name, tidy=True)

        single = index.select("key", "node", F.col("n").alias("n_low"), F.col("n").alias("n_high"), "left")
        # Families.
        pivots = ws.save(with_pivots(index, num, den), "pivots", tidy=True)
        early = sets_for(pivots, "early")
        met = ws.save(distances(pivots, classes, early), "met", tidy=True)
        near = met.where(linked)
        # A family's leader is its set with the most links, mostly one pivot; the distances to it are mostly known.
        ends = near.select(F.col("a").alias("node")).union(near.select("b")).groupBy("node").agg(F.count("*").alias("links"))
        family = components(ws, near).join(ends, "node")
        leader = family.groupBy("component").agg(F.max(F.struct("links", -F.col("node"))).alias("most")).select("component", (-F.col("most.col2")).alias("leader"))
        family = ws.save(family.join(leader, "component").where("node <> leader").select("node", "leader"), "family", tidy=True)
        spans = family.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"), "node", "leader")
        known = spans.join(met, ["a", "b"], "left")
        far = distances(known.where("same is null").select("a", "b"), classes, early).join(spans, ["a", "b"])
        span = (1 - F.col("same") / F.col("all")).alias("d")
        reach = ws.save(known.where("same is not null").select("node", "leader", span).union(far.select("node", "leader", span)), "reach", tidy=True)
        radius = reach.groupBy("leader").agg(F.max("d").alias("r"))
        led = single.join(reach, "node", "left").select("key", F.coalesce("leader", "node").alias("node"), "n_low", "n_high", "left")
        led = led.groupBy("key", "node").agg(F.min("n_low").alias("n_low"), F.max("n_high").alias("n_high"), F.max("left").alias("left"))
        pairs = ws.save(in_lists(meetings(ws, ws.save(led, "led", tidy=True), num, den), num, den), "pairs", tidy=True)
        fresh = ws.save(pairs.join(met, ["a", "b"], "left_anti"), "fresh", tidy=True)
        late = sets_for(fresh, "late")
        told = ws.save(distances(fresh, classes, late).select("a", "b", "same", "all").union(met.join(pairs, ["a", "b"], "left_semi").select("a", "b", "same", "all")), "told", tidy=True)
        links = told.where(linked).select("a", "b")
        r = lambda c: radius.select(F.col("leader").alias(c), F.col("r").alias(f"r_{c}"))
        open_ = told.where(~linked).withColumn("d", 1 - F.col("same") / F.col("all")).join(r("a"), "a", "left").join(r("b"), "b", "left").fillna(0.0, ["r_a", "r_b"]).where(f"d <= {bound} + r_a + r_b + 1e-9 and r_a + r_b > 0")
        open_ = ws.save(open_.select("a", "b", "d").distinct(), "open", tidy=True)
        # Members of two families are compared if the lists themselves make them candidates and the leaders rule them not out.
        ends = open_.select(F.col("a").alias("leader")).union(open_.select("b")).distinct()
        members = reach.select("leader", "node", "d").union(radius.select("leader", F.col("leader").alias("node"), F.lit(0.0)))
        members = ws.save(ends.join(members, "leader", "left").select("leader", F.coalesce("node", "leader").alias("node"), F.coalesce("d", F.lit(0.0)).alias("d")), "members", tidy=True)
        entries = ws.save(index.join(members, "node").select("leader", "key", "node", "n", "left", "d"), "entries", tidy=True)
        many = members.groupBy("leader").agg(F.count("*").alias("many"))
        open_ = open_.join(many.select(F.col("leader").alias("a"), F.col("many").alias("many_a")), "a").join(many.select(F.col("leader").alias("b"), F.col("many").alias("many_b")), "b")
        fewer = F.col("many_a") <= F.col("many_b")
        open_ = open_.select(F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("leader_x"), F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("leader_y"), F.col("d").alias("d"))
        e = lambda c: entries.select(F.col("leader").alias(f"leader_{c}"), "key", F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("left").alias(f"left_{c}"), F.col("d").alias(f"d_{c}"))
        ruled = f"d <= {bound} + d_x + d_y + 1e-9 and {den} * least(n_x, n_y) >= {num} * greatest(n_x, n_y) and (1 + least(left_x, left_y)) * {num + den} >= {num} * (n_x + n_y)"
        meet = open_.join(e("x"), "leader_x").join(e("y"), ["leader_y", "key"]).where(ruled)
        apart = ws.save(meet.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(told, ["a", "b"], "left_anti"), "apart", tidy=True)
        more = ws.save(distances(apart, classes, early.union(late)).where(linked).select("a", "b"), "more", tidy=True)
        inner = components(ws, links.union(more).union(near.select("a", "b")))
        least = classes.join(inner, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
        named = classes.join(inner.join(least, "component"), "node", "left").select("sig", F.coalesce("component_id", "doc_id").alias("component_id"))
        out = rows.join(named, F.when(F.col("doc_id").isNotNull(), rows["sig"]) == named["sig"], "left")
        return ws.keep(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs without the documents whose component has a smaller doc_id; rows with a null id stay.

    An id goes with all its rows if one of its texts has a copy with a smaller id.
    """
    gone = join(docs, k, num, den).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
