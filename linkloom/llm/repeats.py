"""Repeated passages: suffix arrays by difference cover, distributed by shared anchors.

A byte is removed if a LENGTH-byte string that covers it starts anywhere else too, in the same document or another. Only
strings that occur again matter, and finding them by sorting all suffixes of the corpus at once would shuffle each suffix
several times. So suffixes are first dealt to groups that can be sorted apart:

1. Every string has one anchor: of its GRAM-byte substrings the one with the least hash (leftmost if tied). Equal
   strings have equal anchors at equal places. A task finds the anchors of its whole texts; next to each anchor it knows
   the strings (consecutive starts) that have it.
2. Anchors whose gram occurs once are done: none of their strings repeats. For the others the context (the bytes that
   their strings span) is gathered; equal contexts are one, with a count, found by an aggregate with partial sums.
3. Contexts meet in groups of one gram. Where more than CROWD different contexts have a gram, they are too many for one
   task: there each string goes to the place of its own hash, packed, and equal ones are counted, which is exact too.
4. In a group, the difference-cover algorithm sorts the suffixes of the joined contexts: suffixes at places 1 and 2 of 3
   are sorted by triples, names that are not yet unique are sorted by recursion, the rest is merged by first symbol and the rank
   behind it. Of the strings that the group is for, neighbours in this order are compared over LENGTH bytes (by hash, and
   those alike byte by byte); equal ones repeat.
5. Repeated starts go back to their documents as runs, whose union, each widened by LENGTH, is removed.

Strings never cross documents; overlapping occurrences count; all is judged on the input. Texts are UTF-8 bytes; a null text is empty, and texts
shorter than LENGTH lose nothing unless covered, which they can't be. Repeated rows are documents of their own. A null id
gets its row. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Workspace, shuffle_parts
from linkloom.llm.textarrays import frugal, prefix_hash, slices, span

LENGTH, GRAM = 400, 64
#: Distinct contexts of one gram that may meet in one group.
CROWD = 1000
#: Bytes whose suffixes are sorted together, about; bytes of a very long text that are looked at together.
SORTED, PIECE = 1_000_000, 1 << 20


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor with its strings: document, place, first and last start of its strings (in data), gram's hash."""
    n = len(data)
    w = length - gram + 1  # grams in a string
    if n < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    c = prefix_hash(data)
    h = span(c, np.arange(n - gram + 1), np.arange(gram, n + 1))
    # Minimum of every w neighbouring hashes: from both ends of blocks of w. Ties go left.
    least = sliding_argmin(h, w)
    start = np.arange(len(least))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(least)]
    inside = start + length <= off[doc + 1]
    start, least, doc = start[inside], least[inside], doc[inside]
    new = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])))[: len(start)]
    last = np.append(new[1:] - 1, len(start) - 1)[: len(new)]
    return doc[new], least[new], start[new], start[last], h[least[new]]


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Place of the least of h[i:i + w] for every i, leftmost if tied."""
    n = len(h)
    m = -(-n // w) * w
    padded = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    at = np.arange(m)

    def running(rev: bool) -> np.ndarray:
        x = padded.reshape(-1, w)
        x = x[:, ::-1] if rev else x
        low = np.minimum.accumulate(x, axis=1)
        fresh = np.ones(x.shape, bool)
        fresh[:, 1:] = x[:, 1:] <= low[:, :-1] if rev else x[:, 1:] < low[:, :-1]
        place = np.maximum.accumulate(np.where(fresh, np.arange(w), 0), axis=1)
        if rev:
            place = (w - 1 - place)[:, ::-1]
        return (place + np.arange(0, m, w)[:, None]).ravel()

    ahead, back = running(False), running(True)  # from a block's begin up to i; from i to its end
    i = at[: n - w + 1]
    a, b = back[i], ahead[i + w - 1]
    return np.where(padded[b] < padded[a], b, a)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of text (small positive integers) in order, by the difference cover {1, 2} mod 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.zeros(n + 3, np.int64)
    t[:n] = text
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])  # as many in the first part as places 0
    width = int(t.max()) + 1
    if width < 2_000_000:
        key = (t[sample] * width + t[np.minimum(sample + 1, n)]) * width + t[np.minimum(sample + 2, n + 1)]
        order = np.argsort(key)
        new = np.append(True, key[order][1:] != key[order][:-1])
    else:
        order = np.lexsort((t[np.minimum(sample + 2, n + 1)], t[np.minimum(sample + 1, n)], t[sample]))
        s = sample[order]
        new = np.append(True, (t[s[1:]] != t[s[:-1]]) | (t[s[1:] + 1] != t[s[:-1] + 1]) | (t[s[1:] + 2] != t[s[:-1] + 2]))
    name = np.zeros(len(sample), np.int64)
    name[order] = np.cumsum(new)
    if name.max() < len(sample):
        order = suffix_order(name)
        name[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = name
    cover = sample[order]
    cover = cover[cover < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(t[rest] * (len(sample) + 2) + rank[rest + 1])]
    # Merge: a place 0 stands against places 1 by (symbol, rank behind), against places 2 by (two symbols, rank behind);
    # both orders are known, so each of the rest finds its place among either by binary search.
    width2, top = int(t.max()) + 1, len(sample) + 2
    one, two = cover[cover % 3 == 1], cover[cover % 3 == 2]
    before = np.searchsorted(t[one] * top + rank[one + 1], t[rest] * top + rank[rest + 1])
    before += np.searchsorted((t[two] * width2 + t[two + 1]) * top + rank[two + 2], (t[rest] * width2 + t[rest + 1]) * top + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = before + np.arange(len(rest))
    out[at] = rest
    free = np.ones(n, bool)
    free[at] = False
    out[free] = cover
    return out


def repeated(contexts: list[bytes], width: list[int], many: list[bool], length: int) -> list[np.ndarray]:
    """For each context the starts, from 0 to its width, whose string begins elsewhere too.

    many: the context itself occurs more than once. The contexts are sorted as one text with a mark of its own behind
    each, so no two suffixes tie.
    """
    size = np.array([len(c) + 1 for c in contexts])
    begin = np.append(0, np.cumsum(size))
    raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    text = raw.astype(np.int64) + len(contexts) + 1
    text[begin[1:] - 1] = np.arange(1, len(contexts) + 1)
    order = suffix_order(text)
    own = np.zeros(len(text), bool)
    for i, w in zip(begin[:-1], width, strict=True):
        own[i : i + w + 1] = True
    place = order[own[order]]
    h = span(prefix_hash(raw), place, place + length)
    twin = h[1:] == h[:-1]
    at = np.flatnonzero(twin)
    twin[at] = alike(raw, place[at], place[at + 1], length)  # neighbours alike over the whole length
    found = np.zeros(len(text), bool)
    found[place[np.append(False, twin) | np.append(twin, False)]] = True
    return [np.arange(w + 1) if m else np.flatnonzero(found[i : i + w + 1]) for i, w, m in zip(begin[:-1], width, many, strict=True)]


def alike(raw: np.ndarray, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings of that length at i and at j are equal, byte by byte; eight at a time, and only while equal."""
    out = np.ones(len(i), bool)
    step = 8 if length >= 8 else 1
    words = np.ndarray(max(0, len(raw) - step + 1), "<u8" if step == 8 else "u1", raw, strides=(1,))
    for k in [*range(0, length - step + 1, step), length - step]:
        same = words[i + k] == words[j + k]
        if not same.all():
            out[np.flatnonzero(out)[~same]] = False
            i, j = i[same], j[same]
    return out


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive integers."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]


def pieces(texts: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts, or parts of a very long one that share no string: first row, place in it, bytes, offsets."""
    for a, data, off in slices(texts):
        if len(off) > 2 or len(data) <= PIECE:
            yield a, 0, data, off
            continue
        for s in range(0, len(data), PIECE):
            part = data[s : s + PIECE + length - 1]
            yield a, s, part, np.array([0, len(part)])


def repeated_runs(docs: DataFrame, ws: Workspace, length: int, gram: int) -> DataFrame:
    """row, mark_row, first, last: runs of starts (in the row's bytes) of strings that repeat. docs: row, mark_row, text."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct grams of a task with their count."""
        held: list[np.ndarray] = []
        for batch in batches:
            for _, _, data, off in pieces(batch.column(0), length):
                held.append(anchors(data, off, length, gram)[4])
        if held:
            g, n = np.unique(np.concatenate(held), return_counts=True)
            for i in range(0, len(g), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(g[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000])], names=["gram", "n"])

    grams = docs.select("text").mapInArrow(frugal(counted), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    grams = ws.save(grams.select("gram"), "grams", tidy=True)
    held_bits = spark.sparkContext.broadcast(filter_bits(grams))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each anchor whose gram may repeat; equal bodies are sent once a task."""
        bits = held_bits.value
        seen: set[bytes] = set()
        for batch in batches:
            row, mark_row = batch.column(0), batch.column(1)
            for a, s, data, off in pieces(batch.column(2), length):
                doc, _, first, last, h = anchors(data, off, length, gram)
                at = (h & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
                some = np.flatnonzero((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
                mark, body = [], []
                for i in some:
                    b = data[first[i] : last[i] + length].tobytes()
                    mark.append(hashlib.blake2b(b, digest_size=16).digest())
                    body.append(None if mark[-1] in seen else b)
                    if len(seen) < 1_000_000:
                        seen.add(mark[-1])
                own = pa.array(a + doc[some])
                yield pa.RecordBatch.from_arrays([row.take(own), mark_row.take(own), pa.array((s + first - off[doc])[some]), pa.array((last - first)[some]), pa.array(h[some].view(np.int64)), pa.array(mark, pa.binary()), pa.array(body, pa.binary())], names=["row", "mark_row", "first", "width", "gram", "mark", "body"])

    found = ws.save(docs.mapInArrow(frugal(contexts), "row long, mark_row long, first long, width long, gram long, mark binary, body binary"), "contexts", tidy=True)
    alone = found.groupBy("mark").agg(F.first("gram").alias("gram"), F.first("width").alias("width"), F.first("body", ignorenulls=True).alias("body"), F.count("*").alias("n"))
    distinct = ws.save(alone, "bodies", tidy=True)
    crowd = ws.save(distinct.groupBy("gram").count().where(f"count > {CROWD}").select("gram"), "crowd")
    few = distinct.join(crowd, "gram", "left_anti")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by gram. Groups of one context need no sorting; others are sorted some at a time."""

        def flush(group: list, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, held
            if len(group) == 1:
                alone.extend([(group[0][1], 0, group[0][2])] if group[0][4] > 1 else [])
            else:
                waiting += group
                held += sum(len(g[3]) for g in group)
            if waiting and (held > SORTED or last):
                for g, starts in zip(waiting, repeated([g[3] for g in waiting], [g[2] for g in waiting], [g[4] > 1 for g in waiting], length), strict=True):
                    alone.extend((g[1], i, j) for i, j in zip(*runs_of(starts), strict=True))
                waiting, held = [], 0
            if alone and (last or len(alone) > 50_000):
                m, i, j = zip(*alone, strict=True)
                alone.clear()
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.binary()), pa.array(i, pa.int64()), pa.array(j, pa.int64())], names=["mark", "low", "high"])

        waiting, held, alone, group = [], 0, [], []
        for batch in batches:
            for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and group[0][0] != x[0]:
                    yield from flush(group, False)
                    group = []
                group.append(x)
        if group:
            yield from flush(group, True)

    few = few.select("gram", "mark", "width", "body", "n").repartition(parts, "gram").sortWithinPartitions("gram")
    runs = ws.save(few.mapInArrow(frugal(sort), "mark binary, low long, high long").union(crowded(distinct.join(crowd, "gram", "left_semi"), length, parts)), "runs", tidy=True)
    ws.drop(distinct)
    return found.select("row", "mark_row", "first", "mark").join(runs, "mark").select("row", "mark_row", (F.col("first") + F.col("low")).alias("first"), (F.col("first") + F.col("high")).alias("last"))


def crowded(bodies: DataFrame, length: int, parts: int) -> DataFrame:
    """Runs of repeated starts of contexts whose gram is too common for one group.

    Each string goes by its own hash to a part, packed, where equal ones are counted; so no key gathers a group's bytes.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                some = batch.slice(i, 2000)
                mark, width, body, n = (c.to_pylist() for c in some.columns)
                raw = np.frombuffer(b"".join(body), np.uint8)
                begin = np.append(0, np.cumsum([len(b) for b in body]))
                count = np.array(width) + 1
                start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                at = np.repeat(begin[:-1], count) + start
                h = span(prefix_hash(raw), at, at + length)
                own = np.repeat(np.array(mark, "V16"), count)
                twice = np.repeat(np.array(n) > 1, count)
                to = (h % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cut = np.searchsorted(to[order], np.arange(parts + 1))
                held = [x[order] for x in (h, own, start.astype(np.uint32), twice)]
                for p in np.flatnonzero(np.diff(cut)):
                    yield pa.RecordBatch.from_arrays([pa.array([p]), *[pa.array([x[cut[p] : cut[p + 1]].tobytes()], pa.binary()) for x in held]], names=["part", "h", "own", "start", "twice"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[], [], [], []]
        for batch in batches:
            for into, col in zip(held, batch.columns[1:], strict=True):
                into += col.to_pylist()
        if not held[0]:
            return
        h, own, start, twice = (np.frombuffer(b"".join(x), t) for x, t in zip(held, (np.uint64, "V16", np.uint32, bool), strict=True))
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        hit = np.zeros(len(h), bool)
        hit[order] = np.append(False, same) | np.append(same, False)
        some = np.flatnonzero(hit | twice)
        for i in range(0, len(some), 100_000):
            x = some[i : i + 100_000]
            s = pa.array(start[x].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(own[x].tolist(), pa.binary()), s, s], names=["mark", "low", "high"])

    rows = bodies.select("mark", "width", "body", "n").mapInArrow(frugal(deal), "part long, h binary, own binary, start binary, twice binary")
    return rows.repartition(parts, "part").mapInArrow(frugal(meet), "mark binary, low long, high long")


def filter_bits(grams: DataFrame) -> np.ndarray:
    """A bit for each value of the grams' last 27 bits: a filter of fixed size, which lets a few others pass."""
    size = 1 << 27

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy() & (size - 1)
            np.bitwise_or.at(own, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        packed = own.reshape(256, -1)
        some = np.flatnonzero(packed.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([packed[i].tobytes() for i in some], pa.binary())], names=["i", "bits"])

    out = np.zeros((256, size // 8 // 256), np.uint8)
    for i, x in grams.select("gram").coalesce(4).mapInArrow(frugal(fold), "i long, bits binary").collect():
        out[i] |= np.frombuffer(x, np.uint8)
    return out.ravel()


def union_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal intervals [begin, end) that the intervals [first, last) cover; touching ones are one."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > last[:-1])
    return first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, text as bytes (kept), n_bytes and spans (removed intervals of bytes) for every row of docs."""
    with Workspace(docs.sparkSession, "repeats") as ws:
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"))
        rows = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("row"), F.xxhash64("text").alias("mark_row"), "text", "doc_id")
        runs = repeated_runs(rows.select("row", "mark_row", "text"), ws, length, gram).distinct()
        runs = runs.groupBy("row", "mark_row").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
        runs = ws.keep(runs, "of-rows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for data, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not own:
                    kept.append(data)
                    spans.append([])
                    continue
                begin, end = union_of(np.array([r["first"] for r in own]), np.array([r["last"] for r in own]) + length)
                kept.append(b"".join(data[i:j] for i, j in zip([0, *end], [*begin, len(data)], strict=True)))
                spans.append([{"start": int(i), "end": int(j)} for i, j in zip(begin, end, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "kept", "n_bytes", "spans"])

    joined = rows.join(runs, ["row", "mark_row"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(frugal(cut), "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,end:long>>")


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and has_repeat: whether anything was removed."""
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return removed.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), (F.size("spans") > 0).alias("has_repeat"))
