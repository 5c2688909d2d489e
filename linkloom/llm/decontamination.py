"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

Words are runs of letters and digits of the lower-cased text. A mask is a fixed pattern of positions that count and
positions that are ignored; each window of SPAN words, of a document and of a benchmark item alike, is hashed once for
each mask over the positions that count. A pair of equal hashes is a hit: there the two texts agree but for the ignored
positions, so a changed word between them does not hide it. Hits of a document and an item on one diagonal (position in
the document less position in the item) are one candidate; it is verified by aligning the two on that diagonal and
counting equal words: a stretch of WINDOW words (the whole item where it is shorter) with at most one in SLACK words
changed is an overlap. Reported is the longest run of overlapping windows.

Every position of every whole text is hashed and looked up. The benchmark's hashes are broadcast while they are fewer
than BROADCAST_HASHES, which is counted; beyond that the join is shuffled, and adaptive execution splits skewed sides. The
join finds distinct hashes first, so a window that many items share meets the documents once.

Null or empty texts, and items of fewer than SHORTEST words, match nothing; items shorter than SPAN are looked up by their
whole sequence, exactly. Repeated items and repeated documents each give their own rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Workspace

#: 1 counts, 0 is ignored. For each set of changed words that the verifier accepts, in an item of any length from SPAN on, a
#: window of one of the masks ignores all the changed words within it; the tests go through all of them.
MASKS = ("11010011", "10011101", "11111000", "01101110")
SPAN = 8
WINDOW, SLACK = 16, 5
SHORTEST = 4
BROADCAST_HASHES = 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def windows(rows: DataFrame, key: str, around: int = 0) -> DataFrame:
    """key, at (the window's first position), and a hash for each mask: s0, s1, ...

    rows: key, codes. Shifted copies of the codes are zipped, so a window is a row and its hashes are compiled code.
    around: blank words before and behind, for items of which the document's edge cuts off as many words as may be changed.
    """
    if around:
        blank = F.array_repeat(F.lit(0).cast("long"), around)
        rows = rows.withColumn("codes", F.concat(blank, "codes", blank))
    n = F.size("codes") - SPAN + 1
    zipped = F.arrays_zip(F.sequence(F.lit(-around), n - 1 - around).alias("at"), *[F.slice("codes", i + 1, n).alias(f"c{i}") for i in range(SPAN)])
    cut = rows.where(F.size("codes") >= SPAN).select(key, F.inline(zipped))
    return cut.select(key, "at", *[F.xxhash64(F.lit(k), *[f"c{i}" for i, x in enumerate(m) if x == "1"]).alias(f"s{k}") for k, m in enumerate(MASKS)])


def one_by_one(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "at", F.explode(F.array(*[f"s{k}" for k in range(len(MASKS))])).alias("seed"))


def overlaps(docs: DataFrame, benchmark: DataFrame, ws: Workspace) -> DataFrame:
    """doc_id, item_id, start, end (in words of the document), n_same, n_item: verified overlaps."""
    coded = lambda df, key, name: df.select(F.col(key).alias(name), F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("codes"))
    items = ws.save(coded(benchmark, "item_id", "item_id").where(F.size("codes") >= SHORTEST).distinct().select(F.monotonically_increasing_id().alias("item"), "*"), "items")
    marks = windows(items, "item")
    short = items.where(F.size("codes") < SPAN)
    lengths = [r[0] for r in short.select(F.size("codes")).distinct().collect()]  # SHORTEST to SPAN - 1
    index = one_by_one(marks, "item")
    if lengths:
        index = index.union(short.select("item", F.lit(0), F.expr("xxhash64(-1, codes)")))
    index = ws.save(index.distinct(), "index")
    distinct = index.select("seed").distinct()
    seeds = F.broadcast(distinct) if index.count() < BROADCAST_HASHES else distinct
    texts = coded(docs, "doc_id", "doc_id")
    found = one_by_one(windows(texts, "doc_id", WINDOW // SLACK), "doc_id").join(seeds, "seed")
    for k in lengths:
        n = F.size("codes") - k + 1
        cut = texts.where(F.size("codes") >= k).select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(1), n), lambda i: F.slice("codes", i, k))).alias("at", "part"))  # noqa: B023  # a second argument would be the index
        found = found.unionByName(cut.select("doc_id", "at", F.expr("xxhash64(-1, part)").alias("seed")).join(seeds, "seed"))
    hits = ws.save(found.select("doc_id", "at", "seed"), "hits")
    pairs = hits.join(index.withColumnRenamed("at", "item_at"), "seed").select("doc_id", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    # Only documents with a hit are read again; each comes once for all its candidates.
    pairs = pairs.groupBy("doc_id", "item").agg(F.array_sort(F.collect_set("shift")).alias("shifts"))
    pairs = pairs.join(items.withColumnRenamed("codes", "own"), "item")
    again = texts.withColumn("row", F.xxhash64("codes")).dropDuplicates(["doc_id", "row"]).join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    checked = pairs.join(again, "doc_id").withColumn("shift", F.explode("shifts")).drop("shifts")

    size = F.size("own")
    width = F.least(size, F.lit(WINDOW))
    most = F.when(size < SPAN, 0).otherwise(F.floor(width / SLACK))
    same = F.transform("own", lambda w, i: (F.get("codes", i + F.col("shift")) == w) & (i + F.col("shift") >= 0))
    checked = checked.withColumn("same", F.transform(same, lambda x: F.coalesce(x, F.lit(False)).cast("int")))
    among = lambda i, n: F.aggregate(F.slice("same", (i + 1).cast("int"), n.cast("int")), F.lit(0), lambda a, x: a + x)
    checked = checked.withColumn("good", F.filter(F.sequence(F.lit(0), size - width), lambda i: among(i, width) >= width - most))
    checked = checked.where(F.size("good") > 0).withColumn("start", F.array_min("good")).withColumn("end", F.array_max("good") + width)
    best = checked.select("doc_id", "item_id", "item", F.greatest(F.col("start") + F.col("shift"), F.lit(0)).alias("start"), F.least(F.col("end") + F.col("shift"), F.size("codes")).alias("end"), among(F.col("start"), F.col("end") - F.col("start")).alias("n_same"), size.alias("n_item"))
    return best.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_same", -F.col("start"), "end", "n_item")).alias("x")).select("doc_id", "item_id", (-F.col("x.col2")).cast("long").alias("start"), F.col("x.end").cast("long").alias("end"), F.col("x.n_same").cast("long").alias("n_same"), F.col("x.n_item").cast("long").alias("n_item"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    with Workspace(docs.sparkSession, "decontamination") as ws:
        return ws.keep(overlaps(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), ws))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that overlap a benchmark item; a null doc_id stays."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
