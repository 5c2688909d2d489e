"""What the operators share: tables written to the shared folder, and connected components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where unset, one in the warehouse."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/linkloom"
    return known.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


#: Tables that results read, by application; forget() removes them.
_kept: dict[str, list[str]] = {}


def forget(spark: SparkSession) -> None:
    """Removes the tables behind the results that operators have returned in this session; those can't be read any more."""
    for path in _kept.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


class Workspace:
    """Intermediate tables of one operator call, written as Parquet to the shared folder.

    A written table cuts lineage and survives lost executors. What results read (keep(), spare()) stays until forget(); the
    rest goes when the block ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0
        self.tables: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        for _, path in self.tables:
            remove(self.spark, path)
        release(self.spark)

    def save(self, df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
        """tidy: ask for the cleaning of the shuffles that made the table."""
        path = f"{self.root}/{name}-{self.made}"
        self.made += 1
        df.write.parquet(path)
        del df
        if tidy:
            release(self.spark)
        out = self.spark.read.parquet(path)
        self.tables.append((out, path))
        return out

    def _forgotten(self, df: DataFrame) -> list[str]:
        paths = [path for table, path in self.tables if table is df]
        self.tables = [x for x in self.tables if x[0] is not df]
        return paths

    def drop(self, df: DataFrame) -> None:
        for path in self._forgotten(df):
            remove(self.spark, path)

    def spare(self, df: DataFrame) -> None:
        """Keeps a saved table beyond the block."""
        _kept.setdefault(self.spark.sparkContext.applicationId, []).extend(self._forgotten(df))

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        out = self.save(df, name)
        self.spare(out)
        return out


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def clean_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component) where component is the smallest node reachable.

    Alternates two star contractions until the edges no longer change: every node hands its larger neighbours to
    its smallest one (large star), then its smaller neighbours too (small star). Rounds grow with the logarithm of
    the largest component. The minimum of a neighbourhood comes from an aggregate with partial sums, and the join that
    hands it out can be split by adaptive execution, so a hub node lands in no single task. Self-loops and repeated
    edges are harmless; without edges the result is empty.
    """
    spark = ws.spark

    def low(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def star(now: DataFrame, large: bool) -> DataFrame:
        """now: rows (u, v), u > v."""
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else now
        got = both.join(low(both), "u")
        got = got.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else got.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(got.select("u", F.col("m").alias("v")))
        return got.where("u > v").distinct()

    now = ws.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    mark = None
    while True:
        then = ws.save(star(star(now, True), False), "stars")
        seen = then.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if seen == mark or seen[0] == 0:
            break
        now, mark = then, seen
    roots = then.groupBy("u").agg(F.min("v").alias("component"))
    return ws.save(roots.select(F.col("u").alias("node"), "component").union(then.select("v", "v").distinct()).groupBy("node").agg(F.min("component").alias("component")), "components")
