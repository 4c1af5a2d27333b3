"""Shared pieces of the operators: written tables that cut lineage, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetstar.session import shared_folder

#: Word separators of the size and shingle rules: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"\x20\x09-\x0D"


def spark_folder(spark: SparkSession) -> str:
    """The shared folder of the session, or one below the warehouse where none is named."""
    return shared_folder(spark, spark.conf.get("spark.sql.warehouse.dir") + "/_llm").rstrip("/")


class Scratch:
    """Tables written to the shared folder and read back.

    Any executor can read them and they are never recomputed, so a lost executor costs only the
    tasks it ran. ``drop`` removes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{spark_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        for df in kept:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of texts that go to a Python worker at once.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python in batches of at most ``BATCH_ROWS``, for the session from now on.

    A batch is held several times over, on both sides; at Spark's own 10,000 rows that is hundreds of megabytes.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def release_memory() -> None:
    """Give back what Arrow keeps in a Python worker from the tasks that ran there before."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; component is the smallest node reachable.

    Every round each node points to its smallest neighbour (or itself), and the edges are rewritten
    between the nodes pointed to. Each tree of pointers holds at least two nodes, so the nodes left
    halve per round at least; a star ends in one. Smallest members survive every round, so the last
    name is the smallest node. Only per-node minima are aggregated (combined before the shuffle);
    joins read written tables on both sides, so a hot node is split like any skewed join key.
    """
    left = scratch.keep(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    named = None
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select("b", "a"))
        pointed = scratch.keep(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
            .select("node", F.least("node", "least").alias("up")),
            "pointers",
        )
        # Pointers go strictly down; following them ends at a node that points to itself.
        while True:
            ends = pointed.select(F.col("node").alias("up"), F.col("up").alias("end"))
            jumped = scratch.keep(pointed.join(ends, "up").select("node", F.col("end").alias("up"), (F.col("end") < F.col("up")).alias("moved")), "jumps")
            moved = not jumped.filter("moved").isEmpty()
            scratch.drop(pointed)
            pointed = jumped
            if not moved:
                break
        names = pointed.select("node", "up")
        if named is None:
            named = names
        else:
            step = names.select(F.col("node").alias("up"), F.col("up").alias("end"))
            named = scratch.keep(
                named.join(step, "up", "left").select("node", F.coalesce("end", "up").alias("up")), "names"
            )
        shorter = (
            left.join(names.select(F.col("node").alias("a"), F.col("up").alias("a_up")), "a")
            .join(names.select(F.col("node").alias("b"), F.col("up").alias("b_up")), "b")
            .filter("a_up <> b_up")
            .select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
            .distinct()
        )
        previous, left = left, scratch.keep(shorter, "edges")
        scratch.drop(previous)
    if named is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.select("node", F.col("up").alias("component"))
