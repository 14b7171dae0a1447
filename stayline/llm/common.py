"""Tables by name, staged intermediate tables and connected components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.session import staged_path, tune

#: The white space of the text contracts.
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # texts may be long
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Staged:
    """Tables written to the cluster's shared folder; ``drop`` deletes those whose consumers have run.

    Lineage ends at the written files, so a lost executor costs a re-read.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def path(self, name: str) -> str:
        self.paths[name] = staged_path(self.spark, f"{self.label}-{name}")
        return self.paths[name]

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def row_key(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a key of both, ``row_key``; the key tells rows apart whose doc_id repeats or is null."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).alias("row_key"),
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the batches whose ``column`` holds at most ``limit`` bytes; a longer single text is a piece of its own."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)


def components(staged: Staged, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): a row ``vertex``, ``root`` per vertex of an edge between two vertices.

    ``root`` is the smallest vertex of the component. Alternating large-star and small-star steps; every step is
    two grouped minima and two joins, and its edges are staged. A vertex with very many neighbours only makes a
    long join side, which adaptive execution splits.
    """
    spark = staged.spark
    pair = lambda big, small: (F.greatest(big, small).alias("a"), F.least(big, small).alias("b"))
    current = staged.write(edges.where("a <> b").select(*pair("a", "b")).distinct(), f"{name}-0")
    mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    step = 0
    while mark[0]:
        step += 1
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        following = staged.write(
            small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), f"{name}-{step}"
        )
        staged.drop(f"{name}-{step - 1}")
        current = following
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = current.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return roots.union(current.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:16]}"


def worker_store() -> dict:
    """A dict that lives as long as the Python worker, so later tasks of the worker find what earlier ones built."""
    holder = sys.modules.setdefault("_stayline_worker_store", types.ModuleType("_stayline_worker_store"))
    return holder.__dict__.setdefault("kept", {})


def hash_sample(rows: DataFrame, label: str, limits: dict, ties: list[str]) -> DataFrame:
    """Of each value of ``label`` the rows with the smallest hashes, at most ``limits[value]`` (or ``limits[None]``) of them.

    Rows far above the expected cut are left out where they are read, so a few thousand rows of a label meet in its task,
    whatever the number of rows. The hash is over all columns of ``ties``, so copies of a text don't share it.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}  # one row per label
    mark, room, most = F.xxhash64(*ties), F.lit(None).cast("long"), F.lit(None).cast("int")
    for value, count in counts.items():
        limit = limits.get(value, limits.get(None))
        if value is None or not limit:
            continue
        share = min(1.0, (4 * limit + 100) / count)
        room = F.when(F.col(label) == value, F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))).otherwise(room)
        most = F.when(F.col(label) == value, F.lit(limit)).otherwise(most)
    marked = rows.withColumns({"hash_mark": mark, "hash_most": most}).where(mark <= room)
    order = Window.partitionBy(label).orderBy("hash_mark", *ties)
    return marked.withColumn("hash_place", F.row_number().over(order)).where("hash_place <= hash_most").drop("hash_mark", "hash_most", "hash_place")
