"""Compacted decisions: each micro-batch merges into a new version of one row per number, published by a manifest.

The table is split into ``parts`` hash partitions of the number. A batch rewrites only the partitions it touches,
into a folder named by its batch id; the old rows of those partitions and the batch's rows are reduced to the newest
version of each number (``refresh.latest``). Then a manifest, a small file mapping every partition to its folder, is
written under ``_manifest/<batch id>``, and its ``_SUCCESS`` marker, written last, publishes it. Readers take the newest
published manifest, so they see whole versions only and never a half-written batch.

A batch id whose manifest is published is already merged: a replay does nothing. A batch that failed before its
manifest left an unpublished folder, which the replay overwrites. Folders and manifests that neither of the two newest
manifests uses are deleted, so a reader of the previous version still finds its files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayline.streaming.refresh import latest

KEY = "application_number"
PARTS = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def published(spark: SparkSession, folder: str) -> list[int]:
    """Batch ids of the published manifests, oldest first."""
    base = f"{folder}/_manifest"
    return [int(n) for n in _names(spark, base) if _fs(spark, f"{base}/{n}/_SUCCESS")[0].exists(_fs(spark, f"{base}/{n}/_SUCCESS")[1])]


def manifest(spark: SparkSession, folder: str, batch: int | None = None) -> dict:
    """The newest published manifest (or that of ``batch``): {"batch": id, "parts": {part: folder}}; empty before the first."""
    ids = published(spark, folder)
    if batch is None:
        if not ids:
            return {"batch": -1, "parts": {}}
        batch = ids[-1]
    line = spark.read.text(f"{folder}/_manifest/{batch:012d}").first()[0]  # one line of at most `parts` entries
    return json.loads(line)


def current(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The newest whole version: one row per number."""
    paths = list(manifest(spark, folder)["parts"].values())
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, batch_id: int, folder: str, parts: int = PARTS) -> None:
    """Merge one micro-batch into a new version and publish it; nothing happens for a batch already published."""
    spark = batch.sparkSession
    before = manifest(spark, folder)
    if batch_id <= before["batch"]:
        return
    part = F.pmod(F.xxhash64(KEY), F.lit(parts)).cast("int")
    batch = batch.persist()  # read for the partitions it touches and for the merge
    touched = sorted(r["part"] for r in batch.select(part.alias("part")).distinct().collect())  # at most `parts` rows
    columns = batch.columns
    merged = batch.select(*columns)
    old = [before["parts"][str(p)] for p in touched if str(p) in before["parts"]]
    if old:
        merged = merged.unionByName(spark.read.schema(batch.select(*columns).schema).parquet(*old))
    target = f"{folder}/batch-{batch_id:012d}"
    latest(merged, KEY).select(*columns).withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(target)
    parts_now = {**before["parts"], **{str(p): f"{target}/part={p}" for p in touched}}
    spark.createDataFrame([(json.dumps({"batch": batch_id, "parts": parts_now}),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{folder}/_manifest/{batch_id:012d}"
    )
    batch.unpersist()
    _clean(spark, folder)


def _clean(spark: SparkSession, folder: str) -> None:
    """Delete folders and manifests that neither of the two newest manifests uses."""
    ids = published(spark, folder)
    kept = ids[-2:]
    used = {p.split("/part=")[0].rstrip("/").split("/")[-1] for b in kept for p in manifest(spark, folder, b)["parts"].values()}
    for name in _names(spark, folder):
        if name.startswith("batch-") and name not in used:
            fs, path = _fs(spark, f"{folder}/{name}")
            fs.delete(path, True)
    for name in _names(spark, f"{folder}/_manifest"):
        if int(name) < kept[0]:
            fs, path = _fs(spark, f"{folder}/_manifest/{name}")
            fs.delete(path, True)


def compact(incoming: DataFrame, folder: str, checkpoint: str, parts: int = PARTS, every: str | None = None) -> StreamingQuery:
    """Merge every micro-batch of ``incoming`` into the compacted table at ``folder``."""
    writer = incoming.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, i: merge_batch(df, i, folder, parts))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
