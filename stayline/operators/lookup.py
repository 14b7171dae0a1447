"""Bulk lookup of decisions: exact match, else the nearest numbers before and after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.application import DIGITS, as_integer, decision_class, normalise_number, with_number_check

# Width of a bucket of numbers. A bucket holds at most this many distinct numbers.
BUCKET = 100_000


def first_rows(decisions: DataFrame, key: Column) -> DataFrame:
    """One row per key, the first in file order. Repeats are combined on the map side."""
    first = F.min_by(F.struct("application_number", "decision"), "row_idx")
    return (
        decisions.select(key.alias("key"), "row_idx", "application_number", "decision")
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(first.alias("d"))
        .select("key", "d.*")
    )


def neighbours(asked: DataFrame, decided: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """For each distinct asked number, the nearest decided numbers strictly ``before`` and ``after`` it.

    Both inputs have a BIGINT ``number``. They are range-partitioned on the number and reduced to one row per number
    in place (the range partitioning serves the aggregate too), so a partition's size depends on how many distinct
    numbers it spans, not on how often a number occurs. Each sorted partition finds its rows' neighbours in one pass
    and is written once with its first and last decided number; a neighbour in another partition is carried over from
    that table, one row per partition, so no task sees all numbers. ``bucket`` is kept for callers and not used.
    """
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    from stayline.session import stage

    merged = (
        decided.select("number", F.lit(1).alias("known"), F.lit(0).alias("asked"))
        .unionByName(asked.select("number", F.lit(0).alias("known"), F.lit(1).alias("asked")))
        .where(F.col("number").isNotNull())
        .repartitionByRange("number")
        .groupBy("number")
        .agg(F.max("known").alias("known"), F.max("asked").alias("asked"))
        .sortWithinPartitions("number")
    )

    def fill(batches):
        parts = [b for b in batches if b.num_rows]
        part = TaskContext.get().partitionId()
        if not parts:
            return
        number = np.concatenate([b.column("number").to_numpy() for b in parts])
        known = np.concatenate([b.column("known").to_numpy() for b in parts]) == 1
        asked_rows = np.concatenate([b.column("asked").to_numpy() for b in parts]) == 1
        at = np.arange(len(number))
        last = np.maximum.accumulate(np.where(known, at, -1))
        before = np.concatenate([[-1], last[:-1]])
        first = np.minimum.accumulate(np.where(known, at, len(number))[::-1])[::-1]
        after = np.concatenate([first[1:], [len(number)]])
        take = lambda where, ok: pa.array(np.where(ok, number[np.clip(where, 0, len(number) - 1)], 0), mask=~ok)
        keep = asked_rows | (at == np.argmax(known)) | (at == len(number) - 1 - np.argmax(known[::-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(keep.sum(), part, np.int32)), pa.array(number[keep]), pa.array(known[keep]), pa.array(asked_rows[keep]),
             take(before, before >= 0).filter(pa.array(keep)), take(after, after < len(number)).filter(pa.array(keep))],
            ["part", "number", "known", "asked", "before", "after"],
        )

    filled = stage(merged.mapInArrow(fill, "part int, number long, known boolean, asked boolean, before long, after long"), "nearest")
    edges = filled.where("known").groupBy("part").agg(F.min("number").alias("low"), F.max("number").alias("high")).orderBy("part").collect()
    carry, below = [], None  # at most one row per partition
    for row in edges:
        carry.append([row["part"], below, None])
        below = row["high"]
    above = None
    for entry, row in zip(reversed(carry), reversed(edges), strict=True):
        entry[2] = above
        above = row["low"]
    spark = asked.sparkSession
    parts = filled.select("part").distinct().collect()  # one row per partition
    listed = {c[0] for c in carry}
    for row in parts:  # partitions without a decided number take the carry of the nearest ones around them
        if row["part"] not in listed:
            lower = max((e for e in edges if e["part"] < row["part"]), key=lambda e: e["part"], default=None)
            upper = min((e for e in edges if e["part"] > row["part"]), key=lambda e: e["part"], default=None)
            carry.append([row["part"], lower["high"] if lower else None, upper["low"] if upper else None])
    edge_table = spark.createDataFrame(carry, "part int, below long, above long")
    return filled.where("asked").join(F.broadcast(edge_table), "part", "left").select(
        "number", F.coalesce("before", "below").alias("before"), F.coalesce("after", "above").alias("after")
    )


def exact_matches(searches: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every searched text with its check and the decision of exactly that number.

    A rejected text has no number; it is given a key of its own, which matches nothing, so that such texts
    do not all meet on one missing key.
    """
    checked = with_number_check(searches, "raw").drop("error_msg")
    own_key = F.when(F.col("ok"), F.col("number")).otherwise(F.concat(F.lit("~"), F.col("search_id")))
    known = first_rows(decisions, normalise_number(F.col("application_number")))
    matched = F.col("application_number").isNotNull()
    status = F.when(~F.col("ok"), "invalid").when(matched, "found").otherwise("not_found")
    return (
        checked.withColumn("key", own_key)
        .join(known, "key", "left")
        .select(
            "search_id",
            "raw",
            "number",
            status.alias("status"),
            "error_code",
            "application_number",
            "decision",
            F.when(matched, decision_class(F.col("decision"))).alias("decision_class"),
        )
    )


def nearest_matches(searches: DataFrame, decisions: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Up to two rows, Before and After, per valid search whose number has no decision."""
    text = normalise_number(F.col("application_number"))
    known = decisions.select(text.alias("number")).where(F.length("number") == DIGITS)
    misses = (
        with_number_check(searches, "raw")
        .where("ok")
        .select("search_id", "number")
        .join(known, "number", "left_anti")
        .withColumn("key", F.col("number").cast("bigint"))
    )
    rows = first_rows(decisions, as_integer(F.col("application_number")))
    near = neighbours(misses.select(F.col("key").alias("number")), rows.select(F.col("key").alias("number")), bucket)
    sides = F.array(
        F.struct(F.lit("Before").alias("nearest_application"), F.col("before").alias("key")),
        F.struct(F.lit("After").alias("nearest_application"), F.col("after").alias("key")),
    )
    named = (
        near.select(F.col("number").alias("asked"), F.inline(sides))
        .join(rows, "key")
        .withColumn("difference", F.abs(F.col("asked") - F.col("key")))
        .drop("key")
    )
    return misses.join(named, F.col("key") == F.col("asked")).select(
        "search_id", "number", "nearest_application", "application_number", "decision", "difference"
    )
