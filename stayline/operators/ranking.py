"""Dense numbering of a whole table without pulling it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.scalar import prefixed_id
from stayline.session import stage


def global_rank(df: DataFrame, order: list[Column], tie: str, name: str = "rank") -> DataFrame:
    """Number all rows 1..n by ``order`` and then ``tie``, which must be unique.

    Rows are range-partitioned on the whole sort key, so equal values of the leading columns are spread over
    many tasks. The numbered partitions are written once: their row counts then give each partition's
    offset, and the offsets table has one row per partition, which bounds what is broadcast.
    """
    keys = [*order, F.col(tie)]
    part = F.spark_partition_id()
    ranged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns(
            {"_part": part, "_pos": F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)}
        )
    )
    staged = stage(ranged, "rank")
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_part")
        .agg((F.max("_pos") + 1).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return staged.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_pos") + 1).alias(name)
    )


def surrogate_ids(df: DataFrame, key: str, seen: str, prefix: str, name: str, width: int = 12) -> DataFrame:
    """One id per distinct ``key`` in the order of its first ``seen`` value."""
    first = df.groupBy(key).agg(F.min(seen).alias("first_seen"))
    numbered = global_rank(first, [F.col("first_seen")], key, "_no")
    return numbered.select(key, "first_seen", prefixed_id(prefix, F.col("_no"), width).alias(name))


def sequence_ids(df: DataFrame, order: list[Column], tie: str, prefix: str, name: str, width: int = 12) -> DataFrame:
    """A running id for every row of a fact."""
    numbered = global_rank(df, order, tie, "_no")
    return numbered.withColumn(name, prefixed_id(prefix, F.col("_no"), width)).drop("_no")
