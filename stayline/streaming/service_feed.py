"""Running visit and cancellation counts from a live service feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_visits(feed: DataFrame, width: str = "30 days", lateness: str = "10 days") -> DataFrame:
    """Visits, cancellations and billed amount per dealer and window; repeats of an id within the lateness count once.

    ``feed`` has a timestamp ``ts``. Works on a stream and on a table alike.
    """
    unique = feed.withWatermark("ts", lateness)
    if feed.isStreaming:
        unique = unique.dropDuplicatesWithinWatermark(["smr_id"])
    else:
        unique = unique.dropDuplicates(["smr_id"])
    return (
        unique.groupBy(F.window("ts", width).alias("w"), "dealer_id")
        .agg(
            F.count("*").alias("visits"),
            F.count_if(F.col("status") == "Cancelled").alias("cancelled"),
            F.sum("bill_amount").alias("billed"),
        )
        .select(
            F.col("w.start").cast("date").alias("window_start"),
            F.col("w.end").cast("date").alias("window_end"),
            "dealer_id",
            "visits",
            "cancelled",
            "billed",
        )
    )


def open_windows(feed: DataFrame, closed: DataFrame) -> DataFrame:
    """The windows that the stream hasn't delivered yet, from the same events as a table.

    The watermark closes windows in order of time, so only events from the end of the last delivered one on are read.
    """
    last = closed.agg(F.max("window_end")).first()[0]
    late = feed if last is None else feed.where(F.col("ts") >= F.lit(last).cast("timestamp"))
    return windowed_visits(late).join(closed, ["window_start", "dealer_id"], "left_anti")


def run(feed: DataFrame, table_path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append every window once it is closed by the watermark; ``open_windows`` has the others."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        windowed_visits(feed)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
