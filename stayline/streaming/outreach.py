"""Outreach after a cancelled visit: one row when the vehicle has no other visit within 48 hours.

The rule, on distinct events (equal ids are one event): a cancelled event at time c of a vehicle calls for outreach
if no other event of that vehicle lies in (c, c + 48 h].

As a stream the rule is event-time state (``applyInPandasWithState``). Vehicles are dealt over ``GROUPS`` groups by
their hash, and a group's vehicles are decided together, so the number of Python calls and timers doesn't grow with the
number of vehicles. A group's state holds its vehicles' cancellations not yet decided and the times of the events
that a decision may still need. A cancellation is decided once the watermark passes c + 48 h, since later events older than the
watermark are dropped; a timer at the earliest pending c + 48 h decides it even if the vehicle sends nothing more.
Events older than the watermark minus 48 hours and the allowed lateness can't matter any more and leave the state.
Repeated ids are dropped within the watermark before the state. Ids and groups' states are kept in RocksDB, on the executors' disks,
with bounded memory: in the default store all ids since the watermark are objects on the heap.

When a stream ends, cancellations the watermark hasn't passed come from the same rule as a table query
(``undecided``), so the union equals the table rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Fixed value: hours after a cancellation within which another visit makes outreach needless.
HOURS = 48
LATENESS = "2 days"
OUTPUT = "vin string, smr_id string, cancelled_at timestamp, due_at timestamp"
STATE = "pending_vin array<string>, pending_id array<string>, pending_at array<long>, seen_vin array<string>, seen_at array<long>"
#: Groups of vehicles that share a state.
GROUPS = 512
#: The state's store, its memory in an executor, and the size of its write buffers, of which each partition has some.
STORE = "spark.sql.streaming.stateStore"
STORE_CONF = {
    f"{STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{STORE}.rocksdb.maxMemoryUsageMB": "256",
    f"{STORE}.rocksdb.writeBufferSizeMB": "8",
    f"{STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


def needing_outreach(events: DataFrame) -> DataFrame:
    """The rule as a table query over events (smr_id, vin, ts, cancelled)."""
    unique = events.dropDuplicates(["smr_id"])
    seconds = F.col("ts").cast("long")
    later = Window.partitionBy("vin").orderBy(seconds).rangeBetween(1, Window.unboundedFollowing)
    nxt = unique.withColumn("next_at", F.min(seconds).over(later))
    due = F.col("ts") + F.expr(f"INTERVAL {HOURS} HOURS")
    return nxt.where(F.col("cancelled") & (F.col("next_at").isNull() | (F.col("next_at") > seconds + HOURS * 3600))).select(
        "vin", "smr_id", F.col("ts").alias("cancelled_at"), due.alias("due_at")
    )


def _followed(vin: pd.Series, at: np.ndarray, seen_vin: pd.Series, seen_at: np.ndarray, span: int) -> np.ndarray:
    """Whether an event of the same vehicle lies in (at, at + span] for each row; a missing vin is a vehicle of its own."""
    codes, _ = pd.factorize(pd.concat([vin, seen_vin], ignore_index=True), use_na_sentinel=False)
    asked, held = codes[: len(vin)], codes[len(vin) :]
    order = np.lexsort((seen_at, held))
    held, seen_at = held[order], seen_at[order]
    times = np.unique(np.concatenate((seen_at, at)))  # places of the times, so that vehicle and time fit one number
    key = held * (len(times) + 1) + np.searchsorted(times, seen_at)
    following = np.searchsorted(key, asked * (len(times) + 1) + np.searchsorted(times, at), "right")
    there = following < len(key)
    following = np.minimum(following, max(len(key) - 1, 0))
    if not len(key):
        return np.zeros(len(at), bool)
    return there & (held[following] == asked) & (seen_at[following] <= at + span)


def _decide(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    span = HOURS * 3_600_000
    pending, seen = [], []
    if state.exists:
        pending_vin, pending_id, pending_at, seen_vin, seen_at = state.get
        pending.append(pd.DataFrame({"vin": pd.Series(list(pending_vin), dtype=object), "smr_id": pd.Series(list(pending_id), dtype=object), "at": np.array(pending_at, np.int64)}))
        seen.append(pd.DataFrame({"vin": pd.Series(list(seen_vin), dtype=object), "at": np.array(seen_at, np.int64)}))
    for frame in frames:
        frame = frame[["vin", "smr_id", "cancelled"]].assign(at=frame["ts"].to_numpy().astype("datetime64[ms]").astype("int64"))
        seen.append(frame[["vin", "at"]])
        pending.append(frame.loc[frame["cancelled"].fillna(False).astype(bool), ["vin", "smr_id", "at"]])
    pending, seen = pd.concat(pending, ignore_index=True), pd.concat(seen, ignore_index=True)
    mark = state.getCurrentWatermarkMs()
    due = pending["at"].to_numpy() + span <= mark
    out = pending[due].reset_index(drop=True)
    out = out[~_followed(out["vin"], out["at"].to_numpy(), seen["vin"], seen["at"].to_numpy(), span)]
    pending, seen = pending[~due], seen[seen["at"] >= mark - span - 2 * 86_400_000]
    if len(pending) or len(seen):
        texts = lambda column: [None if v is None or v != v else v for v in column]
        state.update((texts(pending["vin"]), texts(pending["smr_id"]), pending["at"].tolist(), texts(seen["vin"]), seen["at"].tolist()))
        next_at = int(pending["at"].min()) + span if len(pending) else int(seen["at"].max()) + span + 2 * 86_400_000
        state.setTimeoutTimestamp(max(next_at, mark + 1))
    else:
        state.remove()
    if len(out):
        stamps = pd.to_datetime(out["at"].to_numpy(), unit="ms")
        yield pd.DataFrame({"vin": out["vin"].to_numpy(), "smr_id": out["smr_id"].to_numpy(), "cancelled_at": stamps, "due_at": stamps + pd.Timedelta(hours=HOURS)})


def outreach(events: DataFrame) -> DataFrame:
    """Decided outreach rows of a stream of events (smr_id, vin, ts, cancelled)."""
    unique = events.withWatermark("ts", LATENESS).dropDuplicatesWithinWatermark(["smr_id"])
    dealt = unique.withColumn("_group", F.pmod(F.xxhash64("vin"), F.lit(GROUPS)))
    return dealt.groupBy("_group").applyInPandasWithState(_decide, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run(events: DataFrame, table_path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = outreach(events).writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint)
    conf = events.sparkSession.conf
    before = {key: conf.get(key, None) for key in STORE_CONF}
    try:
        for key, value in STORE_CONF.items():
            conf.set(key, value)
        return writer.outputMode("append").trigger(**trigger).start()  # a query keeps the settings it was started with
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def undecided(events: DataFrame, delivered: DataFrame) -> DataFrame:
    """Rows of the rule that the stream hasn't delivered when it ends."""
    return needing_outreach(events).join(delivered.select("smr_id"), "smr_id", "left_anti").select("vin", "smr_id", "cancelled_at", "due_at")
