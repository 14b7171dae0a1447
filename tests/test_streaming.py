"""Streams: repeated refreshes, newest version, closed windows."""

import datetime as dt

from stayline.session import staged_path
from stayline.streaming import refresh, service_feed

VERSION = "application_number string, decision string, published_at timestamp, row_idx bigint"


def test_refresh_takes_each_file_once_and_keeps_the_newest(spark, rows):
    source, table, checkpoint = (staged_path(spark, n) for n in ("in", "versions", "ckpt"))
    day = lambda n: dt.datetime(2020, 1, n)

    def deliver(*data):
        spark.createDataFrame(data, VERSION).write.mode("append").parquet(source)
        stream = spark.readStream.schema(VERSION).parquet(source)
        refresh.refresh(stream, table, checkpoint).awaitTermination()

    deliver(("1", "Pending", day(1), 1), ("2", "Refused", day(2), 2))
    deliver(("1", "Approved", day(3), 1), ("2", "Pending", day(1), 9))
    versions = spark.read.parquet(table)
    assert versions.count() == 4
    assert rows(refresh.latest(versions), "application_number", "decision") == [("1", "Approved"), ("2", "Refused")]


def test_windows_ignore_repeats_and_wait_for_the_watermark(spark, rows):
    source, table, checkpoint = (staged_path(spark, n) for n in ("feed", "windows", "ckpt"))
    at = lambda n: dt.datetime(1970, 1, 1) + dt.timedelta(days=n)
    schema = "smr_id string, dealer_id string, ts timestamp, status string, bill_amount double"
    data = [("a", "D", at(1), "Completed", 5.0), ("a", "D", at(1), "Completed", 5.0), ("b", "D", at(29), "Cancelled", 7.0), ("c", "D", at(100), "Completed", 1.0)]
    spark.createDataFrame(data, schema).write.parquet(source)
    service_feed.run(spark.readStream.schema(schema).parquet(source), table, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(table), "visits", "cancelled", "billed") == [(2, 1, 12.0)]
    batch = service_feed.windowed_visits(spark.read.parquet(source))
    assert batch.count() == 2


def test_compaction_publishes_whole_versions_once(spark, rows):
    from stayline.streaming import compaction

    folder = staged_path(spark, "compacted")
    day = lambda n: dt.datetime(2020, 1, n)
    batch = lambda *data: spark.createDataFrame(data, VERSION)
    compaction.merge_batch(batch(("1", "Pending", day(1), 1), ("2", "Refused", day(2), 2)), 0, folder, parts=4)
    compaction.merge_batch(batch(("1", "Approved", day(3), 1), ("3", "Pending", day(1), 3)), 1, folder, parts=4)
    compaction.merge_batch(batch(("1", "Refused", day(2), 7)), 1, folder, parts=4)  # a replay of batch 1: nothing happens
    # batch 2 failed before its manifest: its folder is there, unpublished, and the replay writes it again
    batch(("2", "Approved", day(9), 2)).write.parquet(f"{folder}/batch-{2:012d}/part=0")
    assert compaction.manifest(spark, folder)["batch"] == 1
    compaction.merge_batch(batch(("2", "Approved", day(5), 2), ("4", "Refused", day(1), 4)), 2, folder, parts=4)
    got = compaction.current(spark, folder, VERSION)
    assert rows(got, "application_number", "decision") == [("1", "Approved"), ("2", "Approved"), ("3", "Pending"), ("4", "Refused")]
    assert got.count() == 4
    assert compaction.published(spark, folder) == [1, 2]  # older manifests are deleted, the previous one is kept
    assert compaction.manifest(spark, folder, 1)["batch"] == 1


def test_compaction_as_a_stream(spark, rows):
    from stayline.streaming import compaction

    source, folder, checkpoint = (staged_path(spark, n) for n in ("in", "compacted", "ckpt"))
    day = lambda n: dt.datetime(2020, 1, n)
    for data in ([("1", "Pending", day(1), 1), ("2", "Refused", day(2), 2)], [("1", "Approved", day(3), 1), ("2", "Pending", day(1), 9)]):
        spark.createDataFrame(data, VERSION).write.mode("append").parquet(source)
        compaction.compact(spark.readStream.schema(VERSION).parquet(source), folder, checkpoint, parts=3).awaitTermination()
    assert rows(compaction.current(spark, folder, VERSION), "application_number", "decision") == [("1", "Approved"), ("2", "Refused")]


def test_outreach_stream_equals_the_rule(spark, rows):
    from stayline.streaming import outreach

    source, table, checkpoint = (staged_path(spark, n) for n in ("events", "outreach", "ckpt"))
    schema = "smr_id string, vin string, ts timestamp, cancelled boolean"
    at = lambda d, h=0: dt.datetime(2020, 1, d, h)
    batches = [
        [("a", "V1", at(1), True), ("b", "V1", at(2), False),  # V1 came back within 48 h: no outreach
         ("c", "V2", at(1), True), ("d", "V2", at(3, 1), False),  # V2 came back after 49 h: outreach
         ("e", "V3", at(2), True)],
        [("e", "V3", at(2), True), ("f", "V3", at(3), True),  # a repeat; V3's next visit is itself cancelled
         ("g", "V4", at(4), True), ("h", "V1", at(1, 12), False)],  # h arrives late, within the lateness
        [("z", "V9", at(20), False)],  # moves the watermark past all of them
    ]
    events = []
    for data in batches:
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)
        outreach.run(spark.readStream.schema(schema).parquet(source), table, checkpoint).awaitTermination()
        events += data
    delivered = spark.read.schema(outreach.OUTPUT).parquet(table)
    every = spark.createDataFrame(events, schema)
    whole = delivered.unionByName(outreach.undecided(every, delivered))
    want = [("V2", "c"), ("V3", "f"), ("V4", "g")]
    assert rows(outreach.needing_outreach(every), "vin", "smr_id") == want
    assert rows(whole, "vin", "smr_id") == want
    assert rows(delivered, "vin", "smr_id") == want  # all three decided by the stream itself once the watermark passed
    assert rows(whole, "smr_id", "due_at") == [("c", at(3)), ("f", at(5)), ("g", at(6))]


def test_outreach_groups_hold_many_vehicles(spark, rows, monkeypatch):
    from stayline.streaming import outreach

    source, table, checkpoint = (staged_path(spark, n) for n in ("events", "outreach", "ckpt"))
    schema = "smr_id string, vin string, ts timestamp, cancelled boolean"
    at = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(hours=n)
    events = [(f"{v}-{i}", f"V{v}" if v else None, at((v * 31 + i * 29 * (1 + v % 3)) % 400), (v + i) % 2 == 0) for v in range(30) for i in range(9)]
    monkeypatch.setattr(outreach, "GROUPS", 2)
    for data in (events, [("z", "V99", at(2000), False)]):
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)
        outreach.run(spark.readStream.schema(schema).parquet(source), table, checkpoint).awaitTermination()
    delivered = spark.read.schema(outreach.OUTPUT).parquet(table)
    want = outreach.needing_outreach(spark.createDataFrame(events, schema))
    key = lambda df: sorted((r.smr_id, r.vin or "", r.cancelled_at, r.due_at) for r in df.collect())
    assert key(delivered) == key(want) and len(key(want)) > 20


def test_outreach_state_is_kept_on_disk(spark, rows):
    """Ids and states go to a store with bounded memory; the session's own store stays as it was."""
    from stayline.streaming import outreach

    source, table, checkpoint = (staged_path(spark, n) for n in ("events", "outreach", "ckpt"))
    schema = "smr_id string, vin string, ts timestamp, cancelled boolean"
    at = lambda n: dt.datetime(2020, 1, n)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    data = [("a", "V1", at(1), True), ("a", "V1", at(1), True), ("b", "V2", at(2), True), ("c", "V2", at(3), False), ("z", None, at(20), False)]
    spark.createDataFrame(data, schema).write.parquet(source)
    query = outreach.run(spark.readStream.schema(schema).parquet(source), table, checkpoint)
    query.awaitTermination()
    assert spark.conf.get(key) == before
    assert all("rocksdbGetCount" in s["customMetrics"] for p in query.recentProgress for s in p["stateOperators"])
    assert rows(spark.read.schema(outreach.OUTPUT).parquet(table), "vin", "smr_id") == [("V1", "a")]
