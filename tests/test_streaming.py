"""Streams: state between micro-batches, closing, delivery after a failure."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from sluiceway import schemas
from sluiceway.operators.delivery import dedupe_redelivery, deliver, print_streams
from sluiceway.operators.frames import reassemble_frames
from sluiceway.operators.requests import decode_requests
from sluiceway.plans.ingest import ingest_stream
from sluiceway.sources.tables import epoch_sink, read_segments, write_events
from sluiceway.streaming.rates import latest_rates, throughput_to_table
from sluiceway.operators.requests import explode_events
from sluiceway.streaming.reassemble import _FRESH, _advance, reassemble_stream
from test_blocks import frames_of, pack, request, result, segment_rows, values

import pandas as pd
from hypothesis import given, settings, strategies as st

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@given(st.lists(st.one_of(values, request), min_size=1, max_size=12), st.data())
@settings(max_examples=250, deadline=None)
def test_any_order_of_arrival_gives_the_batch_result(items, data):
    stream = b"".join(pack(v) for v in items) + data.draw(st.sampled_from([b"", b"\xc1", b"\x92"]))
    limit = data.draw(st.sampled_from([None, 40]))
    rows = segment_rows(1, stream, data.draw(st.lists(st.integers(0, len(stream)), max_size=15)), 10 ** 6)
    want = [r for r in result(frames_of(rows, 10 ** 6, limit)) if r[2] != "INCOMPLETE"]
    order = data.draw(st.permutations(rows))
    state, got = _FRESH, []
    while order:
        n = data.draw(st.integers(1, len(order)))
        part, order = order[:n], order[n:]
        out, state = _advance(1, state, [pd.DataFrame(part)], limit)
        got += out
    utc = lambda us: dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=us)
    got = sorted(((c, n, e or "", f, s, utc(us), d, a) for c, a, n, us, s, f, e, d in got), key=lambda r: r[:3])
    if limit is None:
        assert got == want
    else:       # a value may be refused before its last byte comes; the batch agrees at the end
        assert [g[:3] for g in got] == [w[:3] for w in want]


def put(spark, path, *rows):
    spark.createDataFrame(
        [(c, "10.0.0.1", s, T0 + dt.timedelta(seconds=s), p) for c, s, p in rows], schemas.SEGMENTS
    ).coalesce(1).write.mode("append").parquet(path)


def drain(frames, path, checkpoint):
    frames.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination(120)


def test_a_value_over_two_runs(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    raw = pack("123456789")
    put(spark, source, (1, 0, raw[:4]), (2, 1, raw), (2, 3, raw))
    frames = reassemble_stream(read_segments(spark, source, stream=True))
    drain(frames, out, check)
    assert spark.read.schema(schemas.FRAMES).parquet(out).count() == 0
    put(spark, source, (1, 1, raw[4:]), (2, 0, raw))
    drain(frames, out, check)       # a new query on the old checkpoint
    rows = spark.read.parquet(out).orderBy("conn_id", "frame_no").collect()
    assert [(r.conn_id, r.frame_no, bytes(r.frame)) for r in rows] == [(1, 0, raw), (2, 0, raw), (2, 1, raw)]


def test_idle_connections_are_closed(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(spark, source, (1, 0, b"\x92\x01"), (2, 1, b"\x01"), (3, 0, b"\x05"))
    frames = reassemble_stream(read_segments(spark, source, stream=True), idle="1 second")
    query = frames.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", check).trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            time.sleep(1)
            rows = spark.read.schema(schemas.FRAMES).parquet(out).collect()
            if len(rows) >= 3:
                break
    finally:
        query.stop()
    assert {(r.conn_id, r.error_class) for r in rows} == {(1, "INCOMPLETE"), (2, "SEQUENCE_GAP"), (3, None)}


def test_delivery_is_repeated_after_a_failure_and_events_are_written_once(spark, tmp_path):
    source, events, ack, check = (str(tmp_path / n) for n in ("in", "events", "acks", "check"))
    frame = lambda i: pack(["t", [[i + 1, {"i": i}]] * 2, {"chunk": str(i)}])
    put(spark, source, *[(1, i, frame(i)) for i in range(10)])
    requests = decode_requests(reassemble_stream(read_segments(spark, source, stream=True)))
    sink = epoch_sink(events)

    def fails_after_writing(batch, epoch):
        sink(batch, epoch)
        raise RuntimeError("crash between the events and the acks")

    with pytest.raises(Exception):
        deliver(requests, fails_after_writing, check, ack, available_now=True).awaitTermination(120)
    put(spark, source, *[(1, i, frame(i)) for i in range(10, 12)])
    deliver(requests, sink, check, ack, available_now=True).awaitTermination(120)
    assert spark.read.parquet(events).count() == 24
    assert spark.read.parquet(events).select("record").distinct().count() == 12
    assert sorted(int(r.chunk) for r in spark.read.parquet(ack).collect()) == list(range(12))


def test_streamed_sink_and_console(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(spark, source, (1, 0, pack(["mofu", 1479042659, {"foo": "bar"}])))
    stream = lambda: decode_requests(reassemble_stream(read_segments(spark, source, stream=True)))
    write_events(explode_events(stream()), out, checkpoint=check).awaitTermination(120)
    row = spark.read.parquet(out).first()
    assert (str(row.event_date), row.tag, row.record) == ("2016-11-13", "mofu", '{"foo":"bar"}')
    print_streams(stream(), str(tmp_path / "text"), seconds=8)
    assert spark.read.text(str(tmp_path / "text")).count() == 1
    assert not spark.streams.active


def test_ingest_stream_equals_batch(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    raw = b"".join(pack(["t", i + 1, {"i": i}]) for i in range(50)) + b"\xc1"
    put(spark, source, *[(1, i, raw[i * 9:i * 9 + 9]) for i in range(len(raw) // 9 + 1)])
    ingest_stream(read_segments(spark, source, stream=True), out, check, available_now=True).awaitTermination(120)
    batch = decode_requests(reassemble_frames(read_segments(spark, source)))
    streamed = spark.read.parquet(out).where("kind = 'request'").select(*batch.columns)
    assert streamed.count() == 50 and streamed.exceptAll(batch).isEmpty()
    assert spark.read.parquet(out).where("kind = 'reject'").first().error_class == "CORRUPT_FRAME"


def test_a_connection_goes_on_after_it_was_reported_idle(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    raw = pack("123456789")
    put(spark, source, (1, 0, raw + raw[:4]), (2, 1, raw))
    frames = reassemble_stream(read_segments(spark, source, stream=True), idle="1 second")
    query = frames.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", check).trigger(processingTime="1 second").start()
    rows = lambda kind: spark.read.schema(schemas.FRAMES).parquet(out).where(kind).count()

    def wait(kind, n):
        deadline = time.time() + 60
        while rows(kind) < n and time.time() < deadline:
            time.sleep(1)

    try:
        wait("error_class IS NOT NULL", 2)
        put(spark, source, (1, 1, raw[4:]), (2, 0, raw))
        wait("error_class IS NULL", 4)
    finally:
        query.stop()
    batch = reassemble_frames(read_segments(spark, source)).where("error_class IS NULL").select("conn_id", "frame_no", "frame")
    streamed = spark.read.parquet(out).where("error_class IS NULL").select(*batch.columns)
    assert streamed.count() == 4 and streamed.exceptAll(batch).isEmpty()
    gap = spark.read.parquet(out).where("error_class = 'SEQUENCE_GAP'").first()
    assert bytes(gap.frame) == raw


def late_orders(spark, path):
    """Requests in four files, the newest first."""
    schema = "conn_id LONG, frame_no LONG, recv_ts TIMESTAMP, tag STRING, chunk STRING, entries ARRAY<STRUCT<x: INT>>"
    for part in range(4):
        rows = [(1, 100 * (3 - part) + i, T0 + dt.timedelta(hours=100 * (3 - part) + i), "t", str(i) if i % 2 else None, [(1,)])
                for i in range(100)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.1)
    return lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_rows_are_kept(spark, tmp_path):
    stream = late_orders(spark, str(tmp_path / "in"))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    dedupe_redelivery(stream()).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", check).trigger(availableNow=True).start().awaitTermination(120)
    kept = spark.read.parquet(out)
    assert kept.where("chunk IS NULL").count() == 200
    assert kept.where("chunk IS NOT NULL").count() == 50 == kept.select("chunk").distinct().where("chunk IS NOT NULL").count()
    rates, check = str(tmp_path / "rates"), str(tmp_path / "check2")
    throughput_to_table(stream(), rates, check, "1 hour", available_now=True).awaitTermination(120)
    assert sum(r.entries for r in latest_rates(spark, rates).collect()) == 400


def test_a_fresh_checkpoint_keeps_old_acks(spark, tmp_path):
    stream = late_orders(spark, str(tmp_path / "in"))
    path = str(tmp_path / "acks")
    for n in (1, 2):
        deliver(stream(), lambda batch, _: None, str(tmp_path / f"check{n}"), path, available_now=True).awaitTermination(120)
        assert spark.read.parquet(path).count() == 200 * n
