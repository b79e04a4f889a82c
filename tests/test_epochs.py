"""Micro-batches framed like recordings, against the batch form of all segments."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluiceway import schemas
from sluiceway.operators.delivery import run_folder
from sluiceway.operators.frames import reassemble_frames
from sluiceway.sources.tables import read_segments
from sluiceway.streaming.epochs import frame_epoch, reassemble_epochs
from sluiceway.streaming.versions import Versions
from test_blocks import pack

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def traffic(rnd):
    """Requests, large values over many segments, numbers, a fault, a cut-off value, a missing segment, a late start."""
    request = lambda k: pack(["tag", [[k, {"k": "v" * rnd.randint(0, 30)}]], {"chunk": str(k)}])
    many = b"".join(request(k) for k in range(120))
    data = {1: many, 2: pack(b"x" * 3000) + many[:500] + pack([b"y" * 2500]), 3: b"\x05" * 90, 4: request(1) + request(2) + b"\xc1" + many,
            5: many[:333], 6: many, 7: b"", 8: pack("z" * 900) * 3}
    rows = []
    for conn, stream in data.items():
        cuts = sorted(rnd.sample(range(1, len(stream)), min(len(stream) - 1, 60))) if stream else []
        rows += [(conn, f"10.0.0.{conn}", i, T0 + dt.timedelta(seconds=conn * 1000 + i), stream[a:b])
                 for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(stream)])) if (conn, i) != (6, 17)]
    return rows


def table(df):
    return sorted((r.conn_id, r.frame_no, r.error_class or "", bytes(r.frame or b""), r.size or 0, r.recv_ts, r.remote_addr) for r in df.collect())


@pytest.mark.parametrize("limit, ordered, size", [(None, False, 6), (700, True, 10 ** 6)])
def test_epochs_give_what_the_recording_gives(spark, tmp_path, limit, ordered, size):
    rnd = random.Random(size)
    rows = traffic(rnd)
    rows += rnd.sample(rows, 20)        # read twice
    rows.sort(key=lambda r: r[2] + rnd.random() * (3 if ordered else 200))
    state, waiting = Versions(spark, f"{tmp_path}/s", "conn_id BIGINT, remote_addr STRING, next_seq BIGINT, frame_no BIGINT, dead BOOLEAN, "
                              "last_ts TIMESTAMP, held BINARY, held_ts TIMESTAMP"), Versions(spark, f"{tmp_path}/w", schemas.SEGMENTS)
    got, epochs = [], 3
    for epoch in range(epochs):
        batch = spark.createDataFrame(rows[epoch * len(rows) // epochs:(epoch + 1) * len(rows) // epochs], schemas.SEGMENTS)
        runs = [table(frame_epoch(spark, batch, state, waiting, epoch, f"{tmp_path}/f{epoch}", max_chunk_bytes=limit, block_segments=size))
                for _ in range(2 if epoch == 1 else 1)]
        assert runs[0] == runs[-1]      # run again, as after a failure
        got += runs[0]
    whole = table(reassemble_frames(spark.createDataFrame(rows, schemas.SEGMENTS), limit))
    ends = {r[0]: r[3] for r in whole if r[2] in ("INCOMPLETE", "SEQUENCE_GAP")}
    assert sorted(got) == [r for r in whole if r[2] not in ("INCOMPLETE", "SEQUENCE_GAP")]
    last = {r.conn_id: r for r in state.latest().collect()}
    assert {c: bytes(r.held) for c, r in last.items() if r.held or c == 6} == ends and set(ends) >= {6}
    assert last[6].next_seq == 17 and {c for c, r in last.items() if r.dead} == {r[0] for r in got if r[2]} >= {4}
    assert {r.conn_id for r in waiting.latest().collect()} == {6}


def test_a_hot_connection_of_a_stream_is_framed_by_many_tasks(spark, tmp_path):
    """One connection holds most of each micro-batch; a query stopped and started again goes on."""
    payload = F.unhex(F.lit(pack(["tag", [[1, {"a": "b" * 50}]], {"chunk": "c"}]).hex()))
    segments = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, F.lit(1)).otherwise(F.col("id") + 10).cast("bigint").alias("conn_id"),
        F.lit("10.0.0.1").alias("remote_addr"), F.when(F.col("id") % 3 < 2, F.expr("id div 3 * 2 + id % 3")).otherwise(0).alias("seq"),
        F.timestamp_seconds("id").alias("recv_ts"), payload.alias("payload"))
    tasks = []

    def sink(frames, epoch):
        read = frames.sparkSession.read.parquet(next(f for f in frames.inputFiles() if "/framed/" in f).rsplit("/part-", 1)[0])
        tasks.append(read.where("conn_id = 1 AND error_class IS NULL").select(F.input_file_name()).distinct().count())
        frames.write.mode("overwrite").parquet(run_folder(frames, f"{tmp_path}/out", epoch))

    for part in range(2):
        segments.where(f"recv_ts >= timestamp_seconds({part * 3000}) AND recv_ts < timestamp_seconds({part * 3000 + 3000})").coalesce(1).write.mode(
            "append").parquet(f"{tmp_path}/in")
        reassemble_epochs(read_segments(spark, f"{tmp_path}/in", stream=True, files_per_trigger=1), sink, f"{tmp_path}/state",
                          f"{tmp_path}/check", block_bytes=10_000, available_now=True).awaitTermination(200)
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.where("conn_id = 1").agg(F.count("*"), F.max("frame_no"), F.count_distinct("frame_no")).first() == (4000, 3999, 4000)
    assert found.where("conn_id > 1").count() == 2000 and found.where("error_class IS NOT NULL").count() == 0
    assert len(tasks) == 2 and min(tasks) >= 5
