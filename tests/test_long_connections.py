"""Blocks of long connections: equal in bytes, in few rounds, with offsets of their own."""

import datetime as dt
import mmap
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway import schemas
from sluiceway.functions import blocks
from sluiceway.operators import frames as fr
from sluiceway.operators.frames import reassemble_frames
from test_blocks import pack

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def repeated(spark, conn, n, payload):
    """`n` segments with the same bytes."""
    return spark.range(n).select(
        F.lit(conn).cast("bigint").alias("conn_id"), F.lit("10.0.0.1").alias("remote_addr"), F.col("id").alias("seq"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("recv_ts"), payload.alias("payload"))


def raw(data: bytes):
    return F.unhex(F.lit(data.hex()))


def test_blocks_weigh_the_same_for_small_and_large_segments(spark):
    large, small, size = 256 << 10, 40, 1 << 20
    segments = repeated(spark, 7, 40, F.encode(F.repeat(F.lit("x"), large), "UTF-8")).unionByName(
        repeated(spark, -3, 60_000, raw(b"y" * small))).unionByName(
        repeated(spark, 5, 300, raw(b"z"))).unionByName(repeated(spark, 9, 2, raw(b"z")))
    weight = F.octet_length("payload") + fr.SEGMENT_BYTES
    block = fr._block_of(segments, weight, size, fr.LONG_SEGMENTS // 16)
    rows = segments.select("conn_id", block.alias("block"), "seq", weight.alias("w")).groupBy("conn_id", "block").agg(
        F.sum("w").alias("w"), F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("conn_id", "block").collect()
    assert {(r.conn_id, r.block) for r in rows if r.conn_id in (5, 9)} == {(5, 0), (9, 0)}
    for conn, most in ((7, large), (-3, small)):
        mine = [r for r in rows if r.conn_id == conn]
        assert all(r.hi - r.lo + 1 == r.n for r in mine)
        assert [r.block for r in mine] == list(range(mine[0].block, mine[0].block + len(mine))) and mine[0].block > 0
        assert all(abs(r.w - size) <= most + fr.SEGMENT_BYTES for r in mine[1:-1]) and len(mine) >= 6


def test_more_blocks_than_may_be_make_blocks_grow(spark, monkeypatch):
    monkeypatch.setattr(fr, "MOST_BLOCKS", 10)
    segments = repeated(spark, 1, 1000, raw(b"\x05")).unionByName(repeated(spark, 2, 60, raw(b"\x05")))
    block = fr._block_of(segments, F.lit(1), 2, 2)
    assert segments.select(block.alias("b")).distinct().count() in (10, 11, 12)
    found = reassemble_frames(segments, block_segments=2)
    assert found.groupBy("conn_id").count().orderBy("conn_id").collect() == [(1, 1000), (2, 60)]


def test_no_offset_wraps():
    """Values that lie beyond 2 ** 31 in their block; the pages of the map are never all touched."""
    size = (1 << 31) + (1 << 20)
    data = mmap.mmap(-1, size)
    data[size - 6:] = b"second"
    data[:5] = b"first"
    bounds = np.array([0, 5, size - 6 - (1 << 27), size - 6, size], dtype=np.int64)
    block = blocks.Block(1, "a", 1, 0, None, data, np.array([size]), np.array([9]), 9, False)
    cuts = list(blocks.batch_ranges(bounds))
    assert [x for x in cuts] == [(0, 1), (1, 2), (2, 3), (3, 4)]
    for lo, hi, want, no in ((0, 1, b"first", 10), (3, 4, b"second", 13)):
        (row,) = blocks._frame_batch(block, bounds[lo:hi + 1], 10 + lo).to_pylist()
        assert (row["frame"], row["frame_no"], row["size"]) == (want, no, len(want))
    many = np.arange(0, 10_001, 10, dtype=np.int64)
    assert [hi - lo for lo, hi in blocks.batch_ranges(many, 95)] == [9] * 111 + [1]
    assert list(blocks.batch_ranges(np.array([3]))) == []
    scan = blocks.scan_values(b"".join([pack("abc")] * 3), 0, None)
    small = blocks.Block(1, "a", 1, 0, None, pack("abc") * 3, np.array([12]), np.array([9]), 9, False)
    assert [r["frame"] for b in blocks._frame_batches(small, scan, 0) for r in b.to_pylist()] == [pack("abc")] * 3


def jobs_of(spark, name, make):
    """Jobs that reading the frames takes, and their number per connection."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        counts = make().where("error_class IS NULL").groupBy("conn_id").agg(
            F.count("*").alias("n"), F.max("frame_no").alias("last")).collect()
        return len(context.statusTracker().getJobIdsForGroup(name)), counts
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_a_hundred_thousand_blocks_take_as_many_jobs_as_a_few(spark):
    payload = raw(pack(["tag", [[1, {"a": 1}]], {"chunk": "c"}]))
    took = []
    for n in (500, 100_000):
        jobs, counts = jobs_of(spark, f"blocks-{n}", lambda: reassemble_frames(repeated(spark, 1, n, payload), block_segments=1))
        assert counts == [(1, n, n - 1)]
        took.append(jobs)
    assert took[1] <= took[0] + 3


def test_rounds_follow_the_logarithm_where_no_guess_is_possible(spark, monkeypatch):
    """A connection of bare numbers, each cut by segment borders: every block has to follow the one before it."""
    number, rounds, chains = pack(1 << 40), [], fr.chains
    monkeypatch.setattr(fr, "chains", lambda wrong, turn: rounds.append(turn) or chains(wrong, turn))
    for n in (32, 300):
        rounds.clear()
        first, later = F.col("seq") == 0, F.col("seq") * 9 + 5      # the first segment has half a number more
        piece = F.when(first, F.substring(raw(number * 2), 1, 13)).otherwise(
            F.substring(raw(number * n), later.cast("int"), F.lit(9)))
        segments = repeated(spark, 1, n, raw(b"")).withColumn("payload", piece)
        counts = reassemble_frames(segments, block_segments=1).where("error_class IS NULL").groupBy("conn_id").agg(
            F.count("*").alias("n"), F.max("frame_no").alias("last")).collect()
        assert counts == [(1, n, n - 1)]
        assert rounds == list(range(len(rounds))) and len(rounds) <= n.bit_length() + 1


def test_the_payload_is_shuffled_once_by_block(spark):
    segments = repeated(spark, 1, 2000, raw(pack("x"))).unionByName(repeated(spark, 2, 3, raw(pack("x"))))
    text = reassemble_frames(segments, block_segments=500)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(conn_id#\d+L, block#\d+L, 8\), REPARTITION_BY_NUM", text)) == 1
    assert "ArrowEvalPython [block_of(" in text and "NestedLoop" not in text


@pytest.mark.parametrize("missing", [0, 3, 700, 701, 1999])
def test_gaps_end_a_long_connection(spark, missing):
    payload = raw(pack("x"))
    segments = repeated(spark, 1, 2000, payload).where(F.col("seq") != missing)
    rows = reassemble_frames(segments, block_segments=100).where("frame_no >= 0").agg(
        F.count_if(F.col("error_class").isNull()).alias("n"), F.max("error_class").alias("e")).first()
    assert tuple(rows) == (missing, None if missing == 1999 else "SEQUENCE_GAP")
    twice = repeated(spark, 1, 2000, payload).unionByName(repeated(spark, 1, 2000, payload))
    if missing == 0:
        assert reassemble_frames(twice, block_segments=100).groupBy("error_class").count().collect() == [(None, 2000)]
