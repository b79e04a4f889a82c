"""Reassembly of a stream by micro-batches that are framed like recordings.

Where `reassemble_stream` holds what a connection has not finished as the state of one task, here
it lies in tables with a version per epoch, and each micro-batch goes through the block
framer of `reassemble_frames`. So one connection may hold a large part of a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway import schemas
from sluiceway.functions.blocks import OPEN
from sluiceway.operators.delivery import query_folder
from sluiceway.operators.frames import BLOCK_BYTES, reassemble_frames
from sluiceway.operators.joins import measured_join
from sluiceway.streaming.versions import Versions, remove

#: A connection's number of the next segment and frame, and its unfinished bytes.
_STATE = (
    "conn_id BIGINT, remote_addr STRING, next_seq BIGINT, frame_no BIGINT, dead BOOLEAN, last_ts TIMESTAMP, "
    "held BINARY, held_ts TIMESTAMP")
_COLUMNS = [c.split()[0] for c in schemas.SEGMENTS.split(", ")]


def reassemble_epochs(
    segments: DataFrame,
    sink: Callable[[DataFrame, int], None],
    path: str,
    checkpoint: str | None = None,
    max_chunk_bytes: int | None = None,
    block_bytes: int = BLOCK_BYTES,
    block_segments: int | None = None,
    available_now: bool = False,
):
    """Give ``sink(frames, epoch)`` the frames of each micro-batch; state lies below ``path``.

    All epochs together give the frames and faults that `reassemble_frames` gives for all segments, but for
    those of connections that are cut off or lack a segment, which wait. A segment that
    comes too early waits, a repeated one is read once. An epoch that is run again gives ``sink`` the same rows, so
    it has to replace what it wrote (see `run_folder`). What a value has so far is written again in each epoch
    that brings more of its connection, and carried along in the others.
    """
    def one_epoch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        state = Versions(spark, query_folder(batch, f"{path}/connections"), _STATE)
        waiting = Versions(spark, query_folder(batch, f"{path}/waiting"), schemas.SEGMENTS)
        folder = f"{query_folder(batch, f'{path}/framed')}/epoch={epoch}"
        sink(frame_epoch(
            spark, batch, state, waiting, epoch, folder,
            max_chunk_bytes=max_chunk_bytes, block_bytes=block_bytes, block_segments=block_segments), epoch)
        remove(spark, folder)

    writer = segments.select(*_COLUMNS).writeStream.foreachBatch(one_epoch)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def frame_epoch(spark: SparkSession, batch: DataFrame, state: Versions, waiting: Versions, epoch: int,
                folder: str, **options) -> DataFrame:
    """Frames of one epoch; writes the versions that the next one starts from.

    Each connection is numbered anew from what it has not finished: segment 0 holds its unfinished bytes,
    the segment it waits for is 1. The framer then sees a recording.
    """
    def table(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    came = table(batch.unionByName(waiting.before(epoch)), "came")
    active = came.groupBy("conn_id").agg(
        F.min_by("remote_addr", "seq").alias("first_addr"), F.min("recv_ts").alias("first_ts"))
    before = state.before(epoch)
    at = table(active.join(before.drop("held"), "conn_id", "left").select(
        "conn_id", F.coalesce("remote_addr", "first_addr").alias("remote_addr"),
        F.coalesce("next_seq", F.lit(0).cast("bigint")).alias("next_seq"),
        F.coalesce("frame_no", F.lit(0).cast("bigint")).alias("frame_no"),
        F.coalesce("dead", F.lit(False)).alias("dead"), "last_ts", F.coalesce("held_ts", "last_ts", "first_ts").alias("held_ts")), "at")

    alive = at.where("NOT dead")
    numbers = alive.select("conn_id", F.col("next_seq").alias("_from"))
    live = measured_join(came, numbers, ["conn_id"], "inner", ["seq"]).where("seq >= _from")
    renumbered = live.select(
        "conn_id", "remote_addr", (F.col("seq") - F.col("_from") + 1).alias("seq"), "recv_ts", "payload")
    begun = alive.join(before.select("conn_id", "held"), "conn_id", "left").select(
        "conn_id", "remote_addr", F.lit(0).cast("bigint").alias("seq"), F.col("held_ts").alias("recv_ts"),
        F.coalesce("held", F.lit(b"")).alias("payload"))
    framed = table(reassemble_frames(table(renumbered.unionByName(begun), "read"), goes_on=True, **options), "framed")

    is_open = F.coalesce(F.col("error_class") == OPEN, F.lit(False))
    stands = F.from_json("detail", "next_seq BIGINT, began_us BIGINT")
    ends = framed.where(F.col("error_class").isNotNull()).select(
        "conn_id", F.col("frame_no").alias("_frames"), (~is_open).alias("_failed"), F.col("frame").alias("_held"),
        F.when(is_open, stands["next_seq"]).alias("_reached"), F.timestamp_micros(stands["began_us"]).alias("_began"),
        F.col("recv_ts").alias("_last"))
    moved = alive.join(ends, "conn_id").select(
        "conn_id", "remote_addr", (F.col("next_seq") + F.coalesce("_reached", F.lit(1)) - 1).alias("next_seq"),
        (F.col("frame_no") + F.col("_frames")).alias("frame_no"), F.col("_failed").alias("dead"),
        F.when(F.col("_reached") > 1, F.col("_last")).otherwise(F.col("last_ts")).alias("last_ts"),
        F.when(~F.col("_failed"), F.col("_held")).alias("held"), F.when(~F.col("_failed"), F.col("_began")).alias("held_ts"))
    state.write(before.join(moved.select("conn_id"), "conn_id", "left_anti").unionByName(moved), epoch)
    now = spark.read.schema(state.schema).parquet(f"{state.folder}/epoch={epoch}")
    reached = now.where("NOT dead").join(active.select("conn_id"), "conn_id", "left_semi").select(
        "conn_id", F.col("next_seq").alias("_from"))
    waiting.write(measured_join(came, reached, ["conn_id"], "inner", ["seq"]).where("seq >= _from"), epoch)

    base = alive.select("conn_id", F.col("frame_no").alias("_base"))
    return measured_join(framed.where(~is_open), base, ["conn_id"], "inner", ["frame_no"]).select(
        "conn_id", "remote_addr", (F.col("frame_no") + F.col("_base")).alias("frame_no"), "recv_ts", "size", "frame",
        "error_class", "detail")
