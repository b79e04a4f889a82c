"""Frames -> requests, events, heartbeats and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluiceway import schemas
from sluiceway.functions.requests import decode_batches

HEARTBEAT = b"\xc0"     # Fixed value: nil


def decode(frames: DataFrame) -> DataFrame:
    """One row per frame, told apart by `kind`: 'request', 'heartbeat' or 'reject'.

    The single decoding pass behind the views below. Rows stay in the task that holds
    them: no shuffle. Write this table once (say, partitioned by `kind`) when more than
    one of its views is needed.
    """
    if "error_class" not in frames.columns:
        frames = frames.withColumns({
            "error_class": F.lit(None).cast("string"), "detail": F.lit(None).cast("string")})
    columns = [c.split()[0] for c in schemas.FRAMES.split(", ")]
    return frames.select(*columns).mapInArrow(decode_batches, schemas.DECODED)


def requests_of(decoded: DataFrame) -> DataFrame:
    return decoded.where("kind = 'request'").select(
        "conn_id", "remote_addr", "frame_no", "recv_ts", "mode", "tag", "entries", "chunk",
        "compressed")


def rejects_of(decoded: DataFrame) -> DataFrame:
    return decoded.where("kind = 'reject'").select(
        "conn_id", "frame_no", "recv_ts", "error_class", "detail", "frame")


def decode_requests(frames: DataFrame) -> DataFrame:
    """Requests in all three modes; a request with one bad entry is not among them."""
    return requests_of(decode(frames))


def rejects(frames: DataFrame) -> DataFrame:
    """Framing faults and undecodable frames, with the reason and the bytes."""
    return rejects_of(decode(frames))


def heartbeats(frames: DataFrame) -> DataFrame:
    """Nil frames: recognised, never delivered and never acknowledged."""
    return frames.where(F.col("frame") == F.lit(HEARTBEAT)).select(
        "conn_id", "remote_addr", "frame_no", "recv_ts")


def heartbeat_counts(frames: DataFrame) -> DataFrame:
    return heartbeats(frames).groupBy("conn_id").agg(
        F.count("*").alias("heartbeats"), F.min("recv_ts").alias("first_ts"),
        F.max("recv_ts").alias("last_ts"))


def explode_events(requests: DataFrame) -> DataFrame:
    """One row per entry; `pos` keeps the order inside the request."""
    return requests.select(
        "conn_id", "frame_no", "tag", "chunk", F.posexplode("entries").alias("pos", "e")
    ).select(
        "conn_id", "frame_no", "pos", "tag", "e.time_sec", "e.time_nanos", "e.event_ts",
        "e.record", "e.record_raw", "chunk")
