"""From segments to tables in one decoding pass."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators.frames import reassemble_frames
from sluiceway.operators.requests import decode, rejects_of, requests_of
from sluiceway.operators.streams import with_counts
from sluiceway.streaming.reassemble import reassemble_stream


class Ingested(NamedTuple):
    requests: DataFrame
    rejects: DataFrame
    heartbeats: DataFrame
    counts: DataFrame       # requests without their entries, as `throughput` and `tag_totals` take them


def views(spark: SparkSession, path: str) -> Ingested:
    """Views of a decoded table; each reads only the folders of its kind."""
    decoded = spark.read.parquet(path)
    return Ingested(
        requests_of(decoded), rejects_of(decoded),
        decoded.where("kind = 'heartbeat'").select("conn_id", "remote_addr", "frame_no", "recv_ts"),
        decoded.where("kind = 'request'").select(
            "conn_id", "frame_no", "recv_ts", "tag", "n_entries", "first_time", "last_time"))


def ingest(segments: DataFrame, path: str, max_chunk_bytes: int | None = None,
           mode: str = "errorifexists") -> Ingested:
    """Decode recorded segments once into a table partitioned by `kind`.

    Counts and times of each request lie beside its entries, in narrow columns that are read alone.
    """
    with_counts(decode(reassemble_frames(segments, max_chunk_bytes))).write.mode(mode).partitionBy("kind").parquet(path)
    return views(segments.sparkSession, path)


def ingest_stream(segments: DataFrame, path: str, checkpoint: str,
                  max_chunk_bytes: int | None = None, idle: str | None = "10 minutes",
                  available_now: bool = False):
    """The same for a stream; the file sink commits each micro-batch exactly once.

    ``available_now`` reads what is there and ends; it reports no idle connections.
    """
    idle = None if available_now else idle
    decoded = with_counts(decode(reassemble_stream(segments, max_chunk_bytes, idle)))
    writer = (
        decoded.writeStream.format("parquet").outputMode("append").partitionBy("kind")
        .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
