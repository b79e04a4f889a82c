"""Delivery to user code, acknowledgements and redelivery."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from sluiceway.functions.packing import hex_bytes, pack_str
from sluiceway.functions.times import instant_text
from sluiceway.functions.wire import sent_text
from sluiceway.session import shared_folder

KEYS = ["conn_id", "frame_no"]

Delivery = Callable[[DataFrame, int], "DataFrame | None"]


def acks(requests: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """`{"ack": chunk}` for each request that has a chunk and did not fail."""
    done = requests.where("chunk IS NOT NULL")
    if failed is not None:
        done = done.join(failed.select(*KEYS), KEYS, "left_anti")
    return done.select(
        *KEYS, "chunk",
        F.to_json(F.struct(F.col("chunk").alias("ack"))).alias("ack_json"),
        # Fixed value: a map of one entry, then its key.
        F.concat(hex_bytes("81"), pack_str(F.lit("ack")), pack_str("chunk")).alias("ack_bytes"))


def unacked(requests: DataFrame, acked: DataFrame, after: str = "10 minutes",
            late: str = "1 hour") -> DataFrame:
    """Requests a sender would send again: they have a chunk and got no ack.

    A batch looks at all acks. On streams a request is unacked if no ack has an `acked_ts` from its `recv_ts`
    to ``after`` later (both ends count); it is given once both streams have passed that time by ``late``. State holds the columns of ``requests`` for that long, so pass
    keys alone where the entries lie in a table. What comes more than ``late`` behind the rest of its own
    stream is taken as known: Spark no longer joins it.
    """
    if not requests.isStreaming:
        return requests.where("chunk IS NOT NULL").join(acked.select(*KEYS), KEYS, "left_anti")
    sent = requests.withWatermark("recv_ts", late).where("chunk IS NOT NULL")
    got = acked.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.col("acked_ts").alias("_acked_ts")).withWatermark(
        "_acked_ts", late)
    fits = (F.col("_conn_id") == F.col("conn_id")) & (F.col("_frame_no") == F.col("frame_no")) & F.expr(
        f"_acked_ts >= recv_ts AND _acked_ts <= recv_ts + INTERVAL {after}")
    return sent.join(got, fits, "left_outer").where("_conn_id IS NULL").select(*requests.columns)


def dedupe_redelivery(requests: DataFrame, within: str = "10 minutes") -> DataFrame:
    """Keep one request of those with the same chunk; without a chunk all are kept.

    Batch keeps the earliest arrival (then the lowest `conn_id`, `frame_no`) of the whole
    table; of a request recorded twice one row stays, also without a chunk. Each task first
    reduces its own rows, so a chunk repeated in a third of all rows costs no single task anything.
    A stream keeps the first it sees of each key and forgets it ``within`` of the clock after
    that; no row is ever too late. It is read once: a request without a chunk has a key of its own, held as long.
    """
    key = F.coalesce(F.concat(F.lit("c:"), F.col("chunk")), F.concat_ws(":", F.lit("f"), *KEYS))
    if requests.isStreaming:
        keyed = requests.withColumns({"_seen": F.current_timestamp(), "_key": key})
        return keyed.withWatermark("_seen", within).dropDuplicatesWithinWatermark(["_key"]).drop("_seen", "_key")
    first = F.min_by(F.struct(*requests.columns), F.struct("recv_ts", *KEYS))
    return requests.groupBy(key.alias("_key")).agg(first.alias("_first")).select("_first.*")


def query_folder(batch: DataFrame, path: str) -> str:
    """The folder of a stream's own query below ``path``, the same after a restart.

    A query on a new checkpoint has a new id, so it never writes over what another left.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/run={query or uuid.uuid4().hex}"


def run_folder(batch: DataFrame, path: str, epoch: int) -> str:
    """Where an epoch of a stream writes."""
    return f"{query_folder(batch, path)}/epoch={epoch}"


def deliver(
    requests: DataFrame,
    fn: Delivery,
    checkpoint: str | None = None,
    ack_path: str | None = None,
    available_now: bool = False,
):
    """Hand requests to ``fn(batch, epoch)``, then write acks of what succeeded.

    ``fn`` returns the keys (`conn_id`, `frame_no`) of failed requests, or None. If it
    raises, nothing of the batch is acknowledged and a stream delivers it again, so
    delivery is at least once. A stream's acks have the time they were made in `acked_ts`. Acks of an epoch replace those of an earlier try; each query and
    each batch call has a folder of its own below ``ack_path``. A batch is decoded once: ``fn`` and
    the acks read a table in the shared folder. A stream gives its StreamingQuery, a batch the ack table.
    """
    if not requests.isStreaming:
        spark = requests.sparkSession
        folder = shared_folder(spark)
        requests.write.parquet(f"{folder}/requests")
        held = spark.read.schema(requests.schema).parquet(f"{folder}/requests")
        failed = fn(held, 0)
        made = acks(held, failed)
        where = run_folder(held, ack_path or f"{folder}/acks", 0)
        made.write.parquet(where)
        return spark.read.schema(made.schema).parquet(where)

    def one_epoch(batch: DataFrame, epoch: int) -> None:
        batch.persist()     # decoded once, read by `fn` and by the acks
        try:
            failed = fn(batch, epoch)
            if ack_path:
                acks(batch, failed).withColumn("acked_ts", F.current_timestamp()).write.mode("overwrite").parquet(run_folder(batch, ack_path, epoch))
        finally:
            batch.unpersist()

    writer = requests.writeStream.foreachBatch(one_epoch)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


@F.pandas_udf(ArrayType(StringType()))
def _sent_texts(raws: pd.Series) -> pd.Series:
    return raws.map(lambda list_: None if list_ is None else [
        None if raw is None else sent_text(bytes(raw)) for raw in list_])


def render_streams(requests: DataFrame) -> DataFrame:
    """The text form of each request's event stream, keys in the order sent where the bytes are known."""
    fields = {f.name for f in requests.schema["entries"].dataType.elementType.fields}
    sent = _sent_texts(F.transform("entries", lambda e: e["record_raw"])) if "record_raw" in fields else \
        F.transform("entries", lambda e: F.lit(None).cast("string"))
    entries = F.zip_with("entries", "_sent", lambda e, text: F.concat(
        F.lit("EventEntry("), instant_text(e["time_sec"], e["time_nanos"]), F.lit(","),
        F.coalesce(text, e["record"]), F.lit(")")))
    return requests.withColumn("_sent", sent).select(*KEYS, F.concat(
        F.lit("EventStream(Tag("), F.col("tag"), F.lit("), ["),
        F.array_join(entries, ", "), F.lit("])")).alias("text"))


def print_streams(requests: DataFrame, path: str | None = None, seconds: float = 60,
                  checkpoint: str | None = None) -> None:
    """The text form of every stream, one line each: to text files below ``path``, else to the console.

    The console gets the lines one partition at a time, so the driver never holds all. A stream is stopped
    after ``seconds``; each of its epochs has a folder of its own.
    """
    text = render_streams(requests).select("text")

    def put(batch: DataFrame, folder: str | None) -> None:
        if folder:
            batch.write.mode("overwrite").text(folder)
        else:
            for row in batch.toLocalIterator():
                print(row["text"])

    if not requests.isStreaming:
        put(text, path)
        return
    writer = text.writeStream.foreachBatch(
        lambda batch, epoch: put(batch, path and run_folder(batch, path, epoch)))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    query = writer.start()
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()
