"""The stream forms of the operators, run to the end of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway import schemas
from sluiceway.operators.delivery import acks, dedupe_redelivery, deliver, unacked
from sluiceway.operators.requests import decode_requests, explode_events
from sluiceway.operators.streams import tag_totals
from sluiceway.plans import admission_queries, stream_queries, traffic, wire_queries
from sluiceway.plans.ingest import ingest, ingest_stream, views
from sluiceway.session import shared_folder
from sluiceway.sources.tables import epoch_sink, read_segments
from sluiceway.streaming.admission import Admission, admission_stream, admission_tables
from sluiceway.streaming.epochs import reassemble_epochs
from sluiceway.streaming.rates import latest_rates, throughput_to_table

FILES = 3       # micro-batches the recorded segments are spread over


def _spread(rows: DataFrame, path: str, *by: str) -> int:
    """Write rows as concurrent writers leave them, in no order; gives how many files are one of `FILES` micro-batches.

    There is a file for each core in each micro-batch, so no task of a stream holds a fixed share of all rows.
    """
    files = rows.sparkSession.sparkContext.defaultParallelism
    rows.repartition(FILES * files, *by).write.parquet(path)
    return files


def _recorded(spark: SparkSession, sf_dir: str, folder: str, hot: bool = False) -> DataFrame:
    """Segments out of order over several micro-batches, as a stream."""
    path = f"{folder}/segments"
    files = _spread(traffic.mixed_mode_segments(spark, sf_dir, hot), path, "conn_id", "seq")
    return read_segments(spark, path, stream=True, files_per_trigger=files)


def stream_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments out of order over several micro-batches, to events."""
    folder = shared_folder(spark)
    segments = _recorded(spark, sf_dir, folder)
    query = ingest_stream(segments, f"{folder}/decoded", f"{folder}/checkpoint", available_now=True)
    query.awaitTermination()
    return wire_queries.event_rows(explode_events(views(spark, f"{folder}/decoded").requests))


def stream_roundtrip_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of every micro-batch on one connection, each framed by many tasks; segments out of order."""
    folder = shared_folder(spark)
    segments = _recorded(spark, sf_dir, folder, hot=True)
    put = epoch_sink(f"{folder}/events")
    reassemble_epochs(
        segments, lambda frames, epoch: put(decode_requests(frames), epoch), f"{folder}/state", f"{folder}/checkpoint",
        block_bytes=32 << 10, available_now=True).awaitTermination()
    return wire_queries.event_rows(spark.read.parquet(f"{folder}/events"))


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests, rejects and heartbeats of one decoding pass, counted per connection."""
    segments = wire_queries.damaged_segments(spark, sf_dir)
    found = ingest(segments, f"{shared_folder(spark)}/decoded")
    count = lambda df, kind: df.groupBy("conn_id").agg(F.count("*").alias("frames")).select(
        "conn_id", F.lit(kind).alias("kind"), "frames")
    return count(found.requests, "request").unionByName(count(found.rejects, "reject"))


INGESTED_SQL = f"""
WITH {wire_queries.DAMAGED_SQL}
SELECT conn_id, kind, count(*) AS frames FROM f GROUP BY ALL"""


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the events table as a stream of requests."""
    events = traffic.table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    return stream_queries.as_event_requests(stream)


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    throughput_to_table(
        _event_stream(spark, sf_dir), f"{folder}/rates", f"{folder}/checkpoint", "1 hour",
        by_tag=True, available_now=True).awaitTermination()
    return latest_rates(spark, f"{folder}/rates").select(
        F.unix_micros("window_start").alias("window_us"), "tag", "entries")


STREAM_THROUGHPUT_SQL = """
SELECT epoch_us(ts) // 3600000000 * 3600000000 AS window_us, event_type AS tag, count(*) AS entries
FROM events GROUP BY ALL"""


def stream_throughput_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of several micro-batches, counted per hour, merged as they finish, rolled up to days."""
    folder = shared_folder(spark)
    stream_queries.event_requests(spark, sf_dir).repartition(2 * FILES, "frame_no").write.parquet(f"{folder}/requests")
    stream = spark.readStream.schema(schemas.REQUESTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/requests")
    throughput_to_table(stream, f"{folder}/rates", f"{folder}/checkpoint", "1 hour", by_tag=True,
                        available_now=True, compact=2).awaitTermination()
    return latest_rates(spark, f"{folder}/rates", "1 day").select(
        F.unix_micros("window_start").alias("window_us"), "tag", "entries")


STREAM_DAILY_SQL = """
SELECT epoch_us(ts) // 86400000000 * 86400000000 AS window_us, event_type AS tag, CAST(count(*) AS BIGINT) AS entries
FROM events GROUP BY ALL"""


def ingested_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per tag from what `ingest` has written, without reading an entry."""
    segments = traffic.recorded(traffic.mixed_mode_segments(spark, sf_dir))
    return tag_totals(ingest(segments, f"{shared_folder(spark)}/decoded").counts)


INGESTED_TOTALS_SQL = f"""
WITH e AS ({wire_queries.ROUNDTRIP_SQL})
SELECT tag, count(DISTINCT (conn_id, frame_no)) AS requests, count(*) AS entries,
  min((time_sec, time_nanos))[1] AS first_sec, min((time_sec, time_nanos))[2] AS first_nanos,
  max((time_sec, time_nanos))[1] AS last_sec, max((time_sec, time_nanos))[2] AS last_nanos
FROM e GROUP BY tag"""


def _order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = traffic.table(spark, sf_dir, "orders")
    stream = (
        spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir))
    return stream_queries.as_order_requests(stream)


def stream_deliver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acks written after user code took each micro-batch; orders in state F fail."""
    folder = shared_folder(spark)
    deliver(
        _order_stream(spark, sf_dir),
        lambda batch, _: batch.where("tag = 'F'").select("conn_id", "frame_no"),
        f"{folder}/checkpoint", f"{folder}/acks", available_now=True).awaitTermination()
    return spark.read.parquet(f"{folder}/acks").select(
        "conn_id", "frame_no", "chunk", "ack_json", F.lower(F.hex("ack_bytes")).alias("ack_bytes"))


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent twice come out once; those without a chunk keep both copies."""
    folder = shared_folder(spark)
    once = _order_stream(spark, sf_dir)
    twice = once.unionByName(_order_stream(spark, sf_dir).withColumn("conn_id", F.col("conn_id") + 1_000_000))
    query = (
        dedupe_redelivery(twice).writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/kept").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/kept").select("frame_no", "chunk")


STREAM_DEDUPE_SQL = """
SELECT o_orderkey AS frame_no, CAST(o_orderkey AS VARCHAR) AS chunk FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT o_orderkey, NULL FROM orders, (VALUES (1), (2)) WHERE o_orderkey % 7 = 0"""


#: A time past all orders, so that every one of them is decided.
_END = "TIMESTAMP '2100-01-01 00:00:00'"
_AFTER = 10     # minutes


def stream_unacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose ack comes too late or never, requests and acks each in several files.

    Every fifth order gets no ack, every third of the others one after 10 minutes to the second or a second later,
    the rest within minutes. A last row of each stream, long after, moves its time past all orders.
    """
    folder = shared_folder(spark)
    requests = stream_queries.order_requests(spark, sf_dir).select("conn_id", "frame_no", "recv_ts", "tag", "chunk")
    seconds = F.expr(f"CASE WHEN frame_no % 3 = 0 THEN {_AFTER * 60} + frame_no % 2 ELSE frame_no % 400 END")
    acked = acks(requests.where("frame_no % 5 <> 0")).join(requests.select("conn_id", "frame_no", "recv_ts"), ["conn_id", "frame_no"]).select(
        "conn_id", "frame_no", F.timestamp_micros(F.unix_micros("recv_ts") + seconds * 1_000_000).alias("acked_ts"))
    end = lambda df, at: df.limit(1).select(*[
        F.expr(_END if c == at else "-1").cast(t).alias(c) for c, t in df.dtypes])
    streams = {}
    for name, rows, at in (("requests", requests, "recv_ts"), ("acks", acked, "acked_ts")):
        rows.repartition(FILES, F.xxhash64("frame_no", F.lit(name))).write.parquet(f"{folder}/{name}")
        end(rows, at).write.mode("append").parquet(f"{folder}/{name}")
        streams[name] = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}")
    late = unacked(streams["requests"], streams["acks"], f"{_AFTER} minutes", late="10000 days")
    late.writeStream.format("parquet").option("path", f"{folder}/late").option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(late.schema).parquet(f"{folder}/late").select("conn_id", "frame_no", "chunk", "tag")


STREAM_UNACKED_SQL = """
SELECT o_custkey AS conn_id, o_orderkey AS frame_no, CAST(o_orderkey AS VARCHAR) AS chunk, o_orderstatus AS tag
FROM orders WHERE o_orderkey % 7 <> 0 AND (o_orderkey % 5 = 0 OR (o_orderkey % 3 = 0 AND o_orderkey % 2 = 1))"""


def _admitted(spark: SparkSession, sf_dir: str) -> Admission:
    """Noise, PING and requests of a connection in different micro-batches, requests before and after the PING."""
    folder = shared_folder(spark)
    frames, greeted = admission_queries.handshake_frames(spark, sf_dir)
    files = _spread(frames, f"{folder}/frames", "conn_id", "frame_no")
    stream = spark.readStream.schema(schemas.FRAMES).option("maxFilesPerTrigger", files).parquet(f"{folder}/frames")
    query = admission_stream(
        stream, greeted, admission_queries.clients(spark, sf_dir), admission_queries.users(spark, sf_dir),
        admission_queries.CLOSED, f"{folder}/admitted", f"{folder}/checkpoint", available_now=True)
    query.awaitTermination()
    return admission_tables(spark, f"{folder}/admitted", query.id)


def stream_admit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _admitted(spark, sf_dir).frames.select("conn_id", "frame_no", "size")


STREAM_ADMIT_SQL = f"""
WITH {admission_queries._VERDICT}, {admission_queries._FRAMES_SQL}
SELECT f.conn_id, frame_no, CAST(1 + 1 + length(o_orderstatus) + 1 + 1 AS BIGINT) AS size
FROM f LEFT JOIN s ON s.c = f.conn_id LEFT JOIN v ON v.c = f.conn_id
  JOIN orders ON o_orderkey = frame_no - 3 AND o_custkey = f.conn_id
WHERE NOT coalesce(secured, FALSE) OR (good AND reason IS NULL)"""


def stream_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts and PONGs of the stream, and how many frames still wait for a PING or were refused for lack of one."""
    found = _admitted(spark, sf_dir)
    refused = found.rejects.select("conn_id").unionByName(found.pending.select("conn_id")).groupBy("conn_id").agg(
        F.count("*").alias("refused"))
    return found.verdicts.where("ping_no IS NOT NULL").join(
        found.pongs.select("conn_id", "hostname", F.octet_length("pong_bytes").alias("message_bytes")), "conn_id"
    ).join(refused, "conn_id", "full").select(
        "conn_id", "client_ord", "ok", "reason", "hostname", "message_bytes",
        F.coalesce("refused", F.lit(0).cast("bigint")).alias("refused"))


STREAM_VERDICTS_SQL = f"""
WITH {admission_queries._VERDICT}, {admission_queries._FRAMES_SQL},
r AS (SELECT conn_id, count(*) AS refused FROM f JOIN s ON s.c = conn_id WHERE secured AND (NOT good OR frame_no < 2) GROUP BY 1),
p AS (
  SELECT v.c AS conn_id, client_ord, reason IS NULL AS ok, reason, CASE WHEN reason IS NULL THEN 'server-1' ELSE '' END AS hostname,
    CAST(CASE WHEN reason IS NULL THEN 1 + 5 + 1 + 1 + 9 + 130 ELSE 1 + 5 + 1 + length(reason) + 1 + 2 END AS INTEGER) AS message_bytes
  FROM v JOIN s ON s.c = v.c WHERE secured AND good)
SELECT conn_id, client_ord, ok, reason, hostname, message_bytes, coalesce(refused, 0) AS refused FROM p FULL JOIN r USING (conn_id)"""


QUERIES = {
    "ingest": (ingested, INGESTED_SQL),
    "stream_roundtrip": (stream_roundtrip, wire_queries.ROUNDTRIP_SQL),
    "stream_roundtrip_hot": (stream_roundtrip_hot, wire_queries.HOT_SQL),
    "stream_throughput": (stream_throughput, STREAM_THROUGHPUT_SQL),
    "stream_throughput_daily": (stream_throughput_daily, STREAM_DAILY_SQL),
    "ingest_totals": (ingested_totals, INGESTED_TOTALS_SQL),
    "stream_deliver": (stream_deliver, stream_queries.ACKS_SQL),
    "stream_dedupe": (stream_dedupe, STREAM_DEDUPE_SQL),
    "stream_unacked": (stream_unacked, STREAM_UNACKED_SQL),
    "stream_admit": (stream_admit, STREAM_ADMIT_SQL),
    "stream_verdicts": (stream_verdicts, STREAM_VERDICTS_SQL),
}
