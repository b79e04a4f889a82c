"""Queries that go through wire bytes: framing, decoding, rejects, heartbeats, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway.functions import packing as P
from sluiceway.functions.times import resolve_time
from sluiceway.operators.frames import reassemble_frames
from sluiceway.operators.requests import (
    decode, decode_requests, explode_events, heartbeat_counts)
from sluiceway.plans import traffic
from sluiceway.plans.traffic import CONNECTION, GROUP, epoch_micros, table

HOT_BLOCK = 60      # segments per block; not a multiple of the pieces per group
LIMIT = 8192


def event_rows(events: DataFrame) -> DataFrame:
    """The comparable columns of an events table."""
    return events.select(
        "conn_id", "frame_no", "pos", "tag", "time_sec", "time_nanos",
        F.unix_micros("event_ts").alias("event_us"), "record", "chunk")


def roundtrip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = traffic.recorded(traffic.mixed_mode_segments(spark, sf_dir))
    return event_rows(explode_events(decode_requests(reassemble_frames(segments))))


def roundtrip_hot_connection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all events on one connection, framed by many tasks."""
    segments = traffic.recorded(traffic.mixed_mode_segments(spark, sf_dir, hot=True))
    frames = reassemble_frames(segments, block_segments=HOT_BLOCK)
    return event_rows(explode_events(decode_requests(frames)))


def _roundtrip_sql(conn: str) -> str:
    return f"""
WITH e AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id // {GROUP} AS grp, (event_id // {GROUP}) % 3 AS mode,
         CAST({conn} AS BIGINT) AS conn_id
  FROM events),
f AS (SELECT *, CASE WHEN mode = 0 THEN event_id ELSE 0 END AS sub FROM e)
SELECT conn_id,
  dense_rank() OVER (PARTITION BY conn_id ORDER BY grp, event_type, sub) - 1 AS frame_no,
  CAST(row_number() OVER (PARTITION BY conn_id, grp, event_type, sub ORDER BY event_id) - 1
       AS INTEGER) AS pos,
  event_type AS tag, us // 1000000 AS time_sec,
  CAST(us % 1000000 * 1000 AS INTEGER) AS time_nanos, us AS event_us,
  '{{"event_id":' || event_id || ',"k":' || k || ',"user_id":' || user_id
    || ',"value":' || CAST(value AS VARCHAR) || '}}' AS record,
  CASE WHEN mode = 0 THEN NULL ELSE grp || '-' || event_type END AS chunk
FROM f"""


ROUNDTRIP_SQL = _roundtrip_sql(f"event_id // {CONNECTION}")
HOT_SQL = _roundtrip_sql(
    f"CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id // {CONNECTION} + 1 END")


def wire_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: everything from bytes to a count and a sum per tag."""
    events = explode_events(decode_requests(
        reassemble_frames(traffic.recorded(traffic.mixed_mode_segments(spark, sf_dir)))))
    value = F.get_json_object("record", "$.value").cast("decimal(18,2)")
    return events.groupBy("tag").agg(
        F.count("*").alias("entries"), F.sum(value).cast("double").alias("total_value"))


WIRE_TOTALS_SQL = """
SELECT event_type AS tag, count(*) AS entries,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_value
FROM events GROUP BY event_type"""


def _one_frame_each(spark: SparkSession, sf_dir: str, frame: Column) -> DataFrame:
    """Segments of connections on which every event sends ``frame``."""
    events = traffic.events_with_parts(spark, sf_dir).withColumns({
        "conn_id": F.expr(f"event_id div {CONNECTION}"),
        "grp_in_conn": F.expr(f"grp % {CONNECTION // GROUP}"),
        "time": traffic.time_bytes(), "rec": traffic.record_bytes()})
    groups = events.withColumn("frame", frame).groupBy("conn_id", "grp_in_conn").agg(
        F.min("us").alias("recv_us"),
        P.join_hex(F.transform(
            F.array_sort(F.collect_list(F.struct("event_id", "frame"))),
            lambda e: e["frame"])).alias("payload"))
    return traffic.recorded(traffic.cut(groups))


def _damaged_frame() -> Column:
    tag = P.pack_str("event_type")
    time, rec = F.col("time"), F.col("rec")
    entry = F.concat(traffic.hex_array(2), time, rec)
    arr = traffic.hex_array
    message = F.concat(arr(3), tag, time, rec)
    case = F.expr("event_id % 12")
    cut_entry = F.substring(entry, F.lit(1), F.octet_length(entry) - 1)
    damaged = (
        F.when(case == 0, P.hex_bytes("81A16101"))
        .when(case == 1, F.concat(arr(1), tag))
        .when(case == 2, F.concat(arr(3), P.pack_int(F.lit(500)), time, rec))
        .when(case == 3, F.concat(arr(3), tag, P.hex_bytes("CFFFFFFFFFFFFFFFFF"), rec))
        .when(case == 4, F.concat(arr(3), tag, time, P.hex_bytes("9101")))
        .when(case == 5, F.concat(arr(2), tag, arr(2), entry, arr(1), time))
        .when(case == 6, F.concat(arr(4), tag, time, rec, P.hex_bytes("C0")))
        .when(case == 7, F.concat(arr(2), tag, P.pack_bin(cut_entry)))
        .otherwise(message))
    broken = F.expr(
        f"event_id div {CONNECTION} % 4 = 1 AND event_id % {CONNECTION} = 1500")
    last = F.expr(f"event_id div {CONNECTION} % 4 = 2 AND event_id % {CONNECTION} = {CONNECTION - 1}")
    return (
        F.when(broken, F.concat(P.hex_bytes("C1"), damaged))
        .when(last, F.concat(damaged, P.hex_bytes("92A1"))).otherwise(damaged))


def damaged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_frame_each(spark, sf_dir, _damaged_frame())


def rejects_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(reassemble_frames(damaged_segments(spark, sf_dir)))
    return decoded.groupBy(
        "conn_id", "kind", F.coalesce("error_class", F.lit("")).alias("error_class")
    ).agg(F.count("*").alias("frames"), F.min("frame_no").alias("first_frame"))


DAMAGED_SQL = f"""
e AS (
  SELECT event_id // {CONNECTION} AS conn_id, event_id % {CONNECTION} AS n, event_id % 12 AS c
  FROM events),
alive AS (SELECT * FROM e WHERE NOT (conn_id % 4 = 1 AND n >= 1500)),
f AS (
  SELECT conn_id, n AS frame_no, CASE WHEN c < 8 THEN 'reject' ELSE 'request' END AS kind,
    CASE c WHEN 0 THEN 'NOT_ARRAY' WHEN 1 THEN 'TOO_SHORT' WHEN 2 THEN 'BAD_TAG'
           WHEN 3 THEN 'BAD_TIME' WHEN 4 THEN 'BAD_RECORD' WHEN 5 THEN 'BAD_ENTRY'
           WHEN 6 THEN 'BAD_OPTION' WHEN 7 THEN 'BAD_PACKED' ELSE '' END AS error_class
  FROM alive
  UNION ALL
  SELECT conn_id, 1500, 'reject', 'CORRUPT_FRAME' FROM e WHERE conn_id % 4 = 1 AND n = 1500
  UNION ALL
  SELECT conn_id, {CONNECTION}, 'reject', 'INCOMPLETE' FROM e
  WHERE conn_id % 4 = 2 AND n = {CONNECTION - 1})"""

REJECTS_SQL = f"""
WITH {DAMAGED_SQL}
SELECT conn_id, kind, error_class, count(*) AS frames, min(frame_no) AS first_frame
FROM f GROUP BY ALL"""


def heartbeats_by_conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat(
        traffic.hex_array(3), P.pack_str("event_type"), F.col("time"), F.col("rec"))
    beat = F.when(F.expr("event_id % 25 = 0"), F.concat(P.hex_bytes("C0"), message))
    frames = reassemble_frames(_one_frame_each(spark, sf_dir, beat.otherwise(message)))
    return heartbeat_counts(frames).select(
        "conn_id", "heartbeats", F.unix_micros("first_ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"))


HEARTBEATS_SQL = f"""
WITH g AS (
  SELECT event_id // {CONNECTION} AS conn_id, event_id // {GROUP} AS grp,
    min(epoch_us(ts)) AS us, count(*) FILTER (WHERE event_id % 25 = 0) AS beats
  FROM events GROUP BY ALL)
SELECT conn_id, CAST(sum(beats) AS BIGINT) AS heartbeats, min(us) AS first_us, max(us) AS last_us
FROM g WHERE beats > 0 GROUP BY conn_id"""


DOCS = 20       # consecutive doc ids on one connection


def _document_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is one Message request whose record is its text."""
    docs = table(spark, sf_dir, "documents")
    frame = F.concat(
        traffic.hex_array(3), P.pack_str("source"), P.pack_int(F.col("doc_id") + 1),
        P.map_header(F.lit(1)), P.pack_str(F.lit("text")), P.pack_str("text"))
    return traffic.recorded(traffic.cut(docs.select(
        F.expr(f"doc_id div {DOCS}").alias("conn_id"), F.expr(f"doc_id % {DOCS}").alias("grp_in_conn"),
        F.lit(1_700_000_000_000_000).alias("recv_us"), frame.alias("payload"))))


def documents_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts through the wire and back."""
    events = explode_events(decode_requests(
        reassemble_frames(_document_segments(spark, sf_dir))))
    text = F.from_json("record", "text STRING")["text"]
    return events.select(
        (F.col("time_sec") - 1).alias("doc_id"), "conn_id", "frame_no", "tag",
        F.length(text).cast("bigint").alias("n_chars"), F.md5(text.cast("binary")).alias("text_md5"))


DOCUMENTS_SQL = f"""
SELECT doc_id, doc_id // {DOCS} AS conn_id, doc_id % {DOCS} AS frame_no, source AS tag,
  length(text) AS n_chars, md5(text) AS text_md5
FROM documents"""


def chunk_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames up to the first that exceeds the limit; the rest of the connection is dropped."""
    frames = reassemble_frames(_document_segments(spark, sf_dir), max_chunk_bytes=LIMIT)
    return frames.select(
        "conn_id", "frame_no", "size", F.coalesce("error_class", F.lit("")).alias("error_class"))


CHUNK_LIMIT_SQL = f"""
WITH d AS (
  SELECT doc_id // {DOCS} AS conn_id, doc_id % {DOCS} AS frame_no,
    1 + 1 + strlen(source) + CASE WHEN doc_id + 1 < 128 THEN 1 ELSE 9 END + 1 + 5
      + CASE WHEN strlen(text) < 32 THEN 1 WHEN strlen(text) < 256 THEN 2
             WHEN strlen(text) < 65536 THEN 3 ELSE 5 END + strlen(text) AS size
  FROM documents),
w AS (
  SELECT *, min(CASE WHEN size > {LIMIT} THEN frame_no END) OVER (PARTITION BY conn_id) AS stop
  FROM d)
SELECT conn_id, frame_no, CASE WHEN frame_no = stop THEN NULL ELSE size END AS size,
  CASE WHEN frame_no = stop THEN 'CHUNK_TOO_LARGE' ELSE '' END AS error_class
FROM w WHERE stop IS NULL OR frame_no <= stop"""


def resolved_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as sent: zeroed, nil, one second minus one nanosecond, or carried nanoseconds."""
    case = F.expr("event_id % 10")
    us = epoch_micros("ts")
    events = table(spark, sf_dir, "events").select("event_id", us.alias("us")).select(
        "event_id", F.timestamp_micros("us").alias("recv_ts"),
        F.when(case == 0, 0).when(case == 1, 1).when(case == 2, F.lit(None))
        .when(case == 3, 0).otherwise(F.expr("us div 1000000 - 60")).cast("bigint").alias("time_sec"),
        F.when(case == 1, -1).when(case == 3, 1_500_000_000).when(case == 4, -1)
        .otherwise(F.expr("us % 1000000 * 1000")).cast("int").alias("time_nanos"))
    return resolve_time(events).select(
        "event_id", "time_sec", "time_nanos", F.unix_micros("event_ts").alias("event_us"))


RESOLVE_SQL = """
WITH e AS (
  SELECT event_id, event_id % 10 AS c, epoch_us(ts) AS us FROM events),
r AS (
  SELECT event_id,
    CASE WHEN c IN (0, 1, 2) THEN us // 1000000 WHEN c = 3 THEN 1
         WHEN c = 4 THEN us // 1000000 - 61 ELSE us // 1000000 - 60 END AS time_sec,
    CAST(CASE WHEN c = 3 THEN 500000000 WHEN c = 4 THEN 999999999
              ELSE us % 1000000 * 1000 END AS INTEGER) AS time_nanos
  FROM e)
SELECT event_id, time_sec, time_nanos, time_sec * 1000000 + time_nanos // 1000 AS event_us FROM r"""


QUERIES = {
    "wire_totals": (wire_totals, WIRE_TOTALS_SQL),
    "roundtrip_events": (roundtrip_events, ROUNDTRIP_SQL),
    "roundtrip_hot_connection": (roundtrip_hot_connection, HOT_SQL),
    "documents_roundtrip": (documents_roundtrip, DOCUMENTS_SQL),
    "chunk_limit": (chunk_limit, CHUNK_LIMIT_SQL),
    "rejects_by_class": (rejects_by_class, REJECTS_SQL),
    "heartbeats_by_conn": (heartbeats_by_conn, HEARTBEATS_SQL),
    "resolve_time": (resolved_times, RESOLVE_SQL),
}
