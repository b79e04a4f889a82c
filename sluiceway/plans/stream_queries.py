"""Queries on requests and events as tables: delivery, totals, rates, order, equality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.operators.delivery import (
    acks, dedupe_redelivery, deliver, print_streams, render_streams, unacked)
from sluiceway.operators.streams import (
    distinct_events, distinct_streams, group_streams, order_by_tag, ranked_entries,
    stream_difference, tag_totals, throughput)
from sluiceway.operators.requests import explode_events
from sluiceway.functions.times import event_ts
from sluiceway.plans.traffic import epoch_micros, epoch_micros_sql, table
from sluiceway.session import shared_folder
from sluiceway.sources.tables import write_events


def entry_struct(sec: str, nanos: str, record):
    return F.struct(
        F.expr(sec).cast("bigint").alias("time_sec"), F.expr(nanos).cast("int").alias("time_nanos"),
        event_ts(F.expr(sec).cast("bigint"), F.expr(nanos).cast("int")).alias("event_ts"),
        record.alias("record"), F.lit(None).cast("binary").alias("record_raw"))


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a request of one entry."""
    return as_event_requests(table(spark, sf_dir, "events"))


def as_event_requests(events: DataFrame) -> DataFrame:
    events = events.select(
        "event_id", "user_id", "event_type", "props", epoch_micros("ts").alias("us"))
    return events.select(
        (F.col("user_id") % 8).alias("conn_id"), F.lit(None).cast("string").alias("remote_addr"),
        F.col("event_id").alias("frame_no"), F.timestamp_micros("us").alias("recv_ts"),
        F.lit("message").alias("mode"), F.col("event_type").alias("tag"),
        F.array(entry_struct("us div 1000000", "us % 1000000 * 1000", F.col("props"))).alias("entries"),
        F.lit(None).cast("string").alias("chunk"), F.lit(None).cast("string").alias("compressed"))


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a request with its key as chunk; every 7th has no chunk."""
    return as_order_requests(table(spark, sf_dir, "orders"))


def as_order_requests(orders: DataFrame) -> DataFrame:
    orders = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", epoch_micros("o_orderdate").alias("us"))
    return orders.select(
        F.col("o_custkey").alias("conn_id"), F.lit(None).cast("string").alias("remote_addr"),
        F.col("o_orderkey").alias("frame_no"), F.timestamp_micros("us").alias("recv_ts"),
        F.lit("forward").alias("mode"), F.col("o_orderstatus").alias("tag"),
        F.array(entry_struct("us div 1000000", "0", F.to_json(F.struct("o_totalprice")))).alias("entries"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey").cast("string")).alias("chunk"),
        F.lit(None).cast("string").alias("compressed"))


def _failed(requests: DataFrame) -> DataFrame:
    return requests.where("tag = 'F'").select("conn_id", "frame_no")


def ack_rows(spark, sf_dir):
    requests = order_requests(spark, sf_dir)
    return acks(requests, _failed(requests)).withColumn(
        "ack_bytes", F.lower(F.hex("ack_bytes")))


ACKS_SQL = """
SELECT o_custkey AS conn_id, o_orderkey AS frame_no, CAST(o_orderkey AS VARCHAR) AS chunk,
  '{"ack":"' || o_orderkey || '"}' AS ack_json,
  '81a361636b' || lower(printf('%02x', 160 + length(CAST(o_orderkey AS VARCHAR))))
    || lower(hex(encode(CAST(o_orderkey AS VARCHAR)))) AS ack_bytes
FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 <> 0"""


def unacked_rows(spark, sf_dir):
    requests = order_requests(spark, sf_dir)
    return unacked(requests, acks(requests, _failed(requests))).select("conn_id", "frame_no", "chunk", "tag")


UNACKED_SQL = """
SELECT o_custkey AS conn_id, o_orderkey AS frame_no, CAST(o_orderkey AS VARCHAR) AS chunk,
  o_orderstatus AS tag
FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 <> 0"""


def deliver_batch(spark, sf_dir):
    """User code that fails on dear orders; what it accepts is acknowledged."""
    dear = F.from_json(F.col("entries")[0]["record"], "o_totalprice DOUBLE")["o_totalprice"] > 300000
    return deliver(
        order_requests(spark, sf_dir), lambda batch, _: batch.where(dear).select("conn_id", "frame_no")
    ).select("conn_id", "frame_no", "chunk", "ack_json")


DELIVER_SQL = """
SELECT o_custkey AS conn_id, o_orderkey AS frame_no, CAST(o_orderkey AS VARCHAR) AS chunk,
  '{"ack":"' || o_orderkey || '"}' AS ack_json
FROM orders WHERE o_totalprice <= 300000 AND o_orderkey % 7 <> 0"""


def redelivered(spark, sf_dir):
    """Every fifth order is sent again, later and on another connection."""
    requests = order_requests(spark, sf_dir)
    again = requests.where("frame_no % 5 = 0").withColumns({
        "conn_id": F.col("conn_id") + 1_000_000,
        "recv_ts": F.col("recv_ts") + F.expr("INTERVAL 90 SECONDS")})
    return dedupe_redelivery(requests.unionByName(again)).select(
        "conn_id", "frame_no", "chunk", F.unix_micros("recv_ts").alias("recv_us"))


DEDUPE_SQL = """
SELECT o_custkey AS conn_id, o_orderkey AS frame_no,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS chunk,
  epoch_us(o_orderdate) AS recv_us
FROM orders
UNION ALL
SELECT o_custkey + 1000000, o_orderkey, NULL, epoch_us(o_orderdate) + 90000000
FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 = 0"""


def order_streams(spark, sf_dir):
    """One stream per order from its line items."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("pos"),
        F.to_json(F.struct("l_quantity", "l_suppkey")).alias("record"),
        F.expr(f"({epoch_micros_sql('l_shipdate')}) div 1000000").alias("time_sec"), "l_partkey")
    streams = group_streams(lines, ("o_orderkey",), "pos", ("record", "time_sec", "l_partkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("tag"))
    return streams.select(
        "o_orderkey", F.size("entries").alias("entries"),
        F.array_join(F.transform("entries", lambda e: e["record"]), ";").alias("records"),
    ).join(orders, "o_orderkey")


ORDER_STREAMS_SQL = """
WITH l AS (
  SELECT o_orderkey, o_orderstatus AS tag, l_linenumber AS pos, epoch_us(l_shipdate) AS us, l_partkey,
    '{"l_quantity":' || CAST(l_quantity AS VARCHAR) || ',"l_suppkey":' || l_suppkey || '}' AS record
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT o_orderkey, tag, CAST(count(*) AS INTEGER) AS entries,
  string_agg(record, ';' ORDER BY pos, record, us, l_partkey) AS records
FROM l GROUP BY o_orderkey, tag"""


def conversation_streams(spark, sf_dir):
    """Each conversation rebuilt from its turns; whole texts, in turn order."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    streams = group_streams(turns, ("conv_id",), "turn", ("role", "text"))
    return streams.select(
        "conv_id", F.size("entries").alias("entries"),
        F.md5(F.array_join(F.transform("entries", lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "|")
              .cast("binary")).alias("digest"))


CONVERSATIONS_SQL = """
SELECT conv_id, CAST(count(*) AS INTEGER) AS entries,
  md5(string_agg(role || ':' || text, '|' ORDER BY turn, role, text)) AS digest
FROM conversations GROUP BY conv_id"""


def order_entries(spark, sf_dir):
    """The entries of `order_streams` in long form: an order may have any number of lines."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("pos"),
        F.to_json(F.struct("l_quantity", "l_suppkey")).alias("record"),
        epoch_micros("l_shipdate").alias("us"), "l_partkey")
    return ranked_entries(lines, ("o_orderkey",), "pos", ("record", "us", "l_partkey"))


ORDER_ENTRIES_SQL = """
WITH l AS (
  SELECT l_orderkey AS o_orderkey, l_linenumber AS pos, epoch_us(l_shipdate) AS us, l_partkey,
    '{"l_quantity":' || CAST(l_quantity AS VARCHAR) || ',"l_suppkey":' || l_suppkey || '}' AS record
  FROM lineitem)
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey
    ORDER BY pos NULLS FIRST, record NULLS FIRST, us NULLS FIRST, l_partkey NULLS FIRST) - 1 AS rank,
  record, us, l_partkey
FROM l"""


def conversation_entries(spark, sf_dir):
    """The turns of `conversation_streams` in long form: a conversation may have any number of turns."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return ranked_entries(turns, ("conv_id",), "turn", ("role", "text"))


CONVERSATION_ENTRIES_SQL = """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS rank, role, text
FROM conversations"""


def printed(spark, sf_dir):
    """The text files that printing all streams leaves, read back line by line."""
    path = f"{shared_folder(spark)}-printed"
    print_streams(event_requests(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("text"))


def rendered(spark, sf_dir):
    return render_streams(event_requests(spark, sf_dir))


RENDER_SQL = """
SELECT user_id % 8 AS conn_id, event_id AS frame_no,
  'EventStream(Tag(' || event_type || '), [EventEntry('
  || strftime(ts, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
          WHEN epoch_us(ts) % 1000 = 0 THEN '.' || printf('%03d', epoch_us(ts) % 1000000 // 1000)
          ELSE '.' || printf('%06d', epoch_us(ts) % 1000000) END
  || 'Z,' || props || ')])' AS text
FROM events"""


def totals(spark, sf_dir):
    return tag_totals(event_requests(spark, sf_dir))


TOTALS_SQL = """
WITH e AS (SELECT event_type, epoch_us(ts) AS us FROM events)
SELECT event_type AS tag, count(*) AS requests, count(*) AS entries,
  min(us) // 1000000 AS first_sec, CAST(min(us) % 1000000 * 1000 AS INTEGER) AS first_nanos,
  max(us) // 1000000 AS last_sec, CAST(max(us) % 1000000 * 1000 AS INTEGER) AS last_nanos
FROM e GROUP BY event_type"""


def throughput_fill(spark, sf_dir):
    rates = throughput(event_requests(spark, sf_dir), "5 minutes")
    return rates.select(F.unix_micros("window_start").alias("window_us"), "entries")


THROUGHPUT_SQL = """
WITH c AS (
  SELECT epoch_us(ts) // 300000000 * 300000000 AS us, count(*) AS n FROM events GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(us) FROM c), (SELECT max(us) FROM c), 300000000)) AS us)
SELECT g.us AS window_us, coalesce(n, 0) AS entries FROM g LEFT JOIN c ON c.us = g.us"""


def throughput_by_tag(spark, sf_dir):
    rates = throughput(event_requests(spark, sf_dir), "1 hour", by_tag=True)
    return rates.select(F.unix_micros("window_start").alias("window_us"), "tag", "entries")


BY_TAG_SQL = """
WITH c AS (
  SELECT event_type AS tag, epoch_us(ts) // 3600000000 * 3600000000 AS us, count(*) AS n
  FROM events GROUP BY ALL),
s AS (SELECT tag, min(us) AS lo, max(us) AS hi FROM c GROUP BY tag),
g AS (SELECT tag, unnest(generate_series(lo, hi, 3600000000)) AS us FROM s)
SELECT g.us AS window_us, g.tag, coalesce(n, 0) AS entries
FROM g LEFT JOIN c ON c.us = g.us AND c.tag = g.tag"""


def throughput_seconds(spark, sf_dir):
    """The reference measure: entries per second of arrival, busy seconds only."""
    rates = throughput(event_requests(spark, sf_dir), fill=False)
    return rates.select(F.unix_micros("window_start").alias("window_us"), "entries")


SECONDS_SQL = """
SELECT epoch_us(ts) // 1000000 * 1000000 AS window_us, count(*) AS entries FROM events GROUP BY 1"""


def tags_in_order(spark, sf_dir):
    return order_by_tag(explode_events(event_requests(spark, sf_dir)).select(
        "tag", "conn_id", "frame_no", "pos"))


ORDER_SQL = """
SELECT event_type AS tag, user_id % 8 AS conn_id, event_id AS frame_no, CAST(0 AS INTEGER) AS pos
FROM events ORDER BY tag, conn_id, frame_no"""


def doubled_events(spark, sf_dir):
    """All events twice: equal events are one, whatever request brought them."""
    events = explode_events(event_requests(spark, sf_dir)).withColumn("time_sec", F.expr("time_sec div 3600 * 3600")).withColumn("time_nanos", F.lit(0))
    return distinct_events(events.unionByName(events.withColumn("conn_id", F.col("conn_id") + 100)))


DISTINCT_SQL = """
SELECT DISTINCT event_type AS tag, epoch_us(ts) // 3600000000 * 3600 AS time_sec,
  CAST(0 AS INTEGER) AS time_nanos, props AS record
FROM events"""


def _status_streams(requests: DataFrame) -> DataFrame:
    """Streams without what tells orders apart: the day is the only entry."""
    return requests.withColumn("entries", F.transform("entries", lambda e: F.struct(
        e["time_sec"].alias("time_sec"), e["time_nanos"].alias("time_nanos"), F.lit("{}").alias("record"))))


def streams_by_value(spark, sf_dir):
    streams = distinct_streams(_status_streams(order_requests(spark, sf_dir)))
    return streams.select("tag", F.col("entries")[0]["time_sec"].alias("time_sec"))


STREAMS_SQL = """
SELECT DISTINCT o_orderstatus AS tag, epoch_us(o_orderdate) // 1000000 AS time_sec FROM orders"""


def stream_surplus(spark, sf_dir):
    """Streams of even orders against those of odd orders, as multisets."""
    requests = _status_streams(order_requests(spark, sf_dir))
    found = stream_difference(requests.where("frame_no % 2 = 0"), requests.where("frame_no % 2 = 1"))
    return found.select("side", "tag", F.col("entries")[0]["time_sec"].alias("time_sec"), "surplus")


SURPLUS_SQL = """
WITH c AS (
  SELECT o_orderstatus AS tag, epoch_us(o_orderdate) // 1000000 AS time_sec,
    CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) AS BIGINT) AS n
  FROM orders GROUP BY ALL)
SELECT CASE WHEN n > 0 THEN 'left' ELSE 'right' END AS side, tag, time_sec, abs(n) AS surplus
FROM c WHERE n <> 0"""


def written_events(spark, sf_dir):
    """Events through the partitioned sink and back, counted per date and tag folder."""
    path = shared_folder(spark)
    write_events(explode_events(event_requests(spark, sf_dir)), path)
    return spark.read.parquet(path).groupBy(
        F.date_format("event_date", "yyyy-MM-dd").alias("day"), "tag").agg(
        F.count("*").alias("events"), F.max("time_sec").alias("last_sec"))


WRITTEN_SQL = """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS tag, count(*) AS events,
  max(epoch_us(ts)) // 1000000 AS last_sec
FROM events GROUP BY ALL"""


QUERIES = {
    "acks": (ack_rows, ACKS_SQL),
    "unacked": (unacked_rows, UNACKED_SQL),
    "deliver_batch": (deliver_batch, DELIVER_SQL),
    "dedupe_redelivery": (redelivered, DEDUPE_SQL),
    "order_streams": (order_streams, ORDER_STREAMS_SQL),
    "conversation_streams": (conversation_streams, CONVERSATIONS_SQL),
    "order_entries": (order_entries, ORDER_ENTRIES_SQL),
    "conversation_entries": (conversation_entries, CONVERSATION_ENTRIES_SQL),
    "render_streams": (rendered, RENDER_SQL),
    "print_streams": (printed, f"SELECT text FROM ({RENDER_SQL})"),
    "tag_totals": (totals, TOTALS_SQL),
    "throughput_fill": (throughput_fill, THROUGHPUT_SQL),
    "throughput_by_tag": (throughput_by_tag, BY_TAG_SQL),
    "throughput_seconds": (throughput_seconds, SECONDS_SQL),
    "order_by_tag": (tags_in_order, ORDER_SQL),
    "distinct_events": (doubled_events, DISTINCT_SQL),
    "distinct_streams": (streams_by_value, STREAMS_SQL),
    "stream_difference": (stream_surplus, SURPLUS_SQL),
    "write_events": (written_events, WRITTEN_SQL),
}
