"""Recorded traffic made from the `events` and `documents` tables.

Every connection, request and segment is built from a bounded run of ids, so the job
needs no window and no group that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway.functions import packing as P
from sluiceway.session import shared_folder
from sluiceway.sources.tables import read_segments

GROUP = 100             # consecutive event ids that share requests
CONNECTION = 2000       # consecutive event ids on one connection
PIECES = 8              # segments a group's bytes are cut into


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_micros_sql(ntz: str) -> str:
    """Epoch microseconds of a TIMESTAMP_NTZ read as UTC, whatever the session zone."""
    return (
        f"datediff(CAST({ntz} AS DATE), DATE '1970-01-01') * 86400000000 + hour({ntz}) * 3600000000"
        f" + minute({ntz}) * 60000000L + CAST(extract(SECOND FROM {ntz}) * 1000000 AS BIGINT)")


def epoch_micros(ntz: str) -> Column:
    return F.expr(epoch_micros_sql(ntz))


def events_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time in micros, `k` out of `props`, and the request they go in."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        epoch_micros("ts").alias("us"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.expr(f"event_id div {GROUP}").alias("grp"))


def record_bytes(value: Column | None = None) -> Column:
    """{"event_id":…,"k":…,"user_id":…,"value":…}, keys deliberately out of order; ``value`` is packed already, if given."""
    return F.concat(
        P.map_header(F.lit(4)),
        P.pack_str(F.lit("value")), P.pack_double("value") if value is None else value,
        P.pack_str(F.lit("event_id")), P.pack_int("event_id"),
        P.pack_str(F.lit("user_id")), P.pack_int("user_id"),
        P.pack_str(F.lit("k")), P.pack_int("k"))


def time_bytes() -> Column:
    return P.pack_event_time(F.expr("us div 1000000"), F.expr("us % 1000000 * 1000"))


def cut(groups: DataFrame, base: str = "grp_in_conn") -> DataFrame:
    """(conn_id, grp_in_conn, recv_us, payload) -> segments, `PIECES` for each group."""
    step = F.ceil(F.octet_length("payload") / F.lit(PIECES)).cast("int")
    return groups.withColumn("step", step).select(
        "conn_id",
        F.concat(F.lit("10."), F.expr("conn_id div 65536 % 256").cast("string"), F.lit("."),
                 F.expr("conn_id div 256 % 256").cast("string"), F.lit("."),
                 F.expr("conn_id % 256").cast("string")).alias("remote_addr"),
        "recv_us", "payload", "step", base,
        F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("piece"),
    ).select(
        "conn_id", "remote_addr",
        (F.col(base) * PIECES + F.col("piece")).cast("bigint").alias("seq"),
        F.timestamp_micros("recv_us").alias("recv_ts"),
        F.col("payload").substr(F.col("piece") * F.col("step") + 1, F.col("step")).alias("payload"))


def mixed_mode_segments(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """All events on the wire. A group is sent in Message, Forward or PackedForward mode.

    Each forward or packed request holds the events of one group and type; its chunk is
    `<group>-<type>`. With ``hot``, connection 0 carries every third event of the table.
    """
    conn = F.expr(f"event_id div {CONNECTION}")
    local = F.expr(f"grp % {CONNECTION // GROUP}")
    if hot:
        third = F.expr("event_id % 3 = 0")
        conn = F.when(third, F.lit(0)).otherwise(conn + 1)
        local = F.when(third, F.col("grp")).otherwise(local)
    mode = F.expr("grp % 3")
    entry = F.concat(hex_array(2), F.col("time"), F.col("rec"))
    # Dealt once, as narrow rows: both groupings below are within these parts. Behind a Python function, Spark
    # wouldn't know that, so doubles are packed before.
    dealt = events_with_parts(spark, sf_dir).select(
        conn.alias("conn_id"), local.alias("grp_in_conn"), "grp", "event_type", "event_id", "user_id", "k", "us",
        P.pack_double("value").alias("packed")).repartition("conn_id", "grp_in_conn")
    events = dealt.select(
        "conn_id", "grp_in_conn", "grp", mode.alias("mode"),
        "event_type", "event_id", "us", time_bytes().alias("time"), record_bytes(F.col("packed")).alias("rec"))
    per_event = F.when(
        F.col("mode") == 0,
        F.concat(hex_array(3), P.pack_str("event_type"), F.col("time"), F.col("rec"))
    ).otherwise(entry)
    requests = events.select(
        "conn_id", "grp_in_conn", "grp", "mode", "event_type",
        F.when(F.col("mode") == 0, F.col("event_id")).otherwise(0).alias("sub"),
        "event_id", "us", per_event.alias("bytes"),
    ).groupBy("conn_id", "grp_in_conn", "grp", "mode", "event_type", "sub").agg(
        F.min("us").alias("us"), F.count("*").alias("n"), P.joined("bytes", "event_id").alias("body"))
    option = F.concat(
        P.map_header(F.lit(1)), P.pack_str(F.lit("chunk")), P.pack_str(chunk_text()))
    frame = F.when(F.col("mode") == 0, F.col("body")).otherwise(F.concat(
        hex_array(3), P.pack_str("event_type"),
        F.when(F.col("mode") == 1, F.concat(P.array_header("n"), F.col("body")))
        .otherwise(P.pack_bin("body")),
        option))
    groups = requests.withColumn("frame", frame).groupBy("conn_id", "grp_in_conn").agg(
        F.min("us").alias("recv_us"), P.joined("frame", "event_type", "sub").alias("payload"))
    return cut(groups)


def recorded(segments: DataFrame) -> DataFrame:
    """The segments as a recording on shared storage, which is what a job is given to read."""
    path = f"{shared_folder(segments.sparkSession)}/segments"
    segments.write.parquet(path)
    return read_segments(segments.sparkSession, path)


def hex_array(size: int) -> Column:
    return P.hex_bytes(f"{0x90 + size:02X}")


def chunk_text() -> Column:
    return F.concat(F.col("grp").cast("string"), F.lit("-"), F.col("event_type"))
