"""Admission of live traffic: handshake, verdict and requests of a connection in one stream.

A secured connection is *greeted* until its PING has come, then *open* or *closed* by the verdict.
Frames of a greeted connection are held; those of an open one pass. Both the verdicts and the
held frames are tables with a version per epoch, so the clients and users they are checked
against may be tables of any size, joined as in a batch.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway import schemas
from sluiceway.operators.admission import (
    AdmissionConfig, bad_pings, check_pings, first_pings, pings_of, pong_rows)
from sluiceway.operators.delivery import query_folder
from sluiceway.operators.joins import measured_join
from sluiceway.streaming.versions import Versions, remove

_VERDICTS = "conn_id BIGINT, ping_no BIGINT, ok BOOLEAN, seen_us BIGINT"


class Admission(NamedTuple):
    frames: DataFrame       # what may be decoded: of open connections after their PING, of unsecured ones all
    rejects: DataFrame      # BAD_PING: frames before the PING, and all of a connection with an ill-formed one
    verdicts: DataFrame     # conn_id, ping_no, client_ord, ok, reason
    pongs: DataFrame
    pending: DataFrame      # frames of greeted connections whose PING has not come


def admission_stream(
    frames: DataFrame,
    handshakes: DataFrame | Callable[[], DataFrame],
    clients: DataFrame,
    users: DataFrame,
    cfg: AdmissionConfig,
    path: str,
    checkpoint: str | None = None,
    strict: bool = True,
    forget: str | None = None,
    available_now: bool = False,
):
    """Admit a stream of frames; the tables below ``path`` are read with `admission_tables`.

    Gives what `decode_pings`, `check_pings`, `pong_rows` and `admit` give for all frames together, with one
    difference: the first PING of a connection to *arrive* decides, also when an earlier one follows in a
    later micro-batch. Frames may come in any order; those before the PING are rejected once it is known.
    ``handshakes`` is read anew in each epoch (a callable gives it), since a greeting is recorded before the
    first byte of its connection is read. ``strict=False`` opens a connection whatever its verdict. With
    ``forget`` the verdict of a connection silent for that long (an interval of the clock) is dropped: what it sends after
    that is held. Fault rows pass. Replayed epochs replace what they wrote.
    """
    columns = [c.split()[0] for c in schemas.FRAMES.split(", ")]
    frames = frames.select(*columns)

    def one_epoch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        known = Versions(spark, query_folder(batch, f"{path}/known"), _VERDICTS)
        waiting = Versions(spark, query_folder(batch, f"{path}/waiting"), schemas.FRAMES)

        def put(rows: DataFrame, name: str) -> DataFrame:
            """A table of this epoch, which also keeps the plans behind it short."""
            folder = f"{query_folder(batch, f'{path}/{name}')}/epoch={epoch}"
            rows.write.mode("overwrite").parquet(folder)
            return spark.read.schema(rows.schema).parquet(folder)

        greeted = handshakes() if callable(handshakes) else handshakes
        verdicts = known.before(epoch)
        connections = greeted.select("conn_id", F.lit(True).alias("_secured")).join(
            verdicts.drop("seen_us").withColumn("_judged", F.lit(True)), "conn_id", "left")
        # However few files or row groups the source has, every task gets a part.
        came = put(batch.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conn_id", "frame_no"), "came")
        tagged = put(measured_join(came, connections, ["conn_id"], "left", ["conn_id", "frame_no"]), "tagged")
        passing = F.col("_secured").isNull() | F.col("error_class").isNotNull()
        judged = F.col("_judged").isNotNull()
        fresh = put(waiting.before(epoch).unionByName(tagged.where(~passing & ~judged).select(*columns)), "fresh")

        first = put(first_pings(fresh, greeted), "first")
        pings = pings_of(first)
        results = check_pings(pings, clients, users, cfg)
        made = put(first.select("conn_id", F.when(F.col("p.ok"), F.col("p.frame_no")).alias("ping_no")).join(
            results, "conn_id", "left").withColumn("ok", F.coalesce("ok", F.lit(False))), "verdicts")
        put(pong_rows(made.where("ping_no IS NOT NULL").select("conn_id", "ok", "reason", "client_ord"),
                      pings, clients, cfg), "pongs")

        decided = put(measured_join(
            fresh, made.select("conn_id", "ping_no", "ok", F.lit(True).alias("_judged")),
            ["conn_id"], "left", ["conn_id", "frame_no"]), "decided")
        waiting.write(decided.where("_judged IS NULL").select(*columns), epoch)
        done = decided.where("_judged").unionByName(tagged.where(~passing & judged).drop("_secured"))
        after = F.col("frame_no") > F.col("ping_no")
        may = after if not strict else after & F.col("ok")
        put(tagged.where(passing).select(*columns).unionByName(done.where(may).select(*columns)), "frames")
        early = F.col("ping_no").isNull() | (F.col("frame_no") < F.col("ping_no"))
        put(bad_pings(done.where(early)), "rejects")

        now = F.unix_micros(F.current_timestamp())
        kept = verdicts.unionByName(made.select("conn_id", "ping_no", "ok", now.alias("seen_us")))
        if forget:
            silent = now - F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {forget})")
            heard = came.select("conn_id", F.lit(True).alias("_heard")).distinct()
            kept = kept.join(heard, "conn_id", "left").withColumn(
                "seen_us", F.when(F.col("_heard"), now).otherwise(F.col("seen_us"))).where(F.col("seen_us") >= silent)
        known.write(kept, epoch)
        for name in ("came", "tagged", "fresh", "first", "decided"):
            remove(spark, f"{query_folder(batch, f'{path}/{name}')}/epoch={epoch}")

    writer = frames.writeStream.foreachBatch(one_epoch)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def admission_tables(spark: SparkSession, path: str, query: str) -> Admission:
    """What the query with this id has written so far; `pending` is exact once it has stopped."""
    of = lambda name: spark.read.parquet(f"{path}/{name}/run={query}").drop("epoch")
    waiting = Versions(spark, f"{path}/waiting/run={query}", schemas.FRAMES).latest()
    return Admission(of("frames"), of("rejects"), of("verdicts"), of("pongs"), waiting)
