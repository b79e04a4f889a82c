"""Event streams as values: grouping, order, equality, totals and rates."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType

from sluiceway.functions.wire import value_key
from sluiceway.session import shared_folder

ENTRY_FIELDS = ("time_sec", "time_nanos", "event_ts", "record", "record_raw")
VALUE = ["time_sec", "time_nanos", "record"]


def group_streams(
    events: DataFrame,
    keys: tuple[str, ...] = ("conn_id", "frame_no", "tag", "chunk"),
    order: str = "pos",
    fields: tuple[str, ...] = ENTRY_FIELDS,
) -> DataFrame:
    """Rebuild event streams from single events: one row per stream, entries in ``order``.

    Entries of one position are ordered by their fields. A row holds its whole stream, as a request
    does; for keys whose streams have no bound use `ranked_entries`.
    """
    rest = [f for f in fields if f != order]
    entry = F.struct(order, *rest)
    return (
        events.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("sorted"))
        .select(*keys, F.transform("sorted", lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias("entries")))


def ranked_entries(events: DataFrame, keys: tuple[str, ...], order: str,
                   fields: tuple[str, ...] = ENTRY_FIELDS) -> DataFrame:
    """The entries of `group_streams` in long form, one row each, with their `rank` from 0.

    Rows are sorted over all partitions, so a stream may span many tasks; what it has in earlier
    partitions is added to the place in its own.
    """
    rest = [f for f in fields if f != order]
    folder = shared_folder(events.sparkSession)
    place = [*keys, order, *rest]
    (events.select(*place).repartitionByRange(*place).sortWithinPartitions(*place)
     .withColumn("_row", F.monotonically_increasing_id()).write.parquet(folder))
    rows = events.sparkSession.read.parquet(folder).withColumn("_part", F.shiftright("_row", 33))
    counts = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_part").alias("_p"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = [rows[k].eqNullSafe(counts[f"_{k}"]) for k in keys]
    return rows.join(counts, [rows["_part"] == counts["_p"], *same]).select(
        *keys, (F.col("_before") + F.col("_row") - F.col("_first")).alias("rank"), *fields)


def order_by_tag(df: DataFrame, java_order: bool = False, then: tuple[str, ...] | None = None) -> DataFrame:
    """Sort by tag name. ``java_order`` compares UTF-16 units instead of code points.

    The other key columns break ties, which also lets one hot tag span many sort tasks.
    """
    if then is None:
        then = tuple(c for c in ("conn_id", "frame_no", "pos") if c in df.columns)
    tag = F.hex(F.encode(F.col("tag"), "UTF-16BE")) if java_order else F.col("tag")
    return df.orderBy(tag, *then)


def _key_of(raw: bytes | None) -> bytes | None:
    return None if raw is None else hashlib.blake2b(value_key(bytes(raw)), digest_size=16).digest()


@F.pandas_udf(BinaryType())
def record_key(raw: pd.Series) -> pd.Series:
    """Digest of a record as sent that tells types apart: 1 is not "1", bytes are not their base64."""
    return raw.map(_key_of)


@F.pandas_udf(ArrayType(BinaryType()))
def _record_keys(raws: pd.Series) -> pd.Series:
    return raws.map(lambda list_: None if list_ is None else [_key_of(raw) for raw in list_])


def distinct_events(events: DataFrame) -> DataFrame:
    """Events that differ in tag, time or record.

    Where the bytes of the record are known (`record_raw`), types count and the order of keys does not;
    elsewhere records are compared as text. `record` is the text of one of the equal records.
    """
    if "record_raw" not in events.columns:
        return events.select("tag", *VALUE).distinct()
    key = F.coalesce(record_key("record_raw"), F.encode("record", "utf-8"))
    return events.groupBy("tag", "time_sec", "time_nanos", key.alias("_key")).agg(F.min("record").alias("record")).drop("_key")


def _stream_values(requests: DataFrame, option: bool) -> DataFrame:
    """Streams by value, with `_keys` of their records that tell types apart, null without bytes."""
    entries = F.transform("entries", lambda e: F.struct(*[e[f].alias(f) for f in VALUE]))
    fields = {f.name for f in requests.schema["entries"].dataType.elementType.fields}
    keys = _record_keys(F.transform("entries", lambda e: e["record_raw"])) if "record_raw" in fields else \
        F.lit(None).cast("array<binary>")
    return requests.select("tag", entries.alias("entries"), keys.alias("_keys"), *(("chunk", "compressed") if option else ()))


def distinct_streams(requests: DataFrame, option: bool = False) -> DataFrame:
    """Streams (with ``option``: whole requests) that differ in value; types count as in `distinct_events`."""
    return _stream_values(requests, option).distinct().drop("_keys")


def stream_difference(left: DataFrame, right: DataFrame, option: bool = False) -> DataFrame:
    """What one side has more often than the other; `side` tells which."""
    a, b = _stream_values(left, option), _stream_values(right, option)
    return (
        a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
        .groupBy(*a.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
        .select(F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"),
                *[c for c in a.columns if c != "_n"], F.abs("_n").alias("surplus")).drop("_keys"))


def same_streams(left: DataFrame, right: DataFrame, option: bool = False) -> bool:
    """Whether both sides hold the same streams equally often, in any row order."""
    return stream_difference(left, right, option).isEmpty()


def with_counts(requests: DataFrame) -> DataFrame:
    """Add what rates and totals need of `entries`: `n_entries`, `first_time` and `last_time` (sec, nanos)."""
    times = F.transform("entries", lambda e: F.struct(
        e["time_sec"].alias("sec"), e["time_nanos"].alias("nanos")))
    return requests.withColumns({
        "n_entries": F.when(F.col("entries").isNotNull(), F.size("entries")),
        "first_time": F.array_min(times), "last_time": F.array_max(times)})


def tag_totals(requests: DataFrame) -> DataFrame:
    """Requests, entries and the first and last event time of each tag.

    Of a table that has the columns of `with_counts`, `entries` is not read.
    """
    counted = requests if "n_entries" in requests.columns else with_counts(requests)
    return (
        counted.select("tag", F.col("n_entries").alias("n"), F.col("first_time").alias("lo"),
                       F.col("last_time").alias("hi"))
        .groupBy("tag").agg(
            F.count("*").alias("requests"), F.sum("n").cast("bigint").alias("entries"),
            F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select("tag", "requests", "entries",
                F.col("lo.sec").alias("first_sec"), F.col("lo.nanos").alias("first_nanos"),
                F.col("hi.sec").alias("last_sec"), F.col("hi.nanos").alias("last_nanos")))


_RUN = 4096     # windows one row of the coarse grid stands for


def throughput(requests: DataFrame, every: str = "1 second", by_tag: bool = False,
               fill: bool = True) -> DataFrame:
    """Entries per window of arrival time; with ``fill``, idle windows report 0.

    Of a table that has `n_entries` (see `with_counts`), `entries` is not read.

    ``fill`` covers the span from the first to the last window (of each tag, by tag) and
    is for batches; a stream gives updates per window, keeps all windows and drops nothing. For rates
    of a long-lived stream use `throughput_to_table`, which keeps no state.
    """
    keys = ["tag"] if by_tag else []
    entries = "n_entries" if "n_entries" in requests.columns else F.size("entries")
    counts = (
        requests.groupBy(F.window("recv_ts", every), *keys)
        .agg(F.sum(entries).cast("bigint").alias("entries"))
        .select(F.col("window.start").alias("window_start"), *keys, "entries"))
    if requests.isStreaming or not fill:
        return counts

    step = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {every})")
    start = F.unix_micros("window_start")
    span = counts.groupBy(*keys).agg(F.min(start).alias("lo"), F.max(start).alias("hi"))
    grid = (
        span.where("lo IS NOT NULL")
        .select(*keys, "hi", F.explode(F.sequence("lo", "hi", step * _RUN)).alias("lo"))
        .repartition(*keys, "lo")
        .select(*keys, F.explode(F.sequence(
            "lo", F.least("hi", F.col("lo") + step * (_RUN - 1)), step)).alias("us"))
        .select(F.timestamp_micros("us").alias("window_start"), *keys,
                F.lit(0).cast("bigint").alias("entries")))
    return counts.unionByName(grid).groupBy("window_start", *keys).agg(
        F.sum("entries").alias("entries"))
