"""Event times as (epoch seconds, nanoseconds); all plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NANOS = 1_000_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(value, by: int) -> Column:
    """Integer division that rounds down, exact for every BIGINT."""
    value, by = _col(value).cast("bigint"), F.lit(by).cast("bigint")
    return F.call_function("div", value - F.pmod(value, by), by)


def resolved_time(sec, nanos, recv_ts) -> Column:
    """struct(time_sec, time_nanos, event_ts) of a wire time that arrived at ``recv_ts``.

    Nanoseconds are carried into the seconds first; a missing time, or one whose second
    is then 0, is the arrival time.
    """
    sec, nanos = _col(sec), F.coalesce(_col(nanos).cast("bigint"), F.lit(0))
    arrival = F.unix_micros(_col(recv_ts))
    carried = sec + floor_div(nanos, NANOS)
    now = sec.isNull() | (carried == 0)
    second = F.when(now, floor_div(arrival, 1_000_000)).otherwise(carried)
    nano = F.when(now, F.pmod(arrival, F.lit(1_000_000)) * 1000).otherwise(
        F.pmod(nanos, F.lit(NANOS))).cast("int")
    return F.struct(
        second.cast("bigint").alias("time_sec"), nano.alias("time_nanos"),
        event_ts(second, nano).alias("event_ts"))


def event_ts(sec, nanos) -> Column:
    """The microsecond TIMESTAMP of a time; null where a TIMESTAMP cannot hold it."""
    micros = F.try_add(
        F.try_multiply(_col(sec).cast("bigint"), F.lit(1_000_000).cast("bigint")),
        floor_div(nanos, 1000))
    return F.timestamp_micros(micros)


def resolve_time(df, sec="time_sec", nanos="time_nanos", recv_ts="recv_ts"):
    """Replace ``sec`` and ``nanos`` by the resolved time and add `event_ts`."""
    when = resolved_time(sec, nanos, recv_ts)
    return df.withColumn("_when", when).withColumns({
        sec: F.col("_when.time_sec"), nanos: F.col("_when.time_nanos"),
        "event_ts": F.col("_when.event_ts")}).drop("_when")


def instant_text(sec, nanos) -> Column:
    """ISO-8601 UTC text with 0, 3, 6 or 9 fraction digits, whichever is the shortest exact.

    Built from the date of the day number, so it does not depend on the session time zone.
    Years outside 0000-9999 carry a sign.
    """
    sec, nanos = _col(sec), _col(nanos).cast("int")
    day = floor_div(sec, 86400)
    left = F.pmod(sec, F.lit(86400))
    # 400 Gregorian years are 146097 days: fold far dates into one cycle, then restore the year.
    cycle = floor_div(day, 146097)
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(day, F.lit(146097)).cast("int"))
    year = F.year(date).cast("bigint") + cycle * 400
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    fraction = (
        F.when(nanos == 0, F.lit(""))
        .when(nanos % 1_000_000 == 0, F.concat(F.lit("."), F.lpad(floor_div(nanos, 1_000_000).cast("string"), 3, "0")))
        .when(nanos % 1000 == 0, F.concat(F.lit("."), F.lpad(floor_div(nanos, 1000).cast("string"), 6, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(nanos.cast("string"), 9, "0"))))
    digits = F.abs(year).cast("string")
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    sign = F.when(year > 9999, F.lit("+")).when(year < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(
        sign, padded, F.lit("-"), two(F.month(date)), F.lit("-"), two(F.day(date)), F.lit("T"),
        two(floor_div(left, 3600)), F.lit(":"), two(floor_div(F.pmod(left, F.lit(3600)), 60)),
        F.lit(":"), two(F.pmod(left, F.lit(60))), fraction, F.lit("Z"))
