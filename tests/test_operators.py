"""Operators on small tables with answers written by hand."""

import datetime as dt
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway import schemas
from sluiceway.functions.requests import resolve_times
from sluiceway.functions.times import instant_text, resolve_time
from sluiceway.operators.admission import (
    AdmissionConfig, admit, check_pings, decode_pings, eligible_users, match_clients,
    parse_networks, pong_rows)
from sluiceway.operators.delivery import acks, dedupe_redelivery, deliver, print_streams, render_streams, unacked
from sluiceway.operators.frames import frames_only, framing_rejects, reassemble_frames
from sluiceway.operators.requests import decode, decode_requests, explode_events, rejects, requests_of
from sluiceway.operators.streams import (
    distinct_events, distinct_streams, group_streams, order_by_tag, ranked_entries, same_streams, tag_totals, throughput)
from sluiceway.sources.tables import segments_from_messages
from test_blocks import pack

UTC = dt.timezone.utc
T0 = dt.datetime(2024, 1, 1, tzinfo=UTC)


def segments(spark, *connections):
    rows = []
    for conn, pieces in enumerate(connections):
        rows += [(conn, "10.0.0.1", i, T0 + dt.timedelta(seconds=i), p) for i, p in enumerate(pieces)]
    return spark.createDataFrame(rows, schemas.SEGMENTS)


def by_size(data, size):
    return [data[i:i + size] for i in range(0, len(data), size)]


@pytest.mark.parametrize("block", [1, 3, 8192])
def test_framing_cases(spark, block):
    strings = b"".join(pack("x" * n) for n in (1000, 1001, 1021, 1022, 5))
    big = pack("y" * 65536)
    good = pack(["t", 1, {}])
    frames = reassemble_frames(segments(
        spark, by_size(strings, 300), by_size(big, 1024), by_size(good + b"\xc1" + good, 2),
        by_size(good + good + b"\x91", 5), by_size(b"\xc0" * 9, 1)), 70000, block)
    got = {(r.conn_id, r.frame_no): (r.size, r.error_class) for r in frames.collect()}
    want = {(0, i): (s, None) for i, s in enumerate((1003, 1004, 1024, 1025, 6))}
    want |= {(1, 0): (65541, None)}
    want |= {(2, 0): (len(good), None), (2, 1): (1, "CORRUPT_FRAME")}
    want |= {(3, 0): (len(good), None), (3, 1): (len(good), None), (3, 2): (1, "INCOMPLETE")}
    want |= {(4, i): (1, None) for i in range(9)}
    assert got == want
    assert frames_only(frames).count() == len(want) - 2
    assert framing_rejects(frames).count() == 2


def test_hot_connection_is_spread_over_tasks(spark):
    stream = b"".join(pack([f"t{i % 5}", [[i + 1, {"n": i, "s": "z" * (i % 50)}]] * 3]) for i in range(2000))
    df = segments(spark, by_size(stream, 100))
    whole = reassemble_frames(df, block_segments=10 ** 6)
    split = reassemble_frames(df, block_segments=50)
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()
    assert split.select(F.spark_partition_id()).distinct().count() > 4


def test_missing_segment_ends_the_connection(spark):
    good = pack(["t", 1, {}])
    df = segments(spark, by_size(good * 10, len(good))).where("seq <> 6")
    for block in (2, 100):
        got = reassemble_frames(df, block_segments=block).orderBy("frame_no").collect()
        assert [r.error_class for r in got] == [None] * 6 + ["SEQUENCE_GAP"]
        assert got[-1].recv_ts.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 5)


def test_one_bad_request_among_good_ones(spark):
    good = lambda c: pack(["t", [[1, {"a": 1}], [2, {"b": 2}]], {"chunk": c}])
    stream = good("1") + pack(["t", [[1, {}], [2, [3]]], {"chunk": "2"}]) + b"\xc0" + good("3") + pack(["t", [], {"chunk": "4"}])
    decoded = decode(reassemble_frames(segments(spark, by_size(stream, 7))))
    requests = requests_of(decoded)
    assert [r.chunk for r in requests.orderBy("frame_no").collect()] == ["1", "3", "4"]
    assert [r.error_class for r in rejects(reassemble_frames(segments(spark, by_size(stream, 7)))).collect()] == ["BAD_RECORD"]
    events = explode_events(requests).orderBy("frame_no", "pos").collect()
    assert [(e.frame_no, e.pos, e.record) for e in events] == [
        (0, 0, '{"a":1}'), (0, 1, '{"b":2}'), (3, 0, '{"a":1}'), (3, 1, '{"b":2}')]
    # A request without entries is still acknowledged; the rejected one is not.
    assert [r.chunk for r in acks(requests).orderBy("frame_no").collect()] == ["1", "3", "4"]
    assert same_streams(requests, group_streams(explode_events(requests)).unionByName(
        requests.where("chunk = '4'").select("conn_id", "frame_no", "tag", "chunk", "entries")))


def test_time_rule_is_the_same_for_columns_and_tasks(spark):
    cases = [(100, 0), (0, 334), (None, 0), (1, -1), (0, 1_500_000_000), (-5, -1), (-1, 1_000_000_000),
             (9223372036854, 775807000), (9223372036854, 775808000), (-9223372036854, 0), (-9223372036855, 999999999),
             (31556889864403199, 999999999), (-31557014167219200, -1)]
    us = 1_600_000_000_123_456
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(cases)], "i INT, time_sec BIGINT, time_nanos INT")
    got = [tuple(r) for r in resolve_time(df.withColumn("recv_ts", F.timestamp_micros(F.lit(us)))).orderBy("i").select(
        "time_sec", "time_nanos", F.unix_micros("event_ts")).collect()]
    sec, nano, ts = resolve_times([c[0] for c in cases], [c[1] for c in cases], np.full(len(cases), us))
    assert got == list(zip(sec.to_pylist(), nano.to_pylist(), ts.cast(pa.int64()).to_pylist()))


def test_instant_text(spark):
    cases = {(1479042659, 0): "2016-11-13T13:10:59Z", (0, 120_000_000): "1970-01-01T00:00:00.120Z",
             (0, 1000): "1970-01-01T00:00:00.000001Z", (0, 1): "1970-01-01T00:00:00.000000001Z",
             (-1, 0): "1969-12-31T23:59:59Z", (253402300800, 0): "+10000-01-01T00:00:00Z",
             (-62167219201, 0): "-0001-12-31T23:59:59Z", (31556889864403199, 999999999): "+1000000000-12-31T23:59:59.999999999Z",
             (951782400, 0): "2000-02-29T00:00:00Z"}
    df = spark.createDataFrame([(s, n) for s, n in cases], "s BIGINT, n INT")
    assert {(r.s, r.n): r.t for r in df.withColumn("t", instant_text("s", "n")).collect()} == cases


def test_render(spark):
    frame = pack(["web.access", 1700000000, {"path": "/a", "sizes": [7, 12]}])
    two = pack(["t", [[1, {"z": {"d": 1, "c": 2}, "a": 1}], [2, {}]]])
    text = render_streams(decode_requests(reassemble_frames(segments(spark, [frame + two]))))
    assert [r.text for r in text.orderBy("frame_no").collect()] == [
        'EventStream(Tag(web.access), [EventEntry(2023-11-14T22:13:20Z,{"path":"/a","sizes":[7,12]})])',
        "EventStream(Tag(t), [EventEntry(1970-01-01T00:00:01Z,{\"z\":{\"d\":1,\"c\":2},\"a\":1}), EventEntry(1970-01-01T00:00:02Z,{})])"]


def requests(spark, *rows):
    return spark.createDataFrame(
        [(c, n, T0 + dt.timedelta(seconds=s), tag, chunk, [(1, 0, None, "{}", None)] * k) for c, n, s, tag, chunk, k in rows],
        f"conn_id BIGINT, frame_no BIGINT, recv_ts TIMESTAMP, tag STRING, chunk STRING, entries ARRAY<STRUCT<{schemas.ENTRY}>>"
    ).withColumn("compressed", F.lit(None).cast("string"))


def test_acks(spark):
    df = requests(spark, (1, 0, 0, "t", "chunk1", 1), (1, 1, 0, "t", None, 1), (1, 2, 0, "t", "é" * 20, 1))
    rows = acks(df, df.where("frame_no = 2")).collect()
    assert [(r.chunk, r.ack_json, bytes(r.ack_bytes)) for r in rows] == [
        ("chunk1", '{"ack":"chunk1"}', pack({"ack": "chunk1"}))]
    assert bytes(acks(df).where("frame_no = 2").first().ack_bytes) == pack({"ack": "é" * 20})
    assert [r.frame_no for r in unacked(df, acks(df, df.where("frame_no = 2"))).collect()] == [2]

    def broken(batch, epoch):
        raise RuntimeError("no")
    with pytest.raises(RuntimeError):
        deliver(df, broken)


def test_dedupe_keeps_the_earliest(spark):
    df = requests(spark, (2, 0, 5, "t", "a", 1), (1, 7, 3, "t", "a", 1), (3, 1, 3, "t", "a", 1), (1, 1, 0, "t", None, 1), (1, 2, 0, "t", None, 1))
    assert sorted((r.conn_id, r.frame_no) for r in dedupe_redelivery(df).collect()) == [(1, 1), (1, 2), (1, 7)]


def test_throughput(spark):
    df = requests(spark, (1, 0, 0, "a", None, 3), (1, 1, 0, "b", None, 2), (1, 2, 4, "a", None, 1))
    got = [(r.window_start.second, r.entries) for r in throughput(df).orderBy("window_start").collect()]
    assert got == [(0, 5), (1, 0), (2, 0), (3, 0), (4, 1)]
    assert {(r.tag, r.window_start.second): r.entries for r in throughput(df, by_tag=True).collect()} == {
        ("a", 0): 3, ("a", 1): 0, ("a", 2): 0, ("a", 3): 0, ("a", 4): 1, ("b", 0): 2}
    assert throughput(df, fill=False).count() == 2
    total = {r.tag: (r.requests, r.entries) for r in tag_totals(df).collect()}
    assert total == {"a": (2, 4), "b": (1, 2)}
    assert throughput(df.limit(0)).isEmpty()


def test_order(spark):
    df = spark.createDataFrame([("\U0001F600",), ("￮",), ("a",)], "tag STRING")
    assert [r.tag for r in order_by_tag(df).collect()] == ["a", "￮", "\U0001F600"]
    assert [r.tag for r in order_by_tag(df, java_order=True).collect()] == ["a", "\U0001F600", "￮"]


def test_equal_events_whatever_the_key_order(spark):
    a = pack(["t", 1, {"a": 1, "b": 2}])
    b = pack(["t", 1, {"b": 2, "a": 1}])
    events = explode_events(decode_requests(reassemble_frames(segments(spark, [a + b], [a]))))
    assert events.count() == 3 and distinct_events(events).count() == 1


def test_events_of_other_types_differ(spark):
    """Pairs with the same text, which are not equal."""
    pairs = [({1: "a"}, {"1": "a"}), ({"k": b"a"}, {"k": "YQ=="}), ({"k": float("nan")}, {"k": "NaN"})]
    frames = [pack(["t", 1, r]) for pair in pairs for r in pair] + [pack(["t", 1, {"a": 1, "b": 2}]), pack(["t", 1, {"b": 2, "a": 1}])]
    both = decode_requests(reassemble_frames(segments(spark, frames, frames)))
    assert distinct_events(explode_events(both)).count() == 7
    assert distinct_streams(both).count() == 7
    one, two = (both.where(F.col("frame_no") == n) for n in (0, 1))
    assert same_streams(one, one) and not same_streams(one, two)


def test_a_long_stream_is_one_row(spark):
    events = spark.range(10_001).select(
        F.lit(1).alias("conn_id"), F.lit(1).alias("frame_no"), F.lit("t").alias("tag"), F.lit("c").alias("chunk"),
        F.col("id").alias("pos"), F.col("id").alias("time_sec"), F.lit(0).alias("time_nanos"),
        F.lit("{}").alias("record"))
    rows = group_streams(events.repartition(5), fields=("time_sec", "time_nanos", "record")).collect()
    assert len(rows) == 1 and [e.time_sec for e in rows[0].entries] == list(range(10_001))


def test_ranked_entries_number_streams_over_partitions(spark):
    events = spark.range(1000).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") < 900, "k").otherwise("z").alias("key"),
        (F.col("id") % 3).alias("pos"), F.col("id").alias("v"))
    rows = ranked_entries(events.repartition(7), ("key",), "pos", ("v",)).collect()
    for key in (None, "k", "z"):
        mine = sorted((r["rank"], r.v) for r in rows if r.key == key)
        want = sorted((i for i in range(1000) if (None if i % 10 == 0 else "k" if i < 900 else "z") == key), key=lambda i: (i % 3, i))
        assert mine == list(enumerate(want))


@pytest.mark.parametrize("name", ["conversation_entries", "order_entries"])
def test_registered_long_form_spreads_one_hot_stream(spark, tmp_path, name):
    from sluiceway.plans.catalog import QUERIES

    row = F.col("id")
    key = F.when(row % 4 == 0, row).otherwise(-1)
    spark.range(4000).select(
        key.alias("conv_id"), row.alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), row).alias("text")
    ).write.parquet(str(tmp_path / "conversations.parquet"))
    spark.range(4000).select(
        key.alias("l_orderkey"), row.alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), row.alias("l_suppkey"),
        row.alias("l_partkey"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate")
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = QUERIES[name][0](spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 4000
    hot = sorted((r for r in rows if r[0] == -1), key=lambda r: r["rank"])
    assert [r["rank"] for r in hot] == list(range(3000))
    want = [i for i in range(4000) if i % 4]
    assert [r["text"] if name == "conversation_entries" else r["l_partkey"] for r in hot] == \
        ([f"t{i}" for i in want] if name == "conversation_entries" else want)
    tasks = [r["task"] for r in hot]
    assert max(map(tasks.count, set(tasks))) < 1500


def test_dedupe_of_repeats_and_reused_connections(spark):
    once = requests(spark, (1, 0, 1, "t", "a", 1), (1, 1, 2, "t", "b", 1), (1, 2, 3, "t", None, 1),
                    (2, 0, 5, "t", "b", 1), (1, 0, 9, "t", "b", 1), (1, 1, 9, "t", "a", 1))
    keys = lambda df: sorted((r.chunk or "", r.conn_id, r.frame_no, r.recv_ts.second) for r in df.collect())
    assert keys(dedupe_redelivery(once)) == [("", 1, 2, 3), ("a", 1, 0, 1), ("b", 1, 1, 2)]
    assert keys(dedupe_redelivery(once.union(once))) == keys(dedupe_redelivery(once))


def test_acks_of_two_deliveries_are_both_kept(spark, tmp_path):
    path = str(tmp_path / "acks")
    first = requests(spark, (1, 0, 1, "t", "a", 1), (1, 1, 2, "t", "b", 1))
    second = requests(spark, (2, 0, 1, "t", "c", 1))
    deliver(first, lambda batch, _: batch.where("chunk = 'b'").select("conn_id", "frame_no"), ack_path=path)
    deliver(second, lambda batch, _: None, ack_path=path)
    assert sorted(r.chunk for r in spark.read.parquet(path).collect()) == ["a", "c"]


def test_every_stream_is_printed(spark, tmp_path, capsys):
    df = requests(spark, *[(1, i, 1, "t", None, 1) for i in range(50)])
    print_streams(df)
    assert capsys.readouterr().out.count("EventStream(") == 50
    print_streams(df, str(tmp_path / "text"))
    assert spark.read.text(str(tmp_path / "text")).count() == 50


def clients(spark, *rows):
    return spark.createDataFrame(rows, schemas.CLIENTS)


def test_networks(spark):
    table = clients(
        spark, (0, None, "172.20.5.0/24", None, None), (1, None, "10.64.0.0/19", None, None), (2, None, "2a02::/48", None, None),
        (3, "10.64.10.1", "0.0.0.0/0", None, None), (4, None, "2a02::1:::0/48", None, None), (5, None, "172.20.5.1.0/20", None, None),
        (6, None, "172.20.5.0/xx", None, None), (7, None, "172.20.5.1", None, None), (8, None, "2a02::1", None, None),
        (9, None, "10.0.0.0/33", None, None), (10, None, None, None, None), (11, "::ffff:9.9.9.9", None, None, None),
        (12, None, "8.0.0.0/0", None, None))
    assert [r.ord for r in parse_networks(table).where("spec_error IS NOT NULL").orderBy("ord").collect()] == [4, 5, 6, 7, 8, 9, 10]
    want = {"172.20.5.1": 0, "172.20.5.254": 0, "172.20.6.1": 12, "10.64.10.1": 1, "10.64.20.1": 1, "10.64.31.254": 1,
            "10.64.40.1": 12, "10.64.50.1": 12, "::10.64.10.1": None, "2a02::1": 2, "2a02::dead:beaf:1:1:1": 2,
            "2a02:1:0::1": None, "9.9.9.9": 11, "::ffff:10.64.10.1": 1, "junk": None, None: None}
    df = spark.createDataFrame([(i, a) for i, a in enumerate(want)], "conn_id INT, remote_addr STRING")
    assert {r.remote_addr: r.client_ord for r in match_clients(df, table).collect()} == want


def sha(*parts):
    return hashlib.sha512(b"".join(p if isinstance(p, bytes) else p.encode() for p in parts)).hexdigest()


def ping(conn, addr="10.0.0.1", key="global", user="alice", password="pw", upper=False):
    digest = sha("salt", "host", b"nonce", key)
    return (conn, addr, b"nonce", b"auth", "host", "salt", digest.upper() if upper else digest, user, sha(b"auth", user, password))


def test_a_name_with_many_passwords(spark):
    """Most pings use few of them, some a rare one, some none; a connection's pings are judged one by one."""
    table = clients(spark, (0, "10.0.0.1", None, None, ["alice"]))
    users = spark.createDataFrame(
        [("alice", f"pw-{i}") for i in range(3000)] + [("alice", None), (None, "pw-1"), ("bob", "pw")], schemas.USERS)
    want, rows = [], []
    for conn in range(500):
        password = f"pw-{conn % 3}" if conn < 300 else f"pw-{conn * 5}" if conn < 450 else "nope"
        rows.append(ping(conn, password=password))
        want.append((conn, conn < 450))
    rows += [ping(7, password="nope"), ping(7, password="pw-2999"), ping(500, user="bob", password="pw"), (*ping(501)[:7], None, None)]
    want += [(7, False), (7, True), (500, False), (501, False)]
    cfg = AdmissionConfig("me", "global", user_auth=True)
    results = check_pings(spark.createDataFrame(rows, schemas.PINGS), table, users, cfg)
    assert sorted((r.conn_id, r.ok) for r in results.collect()) == sorted(want)
    assert not re.search(r"LeftOuter[^\n]*sha2", results._jdf.queryExecution().executedPlan().toString())


def test_verdicts(spark):
    table = clients(spark, (0, "10.0.0.1", None, None, ["alice"]), (1, None, "10.1.0.0/16", "own", []))
    users = spark.createDataFrame([("alice", "pw"), ("alice", "other"), ("bob", "pw")], schemas.USERS)
    pings = spark.createDataFrame([
        ping(1), ping(2, key="bad"), ping(3, addr="1.2.3.4"), ping(4, addr="10.1.2.3", key="own"), ping(5, addr="10.1.2.3"),
        ping(6, password="other"), ping(7, password="x"), ping(8, user="bob"), ping(9, addr="10.1.2.3", key="own", user="bob"),
        ping(10, upper=True), ping(11, user="nobody")], schemas.PINGS)
    cfg = AdmissionConfig("me", "global", user_auth=True, allow_anonymous=False)
    results = check_pings(pings, table, users, cfg)
    assert results.columns == ["conn_id", "client_ord", "ok", "reason"]
    got = {r.conn_id: r.reason for r in results.collect()}
    key, user = "Shared key mismatch", "username/password mismatch"
    assert got == {1: None, 2: key, 3: "Anonymous client disallowed.", 4: None, 5: key, 6: None, 7: user, 8: user, 9: None, 10: key, 11: user}
    open_cfg = AdmissionConfig("me", "global")
    assert {r.conn_id for r in check_pings(pings, table, users, open_cfg).where("ok").collect()} == {1, 3, 4, 6, 7, 8, 9, 11}
    assert {r.reason for r in check_pings(pings.where("conn_id = 1"), table, users, AdmissionConfig("me")).collect()} == {"No shared key configured."}
    known = eligible_users(pings, table, users).where("conn_id IN (1, 8, 9)").collect()
    assert sorted((r.conn_id, r.username, r.users) for r in known) == [(1, "alice", 2), (9, "bob", 1)]
    pongs = {r.conn_id: r for r in pong_rows(results, pings, table, cfg).collect()}
    digest = sha("salt", "me", b"nonce", "global")
    assert (pongs[1].ok, pongs[1].reason, pongs[1].hostname, pongs[1].digest) == (True, "", "me", digest)
    assert bytes(pongs[1].pong_bytes) == pack(["PONG", True, "", "me", digest])
    assert bytes(pongs[2].pong_bytes) == pack(["PONG", False, key, "", ""])
    assert pongs[4].digest == sha("salt", "me", b"nonce", "own")
    traffic = spark.createDataFrame([(c, n) for c in (1, 2, 99) for n in range(3)], "conn_id BIGINT, frame_no BIGINT")
    assert {r.conn_id for r in admit(traffic, results).collect()} == {1}
    assert {r.conn_id for r in admit(traffic, results, strict=False).collect()} == {1, 2}


def test_decode_pings(spark):
    fields = ["PING", "host", "salt", "d" * 128, "user", "p" * 128]
    raw = [
        [b"\xc0" + pack(["PING", "too", "short"]) + pack(fields) + pack(["t", 1, {}])],
        [b"\xdc\x00\x06\xd9\x04PING" + b"".join(map(pack, fields[1:])) + pack(fields) + pack(["t", 2, {}])],
        [pack([*fields[:4], 5, fields[5]]) + pack(fields) + pack(["t", 3, {}])],
        [pack(["t", 4, {}])], [pack(["t", 5, {}])]]
    frames = reassemble_frames(segments(spark, *raw))
    handshakes = spark.createDataFrame([(c, b"n", b"s") for c in (0, 1, 2, 3)], schemas.HANDSHAKES)
    shake = decode_pings(frames, handshakes)
    assert {(r.conn_id, r.username, bytes(r.nonce)) for r in shake.pings.collect()} == {(0, "user", b"n"), (1, "user", b"n")}
    assert sorted((r.conn_id, r.frame_no) for r in shake.rejects.collect()) == [(0, 0), (0, 1), (2, 0), (2, 1), (2, 2), (3, 0)]
    assert sorted((r.conn_id, r.frame_no) for r in shake.frames.collect()) == [(0, 3), (1, 1), (1, 2), (4, 0)]


def test_segments_from_messages(spark):
    df = spark.sql("""SELECT CAST('7' AS BINARY) AS key, X'C0' AS value, timestamp'2024-01-01' AS timestamp,
        array(named_struct('key', 'seq', 'value', CAST('3' AS BINARY)),
              named_struct('key', 'remote_addr', 'value', CAST('10.0.0.1' AS BINARY))) AS headers""")
    row = segments_from_messages(df).first()
    assert (row.conn_id, row.remote_addr, row.seq, bytes(row.payload)) == (7, "10.0.0.1", 3, b"\xc0")
