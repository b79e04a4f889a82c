"""Admission and missing acks on streams against their batch forms."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sluiceway import schemas
from sluiceway.operators.admission import AdmissionConfig, admit, check_pings, decode_pings, pong_rows
from sluiceway.operators.delivery import unacked
from sluiceway.operators.frames import reassemble_frames
from sluiceway.operators.requests import decode_requests
from sluiceway.sources.tables import read_segments
from sluiceway.streaming import admission
from sluiceway.streaming.admission import admission_stream, admission_tables
from sluiceway.streaming.reassemble import reassemble_stream
from sluiceway.streaming.versions import Versions
from test_blocks import pack

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
CFG = AdmissionConfig("server", "secret", user_auth=True, allow_anonymous=True)


def sha(*parts):
    return hashlib.sha512(b"".join(p if isinstance(p, bytes) else p.encode() for p in parts)).hexdigest()


def ping(conn, key="secret", password="pw", user="u"):
    nonce, salt = f"n{conn}".encode(), f"s{conn}".encode()
    return pack(["PING", "host", "salt", sha("salt", "host", nonce, key), user, sha(salt, "u", password)])


def request(k):
    return pack(["tag", [[k, {"k": k}]], {"chunk": str(k)}])


def traffic():
    """Bytes of each connection: 1 good, 2 wrong key, 3 noise before a good PING, 4 no PING, 5 ill-formed PING, 6 unsecured,
    7 wrong password, 8 corrupt after its PING, 9 a second PING later, which is a frame like others."""
    many = lambda c: b"".join(request(100 * c + k) for k in range(6))
    return {1: ping(1) + many(1), 2: ping(2, key="x") + many(2), 3: b"\xc0" + pack([1, 2]) + ping(3) + many(3), 4: many(4),
            5: ping(5, user=7) + many(5), 6: many(6), 7: ping(7, password="no") + many(7), 8: ping(8) + many(8) + b"\xc1" + many(8),
            9: ping(9) + many(9) + ping(9, key="x") + request(999)}


@pytest.fixture(scope="module")
def sides(spark):
    greeted = spark.createDataFrame([(c, f"n{c}".encode(), f"s{c}".encode()) for c in range(1, 10) if c != 6], schemas.HANDSHAKES)
    clients = spark.createDataFrame([(0, None, "10.0.0.0/8", None, None)], schemas.CLIENTS)
    return greeted, clients, spark.createDataFrame([("u", "pw"), ("u", "other")], schemas.USERS)


def table(df, *columns):
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("strict, ordered", [(True, False), (False, True)])
def test_segments_to_admitted_frames(spark, tmp_path, sides, strict, ordered):
    """From bytes to admitted frames in one query over many micro-batches, stopped and started again in the middle."""
    greeted, clients, users = sides
    rnd = random.Random(4)
    rows = []
    for conn, stream in traffic().items():
        cuts = sorted(rnd.sample(range(1, len(stream)), 12))
        rows += [(conn, "10.0.0.1", i, T0, stream[a:b]) for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(stream)]))]
    if ordered:
        rows.sort(key=lambda r: r[2])
    else:
        rnd.shuffle(rows)
    put = lambda part: spark.createDataFrame(part, schemas.SEGMENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for half in (rows[:len(rows) // 2], rows[len(rows) // 2:]):
        for k in range(2):
            put(half[k::2])
        segments = read_segments(spark, str(tmp_path / "in"), stream=True, files_per_trigger=1)
        query = admission_stream(reassemble_stream(segments), lambda: greeted, clients, users, CFG, str(tmp_path / "out"),
                                 str(tmp_path / "check"), strict=strict, available_now=True)
        query.awaitTermination(300)
        assert query.exception() is None
    got = admission_tables(spark, str(tmp_path / "out"), query.id)
    assert len(list((tmp_path / f"out/frames/run={query.id}").glob("epoch=*"))) == 4
    assert len(list((tmp_path / f"out/known/run={query.id}").glob("epoch=*"))) <= Versions.KEPT + 1

    frames = reassemble_frames(spark.createDataFrame(rows, schemas.SEGMENTS)).cache()
    hand = decode_pings(frames, greeted)
    verdicts = check_pings(hand.pings, clients, users, CFG)
    assert table(got.verdicts.where("ping_no IS NOT NULL"), "conn_id", "client_ord", "ok", "reason") == table(
        verdicts, "conn_id", "client_ord", "ok", "reason")
    assert table(got.pongs, "conn_id", "pong_bytes") == table(pong_rows(verdicts, hand.pings, clients, CFG), "conn_id", "pong_bytes")
    refused = got.rejects.select("conn_id", "frame_no").unionByName(got.pending.select("conn_id", "frame_no"))
    assert table(refused, "conn_id", "frame_no") == table(hand.rejects, "conn_id", "frame_no")
    want = admit(decode_requests(hand.frames), verdicts, strict).unionByName(decode_requests(hand.frames.where("conn_id = 6")))
    assert table(decode_requests(got.frames), "conn_id", "frame_no", "chunk") == table(want, "conn_id", "frame_no", "chunk")
    assert {r[0] for r in table(want, "conn_id")} == ({1, 3, 6, 8, 9} if strict else {1, 2, 3, 6, 7, 8, 9})
    assert table(got.frames.where("error_class IS NOT NULL"), "conn_id", "error_class") == [(8, "CORRUPT_FRAME")]
    frames.unpersist()


def stream_of(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def test_an_epoch_that_fails_is_replayed(spark, tmp_path, sides, monkeypatch):
    greeted, clients, users = sides
    path = str(tmp_path / "in")
    frame = lambda conn, no, data: (conn, "10.0.0.1", no, T0, len(data), data, None, None)
    spark.createDataFrame([frame(1, 1, request(1)), frame(4, 0, request(2))], schemas.FRAMES).coalesce(1).write.parquet(path)

    def run():
        query = admission_stream(stream_of(spark, path, schemas.FRAMES), greeted, clients, users, CFG, str(tmp_path / "out"),
                                 str(tmp_path / "check"), available_now=True)
        try:
            query.awaitTermination(120)
        except Exception:       # raised in the epoch below
            pass
        return query

    run()
    spark.createDataFrame([frame(1, 0, ping(1)), frame(1, 2, request(3))], schemas.FRAMES).coalesce(1).write.mode("append").parquet(path)
    with monkeypatch.context() as broken:
        def fail(*_):
            raise RuntimeError("lost")
        broken.setattr(admission, "bad_pings", fail)    # after verdicts, held frames and frames of the epoch are written
        assert run().exception() is not None
    query = run()
    got = admission_tables(spark, str(tmp_path / "out"), query.id)
    assert table(got.frames, "conn_id", "frame_no") == [(1, 1), (1, 2)]
    assert table(got.pending, "conn_id", "frame_no") == [(4, 0)] and got.rejects.count() == 0
    assert table(got.verdicts, "conn_id", "ok") == [(1, True)]


def test_silent_connections_are_forgotten(spark, tmp_path, sides):
    greeted, clients, users = sides
    path = str(tmp_path / "in")
    frame = lambda conn, no, data: (conn, "10.0.0.1", no, T0, len(data), data, None, None)

    def run(*rows):
        spark.createDataFrame(rows, schemas.FRAMES).coalesce(1).write.mode("append").parquet(path)
        query = admission_stream(stream_of(spark, path, schemas.FRAMES), greeted, clients, users, CFG, str(tmp_path / "out"),
                                 str(tmp_path / "check"), forget="1 SECOND", available_now=True)
        query.awaitTermination(120)
        return admission_tables(spark, str(tmp_path / "out"), query.id)

    run(frame(1, 0, ping(1)), frame(3, 0, ping(3)))
    run(frame(3, 1, request(1)))
    got = run(frame(1, 1, request(2)))      # connection 1 was silent for longer than an epoch takes
    assert table(got.pending, "conn_id", "frame_no") == [(1, 1)]
    assert table(got.frames, "conn_id", "frame_no") == [(3, 1)]


def test_unacked_from_the_wire(spark, tmp_path):
    """Acks in a stream of their own; a request is given once both have passed its time."""
    at = lambda s: T0 + dt.timedelta(seconds=s)
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    acked = "conn_id BIGINT, frame_no BIGINT, chunk STRING, acked_ts TIMESTAMP"
    put([(1, "a", k, at(10 * k), request(k)) for k in range(4)], schemas.SEGMENTS, "in")
    put([(1, 0, "0", at(5)), (1, 1, "1", at(10 + 61))], acked, "acks")

    def run():
        requests = decode_requests(reassemble_stream(read_segments(spark, str(tmp_path / "in"), stream=True))).drop("entries")
        out = unacked(requests, stream_of(spark, str(tmp_path / "acks"), acked), "1 minute", late="2 minutes")
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)
        return sorted(r.frame_no for r in spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect())

    assert run() == []
    put([(1, 2, "2", at(20 + 60)), (1, 9, "9", at(1000))], acked, "acks")
    assert run() == []                      # the requests' own time stands still
    put([(1, "a", 4, at(1000), request(4))], schemas.SEGMENTS, "in")
    put([(1, 8, "8", at(1000))], acked, "acks")     # a restarted query waits for news from both
    assert run() == [1, 3]


def test_a_micro_batch_of_one_file_is_worked_by_many_tasks(spark, tmp_path, sides):
    """One row group of the source is one task; what follows must not be."""
    greeted, clients, users = sides
    rows = [(6, "10.0.0.1", n, T0, 3, b"\x93\xa1t\xc0", None, None) for n in range(4000)]
    frames = spark.createDataFrame(rows, schemas.FRAMES).coalesce(1)
    frames.write.parquet(str(tmp_path / "in"))
    query = admission_stream(stream_of(spark, str(tmp_path / "in"), schemas.FRAMES), greeted, clients, users, CFG,
                             str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    query.awaitTermination()
    found = admission_tables(spark, str(tmp_path / "out"), query.id).frames
    assert found.count() == len(rows)
    assert found.select(F.input_file_name()).distinct().count() > 1


def test_passwords_in_use_are_found_by_many_tasks(spark):
    """A name with few pings and many passwords isn't tried by one task."""
    from sluiceway.operators.admission import _in_use
    salt = b"s"
    tried = spark.createDataFrame(
        [(c, "u", salt, sha(salt, "u", f"p{c}")) for c in range(40)] + [(99, "u", salt, None), (98, "v", salt, sha(salt, "v", "none"))],
        "conn_id LONG, username STRING, user_salt BINARY, password_digest STRING")
    known = spark.createDataFrame([(u, f"p{k}") for u in "uv" for k in range(3000)], "username STRING, password STRING")
    where = known.sparkSession.conf.get("spark.sql.shuffle.partitions")
    plan = _in_use(tried, known)
    got = {r["username"]: set(r["passwords"]) for r in plan.collect()}
    assert list(got) == ["u"] and len(got["u"]) > 10 and got["u"] <= {f"p{k}" for k in range(40)}
    text = plan._jdf.queryExecution().toString()
    assert f", {where}), REPARTITION_BY_NUM" in text


def test_the_recorded_streams_have_a_file_for_each_core(spark, tmp_path):
    from sluiceway.plans.streaming_queries import FILES, _spread
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(20_000).withColumnRenamed("id", "conn_id")
    assert _spread(rows, str(tmp_path / "in"), "conn_id") == cores
    assert len(spark.read.parquet(str(tmp_path / "in")).inputFiles()) == FILES * cores
