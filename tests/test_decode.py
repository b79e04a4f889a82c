"""Request decoding, case by case, and canonical JSON; without Spark."""

import base64
import gzip
import json
import math
import random
import struct
import sys
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from sluiceway.functions.blocks import FRAME_COLUMNS
from sluiceway.functions.requests import decode_batches
from sluiceway.functions.wire import json_text
from test_blocks import pack, values

ARRIVAL = 1_600_000_000_123_456


def decode(*frames):
    rows = [dict(conn_id=1, remote_addr="a", frame_no=i, recv_ts=ARRIVAL, size=len(f), frame=f,
                 error_class=None, detail=None) for i, f in enumerate(frames)]
    return [r for b in decode_batches([pa.RecordBatch.from_pylist(rows, schema=FRAME_COLUMNS)])
            for r in b.to_pylist()]


def one(frame):
    row, = decode(frame)
    return row


def event_time(sec, nanos):
    return b"\xd7\x00" + struct.pack(">ii", sec, nanos)


def entries(row):
    return [(e["time_sec"], e["time_nanos"], e["record"]) for e in row["entries"]]


TWO = [[100, {"key1": "value1"}], [200, {"key2": "value2"}]]
TWO_OUT = [(100, 0, '{"key1":"value1"}'), (200, 0, '{"key2":"value2"}')]
PACKED = b"".join(map(pack, TWO))
NOW = (1_600_000_000, 123_456_000)


@pytest.mark.parametrize("body,mode", [(TWO, "forward"), (PACKED, "packed"), (PACKED.decode("latin1"), None)])
def test_forward_and_packed(body, mode):
    if mode is None:    # packed entries may also come as text
        body, mode = PACKED, "packed"
        frame = b"\x92" + pack("tag") + b"\xd9" + bytes([len(body)]) + body
    else:
        frame = pack(["tag", body])
    row = one(frame)
    assert (row["kind"], row["mode"], row["tag"], row["chunk"], row["compressed"]) == (
        "request", mode, "tag", None, None)
    assert entries(row) == TWO_OUT
    assert [bytes(e["record_raw"]) for e in row["entries"]] == [pack(e[1]) for e in TWO]


def test_options():
    row = one(pack(["tag", TWO, {"chunk": "123456789", "unknown": "mofu"}]))
    assert (row["chunk"], row["compressed"]) == ("123456789", None)
    row = one(pack(["tag", PACKED, {"compressed": "gzip"}]))
    assert row["compressed"] == "gzip" and entries(row) == TWO_OUT
    row = one(pack(["tag", 100, {"key": "value"}, {"chunk": "c", "compressed": "x"}]))
    assert (row["mode"], row["chunk"], row["compressed"]) == ("message", "c", "x")
    twice = b"\x94" + pack("tag") + pack(100) + pack({}) + b"\x82" + pack("chunk") + pack("a") + pack("chunk") + pack("b")
    assert one(twice)["chunk"] == "a"
    other = b"\x94" + pack("tag") + pack(1) + pack({}) + b"\x83" + pack(b"chunk") + pack("a") + pack(5) + pack(1) + pack("x") + pack([1, {"y": 2}])
    assert one(other)["kind"] == "request" and one(other)["chunk"] is None


@pytest.mark.parametrize("time,want", [
    (pack(100), (100, 0)),
    (event_time(999, 334), (999, 334)),
    (pack(0), NOW), (event_time(0, 334), NOW), (pack(None), NOW), (event_time(1, -1), NOW),
    (event_time(0, 1_500_000_000), (1, 500_000_000)),
    (event_time(-5, -1), (-6, 999_999_999)),
    (pack(-7), (-7, 0)),
    (pack(31556889864403199), (31556889864403199, 0)),
])
def test_times(time, want):
    row = one(b"\x93" + pack("tag") + time + pack({}))
    assert entries(row) == [(*want, "{}")]
    ts = row["entries"][0]["event_ts"]
    if want[0] > 9223372036854:
        assert ts is None
    else:
        assert int(ts.timestamp()) == math.floor(want[0] + want[1] / 1e9) or want[0] < 0


@pytest.mark.parametrize("frame,error", [
    (pack({}), "NOT_ARRAY"), (pack("x"), "NOT_ARRAY"),
    (pack([]), "TOO_SHORT"), (pack(["only_tag"]), "TOO_SHORT"), (pack(["without_record", 100]), "TOO_SHORT"),
    (pack(["without_record", {}]), "TOO_SHORT"),
    (pack([500, 100, {}]), "BAD_TAG"), (b"\x93\xa1\xff" + pack(1) + pack({}), "BAD_TAG"),
    (pack([b"bin", 100, {}]), "BAD_TAG"), (pack([500, 100]), "BAD_TAG"),
    (pack(["tag", 2 ** 64 - 1, {}]), "BAD_TIME"), (pack(["tag", 1.5, {}]), "BAD_TIME"),
    (pack(["tag", True, {}]), "BAD_TIME"), (pack(["tag", {}, {}]), "BAD_TIME"),
    (pack(["tag", (1, b"12345678"), {}]), "BAD_TIME"), (pack(["tag", (0, b"1234"), {}]), "BAD_TIME"),
    (pack(["tag", 31556889864403200, {}]), "BAD_TIME"),
    (pack(["tag", 100, [1]]), "BAD_RECORD"), (pack(["tag", 100, None]), "BAD_RECORD"),
    (pack(["tag", 100, {}, [1]]), "BAD_OPTION"), (pack(["tag", 100, {}, None]), "BAD_OPTION"),
    (pack(["tag", TWO, {"chunk": 5}]), "BAD_OPTION"), (pack(["tag", TWO, {"chunk": None}]), "BAD_OPTION"),
    (pack(["tag", TWO, {"compressed": b"x"}]), "BAD_OPTION"),
    (pack(["tag", [*TWO, 5]]), "BAD_ENTRY"), (pack(["tag", [*TWO, []]]), "BAD_ENTRY"),
    (pack(["tag", [*TWO, [1]]]), "BAD_ENTRY"), (pack(["tag", [*TWO, ["x"]]]), "BAD_TIME"),
    (pack(["tag", [TWO[0], [1, 2], TWO[1]]]), "BAD_RECORD"),
    (pack(["tag", gzip.compress(PACKED), {"compressed": "gzip"}]), "BAD_ENTRY"),
    (pack(["tag", PACKED[:-1]]), "BAD_PACKED"), (pack(["tag", PACKED + b"\xc1"]), "BAD_PACKED"),
])
def test_rejects(frame, error):
    good = pack(["tag", 1, {}])
    rows = decode(good, frame, good)
    assert [r["kind"] for r in rows] == ["request", "reject", "request"]
    assert rows[1]["error_class"] == error and rows[1]["detail"] and rows[1]["frame"] == frame
    assert rows[1]["entries"] is None


@given(st.one_of(st.binary(max_size=60), st.builds(
    lambda v, cut, byte, at: (pack(["t", [[1, {"k": v}]] * 2, {"chunk": "c"}])[:cut] + bytes([byte]) + pack(v))[:at],
    values, st.integers(0, 200), st.integers(0, 255), st.integers(0, 300))))
@settings(max_examples=500, deadline=None)
def test_no_bytes_break_the_task(raw):
    row = one(raw)
    assert (row["kind"] == "reject") == (row["error_class"] is not None)


def test_heartbeat_empty_requests_and_extra_elements():
    assert one(b"\xc0")["kind"] == "heartbeat"
    assert entries(one(pack(["tag", [], {"chunk": "c"}]))) == []
    assert entries(one(pack(["tag", b""]))) == []
    assert entries(one(pack(["tag", [[1, {}, "more", [1]], [2, {}]]]))) == [(1, 0, "{}"), (2, 0, "{}")]
    assert one(pack(["tag", 1, {}, {"chunk": "c"}, 5]))["chunk"] == "c"


@pytest.mark.parametrize("depth", [150, 199, 200, 201, 600, 5000])
def test_any_depth_is_decoded(depth):
    nested, text = pack(1), "1"
    for i in range(depth):
        if i % 3 == 0:
            nested, text = b"\x82" + pack("b") + nested + pack("a") + b"\x90", '{"a":[],"b":' + text + "}"
        else:
            nested, text = b"\x92" + nested + b"\x80", "[" + text + ",{}]"
    row = one(b"\x93" + pack("tag") + pack(1) + b"\x81" + pack("k") + nested)
    assert entries(row) == [(1, 0, '{"k":' + text + "}")]


def simple(value):
    if isinstance(value, float):
        return value if math.isfinite(value) else {math.inf: "Infinity", -math.inf: "-Infinity"}.get(value, "NaN")
    if isinstance(value, bytes):
        return base64.b64encode(value).decode()
    if isinstance(value, tuple):
        return {"$ext": value[0], "data": base64.b64encode(value[1]).decode()}
    if isinstance(value, list):
        return [simple(v) for v in value]
    if isinstance(value, dict):
        return {k: simple(v) for k, v in value.items()}
    return value


@given(values)
@settings(max_examples=400, deadline=None)
def test_json_equals_the_standard_encoder(value):
    raw = pack(value)
    text, end = json_text(raw, 0)
    assert end == len(raw)

    def order(v):
        if isinstance(v, list):
            return [order(x) for x in v]
        return {k: order(v[k]) for k in sorted(v)} if isinstance(v, dict) and "$ext" not in v else v

    assert text == json.dumps(order(simple(value)), separators=(",", ":"), ensure_ascii=False)


def test_json_details():
    text = lambda raw: json_text(raw, 0)[0]
    assert text(b"\x82" + pack("a") + pack(1) + pack("a") + pack(2)) == '{"a":2}'
    assert text(b"\x82" + pack(5) + pack(1) + pack([1]) + pack(2)) == '{"5":1,"[1]":2}'
    assert text(b"\xa2\xff\x41") == '"�A"'
    assert text(b"\xca\x3f\x80\x00\x00") == "1.0"
    assert text(pack(2 ** 64 - 1)) == "18446744073709551615"


def test_a_large_batch_is_decoded_in_slices():
    """What lies in memory as Python objects goes by bytes, not by the rows Spark puts in a batch."""
    frame = pack(["tag", [[i, {"k": "x" * 20}] for i in range(100)]])
    n = 2000
    batch = pa.RecordBatch.from_arrays(
        [pa.array([v] * n, f.type) for v, f in zip((1, "a", 0, 0, len(frame), frame, None, None), FRAME_COLUMNS)],
        schema=FRAME_COLUMNS)
    parts, held = [], 0
    tracemalloc.start()
    for part in decode_batches(iter([batch])):
        parts.append(part.num_rows)
        held = max(held, part.get_total_buffer_size())
        assert part.column("entries")[0].as_py()[99]["time_sec"] == 99
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(parts) == n and max(parts) < n / 3
    assert peak < 48 << 20 and held < 16 << 20


ODD = [0, 5, 127, 128, 2 ** 40, 0.0, -0.0, 1e300, 0.1, math.nan, math.inf, -math.inf, None, True, "x", [1], {"a": 1}]


def test_maps_of_a_known_layout_give_the_same_text():
    """Each value in each place of a map, among enough like it that layouts are learnt and others put in their place."""
    rng = random.Random(5)
    frames, want = [], []
    for n in range(6000):
        keys = ["value", "%", "ä", "k"][:rng.randint(1, 4)] if n % 3 else ["value", "k"]
        record = {k: 0.5 + n if k == "value" else n for k in keys}
        if n % 5 == 0:
            record[rng.choice(keys)] = rng.choice(ODD)
        raw = pack(record)
        if n % 11 == 0:     # a key twice
            raw = b"\x83" + pack("k") + pack(n) + pack("value") + pack(0.25) + pack("k") + b"\xcc\xfe"
        if n % 13 == 0:
            raw = b"\x82" + pack("f") + b"\xca" + struct.pack(">f", 0.1) + pack("i") + b"\xd1" + struct.pack(">h", -n)
        entry = b"\x92" + event_time(n + 1, 7) + raw
        frames += [b"\x93" + pack("t") + entry[1:], b"\x92" + pack("t") + b"\x92" + entry + entry,
                   b"\x92" + pack("t") + b"\xc5" + struct.pack(">H", 2 * len(entry)) + 2 * entry]
        want += 3 * [(n + 1, 7, json_text(raw, 0)[0])]
    got = decode(*frames)
    assert {r["kind"] for r in got} == {"request"}
    assert [entries(r)[-1] for r in got] == want
    assert all(len(set(entries(r))) == 1 for r in got)
    short = decode(*(f[:-1] for f in frames[-3:]), b"\x92" + pack("t") + b"\xc4\x14" + frames[-1][-20:])
    assert {r["kind"] for r in short} == {"reject"}


def test_records_of_one_layout_are_read_in_one_step():
    frames = [pack(["t", [[i, {"id": 1000 + i, "v": i / 7}] for i in range(100)]]) for _ in range(20)]
    frames += [b"\x93" + pack("t") + event_time(9, 9) + pack({"id": 1000 + i, "v": i / 7}) for i in range(2000)]
    calls = 0

    def count(frame, event, _):
        nonlocal calls
        calls += event == "call" and frame.f_code.co_name == "json_text"

    sys.setprofile(count)
    try:
        decode(*frames)
    finally:
        sys.setprofile(None)
    assert calls < 500
