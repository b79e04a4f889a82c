"""Reassembly on a stream: what a connection has not finished waits in operator state."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from sluiceway.functions.blocks import (
    CHUNK_TOO_LARGE, GAP_DETAIL, INCOMPLETE, SEQUENCE_GAP, incomplete_detail, scan_values)

_OUT = (
    "conn_id BIGINT, remote_addr STRING, frame_no BIGINT, recv_us BIGINT, size BIGINT, "
    "frame BINARY, error_class STRING, detail STRING")
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]
_STATE = (
    "remote_addr STRING, next_seq BIGINT, frame_no BIGINT, dead BOOLEAN, last_us BIGINT, "
    "held BINARY, held_us BIGINT, reached BIGINT, need BIGINT, "
    "wait_seq ARRAY<BIGINT>, wait_us ARRAY<BIGINT>, wait_payload ARRAY<BINARY>")
_FRESH = (None, 0, 0, False, None, b"", None, 0, 1, [], [], [])


def reassemble_stream(segments: DataFrame, max_chunk_bytes: int | None = None,
                      idle: str | None = None) -> DataFrame:
    """`reassemble_frames` for a stream of segments.

    Segments that come too early wait until the gap before them is filled. With ``idle``
    a connection without news for that long is reported as it stands: waiting segments as a
    `SEQUENCE_GAP`, an unfinished value as an `INCOMPLETE`, with all their bytes. Nothing is
    forgotten by that: when the connection goes on, it goes on where it was, and gives the
    frames that the batch form gives. Such a query runs until it is
    stopped, also under an `availableNow` trigger, because the clock alone may report
    connections. A micro-batch of one connection is read by one task, so bound it at the
    source (`maxBytesPerTrigger`).
    """
    timeout_ms = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else None
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    framed = (
        segments.select(
            "conn_id", "remote_addr", "seq", F.unix_micros("recv_ts").alias("recv_us"), "payload")
        .groupBy("conn_id")
        .applyInPandasWithState(
            _body(max_chunk_bytes, timeout_ms), _OUT, _STATE, "append", timeout))
    return framed.select(
        "conn_id", "remote_addr", "frame_no", F.timestamp_micros("recv_us").alias("recv_ts"),
        "size", "frame", "error_class", "detail")


def _body(limit: int | None, timeout_ms: int | None):
    def run(key, parts, state):
        conn_id = int(key[0])
        values = state.get if state.exists else _FRESH
        if state.hasTimedOut:
            state.update(values)    # with no timer: it is reported once, until more comes
            yield _table([r for r in [_closing(conn_id, values)] if r])
            return
        rows, values = _advance(conn_id, values, parts, limit)
        state.update(values)
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        yield _table(rows)

    return run


def _table(rows) -> pd.DataFrame:
    table = pd.DataFrame(rows, columns=_COLUMNS)
    return table.astype({c: "Int64" for c in ("conn_id", "frame_no", "recv_us", "size")})


def _closing(conn_id, values):
    addr, _, frame_no, dead, last_us, held, _, _, _, wait_seq, wait_us, wait_payload = values
    held = b"".join([bytes(held), *map(bytes, wait_payload)])
    if dead:
        return None
    if wait_seq:
        us = last_us if last_us is not None else min(wait_us)
        return conn_id, addr, frame_no, us, len(held), held, SEQUENCE_GAP, GAP_DETAIL
    if held:
        return (conn_id, addr, frame_no, last_us, len(held), held, INCOMPLETE,
                incomplete_detail(len(held)))
    return None


def _advance(conn_id, values, parts, limit):
    """Output rows and new state after the segments of one micro-batch."""
    (addr, next_seq, frame_no, dead, last_us, held, held_us, reached, need,
     wait_seq, wait_us, wait_payload) = values
    held = bytes(held)
    waiting = dict(zip(wait_seq, zip(wait_us, wait_payload)))
    for part in parts:      # a group may come in several pieces, in any order
        if addr is None and len(part):
            addr = part["remote_addr"].iloc[0]
        for seq, us, payload in zip(part["seq"], part["recv_us"], part["payload"]):
            if seq >= next_seq:
                waiting.setdefault(int(seq), (int(us), payload))
    if dead:
        return [], (addr, next_seq, frame_no, True, last_us, b"", None, 0, 1, [], [], [])

    us, payloads = [], []
    while next_seq in waiting:
        arrived, payload = waiting.pop(next_seq)
        us.append(arrived)
        payloads.append(bytes(payload or b""))
        next_seq += 1
    rows = []
    if us:
        last_us = us[-1]
        data = b"".join([held, *payloads])
        ends = len(held) + np.cumsum([len(p) for p in payloads])

        def arrival(offset):
            if offset < len(held):
                return held_us
            return us[int(np.searchsorted(ends, offset, side="right"))]

        scan = scan_values(data, 0, limit, (reached, need) if held else None)
        last = np.searchsorted(ends, np.asarray(scan.bounds[1:], dtype=np.int64) - 1, side="right").tolist()
        for lo, hi, k in zip(scan.bounds, scan.bounds[1:], last):
            rows.append((conn_id, addr, frame_no, us[k] if hi > len(held) else held_us, hi - lo, data[lo:hi], None, None))
            frame_no += 1
        start = scan.bounds[-1]
        if scan.fault:
            kind, detail, at = scan.fault
            frame = None if kind == CHUNK_TOO_LARGE else data[start:at + 1]
            rows.append((conn_id, addr, frame_no, arrival(at), frame and len(frame), frame, kind, detail))
            return rows, (addr, next_seq, frame_no, True, last_us, b"", None, 0, 1, [], [], [])
        if start < len(data):
            held_us = arrival(start)
        held = data[start:]
        reached, need = (
            (len(held) + scan.skip - len(scan.part), scan.need) if held else (0, 1))
    wait = sorted(waiting.items())
    return rows, (
        addr, next_seq, frame_no, False, last_us, held, held_us, reached, need,
        [s for s, _ in wait], [v[0] for _, v in wait], [bytes(v[1] or b"") for _, v in wait])
