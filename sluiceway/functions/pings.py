"""Fields of a PING frame (the task side of `decode_pings`)."""

from __future__ import annotations

import struct

import pyarrow as pa

from sluiceway.functions.wire import Corrupt, IllFormed, container, scalar

_FIELDS = ["client_hostname", "key_salt", "key_digest", "username", "password_digest"]
PARSED_DDL = (
    "conn_id BIGINT, remote_addr STRING, frame_no BIGINT, ok BOOLEAN, "
    + ", ".join(f"{f} STRING" for f in _FIELDS))


def _values(frame):
    """The elements of a frame; none if it is not whole."""
    _, items, pos = container(frame, 0)
    values = []
    try:
        for _ in range(items):
            value, pos = scalar(frame, pos)
            values.append(value)
    except (Corrupt, IndexError, KeyError, struct.error):
        return []
    return values if pos <= len(frame) else []


def parse_pings(batches):
    """mapInArrow body over frames that start like a PING."""
    for batch in batches:
        ok, fields = [], []
        for frame in batch.column("frame").to_pylist():
            values = _values(frame)
            good = len(values) == 1 + len(_FIELDS) and all(
                isinstance(v, str) and not isinstance(v, IllFormed) for v in values)
            rest = values[1:]
            ok.append(good)
            fields.append(rest if good else [None] * len(_FIELDS))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conn_id", "remote_addr", "frame_no")]
            + [pa.array(ok, pa.bool_())]
            + [pa.array(c, pa.string()) for c in (zip(*fields) if fields else [[]] * len(_FIELDS))],
            names=["conn_id", "remote_addr", "frame_no", "ok", *_FIELDS])
