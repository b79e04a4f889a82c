"""Framing of one block of a connection, and the walk that chains blocks together.

A *block* is a run of consecutive segments of one connection. Blocks of the same
connection are scanned by different tasks: all but the first start at a guessed value
boundary. `walk_blocks` goes over the blocks' states, without their bytes, to say what
each block must continue; `check_heads` then tests the guesses, each on its own.
These functions take and give Arrow batches so that they run inside `mapInArrow`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sluiceway.functions.wire import Corrupt, advance, guess_boundary

CHUNK_TOO_LARGE = "CHUNK_TOO_LARGE"
CORRUPT_FRAME = "CORRUPT_FRAME"
SEQUENCE_GAP = "SEQUENCE_GAP"
INCOMPLETE = "INCOMPLETE"
#: Not a fault: how a connection stands that may go on, for one that does (see `open_detail`).
OPEN = "OPEN"

GAP_DETAIL = "a segment is missing; later bytes cannot be placed"

_TS = pa.timestamp("us", tz="UTC")

FRAME_COLUMNS = pa.schema([
    ("conn_id", pa.int64()), ("remote_addr", pa.string()), ("frame_no", pa.int64()),
    ("recv_ts", _TS), ("size", pa.int64()), ("frame", pa.binary()),
    ("error_class", pa.string()), ("detail", pa.string()),
])

SUMMARY_DDL = (
    "conn_id BIGINT, remote_addr STRING, block BIGINT, first_seq BIGINT, segments BIGINT, size BIGINT, gap BOOLEAN, "
    "entry_need BIGINT, entry_skip BIGINT, entry_part BINARY, "
    "boundary BOOLEAN, head_size BIGINT, frames BIGINT, tail_size BIGINT, "
    "exit_need BIGINT, exit_skip BIGINT, exit_part BINARY, "
    "error_class STRING, detail STRING, fault_us BIGINT, "
    "first_us BIGINT, head_us BIGINT, tail_us BIGINT, last_us BIGINT, "
    "head BINARY, tail BINARY"
)
# What a block must continue, and whether the block is known not to do so. Without `need` it continues the
# block before it, which is scanned first.
DOUBT_DDL = "conn_id BIGINT, block BIGINT, need BIGINT, skip BIGINT, part BINARY, wrong BOOLEAN"
# Where a block's own values start (-1: nowhere), the number of the first of them, and the
# numbers of the values its head and tail belong to.
PLAN_DDL = (
    "conn_id BIGINT, block BIGINT, start BIGINT, base BIGINT, head_of BIGINT, tail_of BIGINT")
# Values over several blocks and faults; their bytes are put together from heads and tails.
VALUE_DDL = (
    "conn_id BIGINT, remote_addr STRING, frame_no BIGINT, recv_us BIGINT, "
    "error_class STRING, detail STRING")
# Both kinds in one table.
FINAL_DDL = (
    "kind STRING, conn_id BIGINT, block BIGINT, start BIGINT, base BIGINT, head_of BIGINT, tail_of BIGINT, "
    "remote_addr STRING, frame_no BIGINT, recv_us BIGINT, error_class STRING, detail STRING")

#: The most bytes of a value: more has no place in a row.
ROW_BYTES = (1 << 31) - 64
#: The most bytes of frames in one Arrow batch, whose offsets are of 32 bits.
BATCH_BYTES = 1 << 26
#: The most bytes of an incoming batch that are Python objects at a time, and what a row counts besides its bytes.
SLICE_BYTES = 1 << 20
SLICE_ROW = 64


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"BIGINT": pa.int64(), "STRING": pa.string(), "BOOLEAN": pa.bool_(), "BINARY": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


SUMMARY = arrow_schema(SUMMARY_DDL)
THIN_COLUMNS = [n for n in SUMMARY.names if n not in ("head", "tail")]


@dataclass
class Block:
    conn_id: int
    remote_addr: str | None
    block: int
    first_seq: int          # number of the first segment that belongs here
    control: tuple | None   # (a, b, bytes) of the control row that precedes the segments
    buf: bytes              # payload of the gap-free run of segments
    ends: np.ndarray        # end offset of each of those segments in `buf`
    us: np.ndarray          # arrival of each of those segments, in epoch microseconds
    first_us: int | None    # arrival of the first segment present, gap or not
    gap: bool               # a segment is missing inside the block

    def arrival(self, offset: int) -> int:
        """Arrival time of the segment that holds the byte at ``offset``."""
        return int(self.us[np.searchsorted(self.ends, offset, side="right")])


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Group rows sorted by (conn_id, block, seq) into blocks; rows may span batches.

    Block 0 begins with segment 0 of its connection, another one with whatever segment comes first.
    """
    key, rows = None, []

    def build():
        control = next((r[2:5] for r in rows if r[1] < 0), None)
        seen = [r for r in rows if r[1] >= 0]
        first = seen[0][1] if seen and key[1] else 0
        expected, kept = first, []
        for row in seen:
            if row[1] == expected:
                kept.append(row)
                expected += 1
            elif row[1] > expected:
                break
        payloads = [r[4] or b"" for r in kept]
        return Block(
            key[0], next((r[0] for r in seen if r[0] is not None), None), key[1], first, control,
            b"".join(payloads), np.cumsum([len(p) for p in payloads], dtype=np.int64),
            np.array([r[5] for r in kept], dtype=np.int64),
            seen[0][5] if seen else None, bool(seen) and seen[-1][1] >= expected,
        )

    for batch in slices(batches, "payload"):
        conn = batch.column("conn_id").to_numpy(zero_copy_only=False)
        block = batch.column("block").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(conn) != 0) | (np.diff(block) != 0)) + 1
        table = list(zip(*(batch.column(name).to_pylist() for name in (
            "remote_addr", "seq", "ctl_a", "ctl_b", "payload", "recv_us"))))
        for lo, hi in zip([0, *cuts], [*cuts, len(table)]):
            here = (int(conn[lo]), int(block[lo]))
            if here != key:
                if key is not None:
                    yield build()
                key, rows = here, []
            rows.extend(table[lo:hi])
    if key is not None:
        yield build()


@dataclass
class Scan:
    bounds: list            # start of the first value, then the end of each complete value
    fault: tuple | None     # (error class, detail, offset whose segment dates the fault)
    need: int = 0           # state of the unfinished value at the end of the bytes
    skip: int = 0
    part: bytes = b""


def scan_values(buf: bytes, start: int, limit: int | None, resume=None) -> Scan:
    """Boundaries of the values in ``buf[start:]`` and the state of the unfinished one.

    ``resume`` is the ``(pos, need)`` an earlier pass over the first value got to.
    """
    end, pos, bounds = len(buf), start, [start]
    if limit is not None and end - start <= limit:
        limit = None        # nothing here can exceed it
    at, need = resume or (start, 1)
    while pos < end:
        try:
            reached, need = advance(buf, at, need)
        except Corrupt as bad:
            if limit is not None and bad.pos - pos >= limit:
                return Scan(bounds, _too_large(limit, pos))
            return Scan(bounds, (CORRUPT_FRAME, str(bad), bad.pos))
        done = not need and reached <= end
        if limit is not None and min(reached, end) - pos > limit or (
                limit is not None and not done and end - pos > limit):
            return Scan(bounds, _too_large(limit, pos))
        if not done:
            return Scan(bounds, None, need, max(reached - end, 0), buf[reached:])
        bounds.append(reached)
        pos = at = reached
        need = 1
    return Scan(bounds, None)


def _too_large(limit, pos):
    return CHUNK_TOO_LARGE, f"a value is larger than {limit} bytes", pos


def _fault_bytes(kind: str, held: bytes) -> bytes | None:
    return None if kind == CHUNK_TOO_LARGE else held


def _rows(schema: pa.Schema, rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)


def batch_ranges(bounds: np.ndarray, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of values of about ``most`` bytes together; a larger value has a run of its own."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``most`` bytes of a binary column, however many rows Spark sends at once."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for lo, hi in batch_ranges(np.cumsum([0, *(sizes.astype(np.int64) + SLICE_ROW)]), most):
            yield batch.slice(lo, hi - lo)


def _frame_batches(block: Block, scan: Scan, base: int) -> Iterator[pa.RecordBatch]:
    """The complete values of a block, cut out of its bytes without copying each one.

    Each batch's offsets count from its own first byte, so they stay small however large the block is.
    """
    bounds = np.asarray(scan.bounds, dtype=np.int64)
    for lo, hi in batch_ranges(bounds):
        yield _frame_batch(block, bounds[lo:hi + 1], base + lo)


def _frame_batch(block: Block, bounds: np.ndarray, base: int) -> pa.RecordBatch:
    n = len(bounds) - 1
    offsets = (bounds - bounds[0]).astype(np.int32)
    part = memoryview(block.buf)[int(bounds[0]):int(bounds[-1])]
    frames = pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(part)])
    us = block.us[np.searchsorted(block.ends, bounds[1:] - 1, side="right")]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, block.conn_id), pa.int64()),
        pa.array([block.remote_addr] * n, pa.string()),
        pa.array(np.arange(base, base + n), pa.int64()),
        pa.array(us, pa.int64()).cast(_TS),
        pa.array(np.diff(bounds), pa.int64()),
        frames,
        pa.nulls(n, pa.string()),
        pa.nulls(n, pa.string()),
    ], schema=FRAME_COLUMNS)


def open_detail(next_seq: int, began_us: int | None) -> str:
    """Which segment a connection waits for and when its unfinished value began, as JSON."""
    return json.dumps({"next_seq": next_seq, "began_us": began_us})


def frame_blocks(limit: int | None, goes_on: bool = False):
    """mapInArrow body: blocks -> frames.

    A control row says where the first value of a block starts and which number it has;
    a block without one is a whole connection, whose faults are reported here too. With ``goes_on`` a
    connection that is cut off or lacks a segment gives an `OPEN` row with its unfinished bytes, as does one without any.
    """

    def run(batches):
        for block in read_blocks(batches):
            if block.control is not None:
                start, base, _ = block.control
                if start < 0 or not len(block.us):
                    continue
                yield from _frame_batches(block, scan_values(block.buf, start, limit), base)
                continue
            scan = scan_values(block.buf, 0, limit)
            yield from _frame_batches(block, scan, 0)
            fault = _closing_fault(block, scan, goes_on)
            if fault:
                yield _rows(FRAME_COLUMNS, [fault])

    return run


def _closing_fault(block: Block, scan: Scan, goes_on: bool = False):
    held = block.buf[scan.bounds[-1]:]
    if scan.fault:
        kind, detail, at = scan.fault
        us, held = block.arrival(at), _fault_bytes(kind, block.buf[scan.bounds[-1]:at + 1])
    elif goes_on:
        began = block.arrival(scan.bounds[-1]) if held else None
        kind, detail = OPEN, open_detail(block.first_seq + len(block.us), began)
        us = int(block.us[-1]) if len(block.us) else block.first_us
    elif block.gap:
        kind, detail = SEQUENCE_GAP, GAP_DETAIL
        us = int(block.us[-1]) if len(block.us) else block.first_us
    elif held:
        kind, detail, us = INCOMPLETE, incomplete_detail(len(held)), int(block.us[-1])
    else:
        return None
    return (block.conn_id, block.remote_addr, len(scan.bounds) - 1, us,
            None if held is None else len(held), held, kind, detail)


def incomplete_detail(size):
    return f"{size} bytes of an unfinished value"


def summarise_blocks(limit: int | None):
    """mapInArrow body: one row per block with its ends (head, tail) and its exit state.

    A block whose control row has no state goes on from the block before it in the same task.
    """

    def run(batches):
        leave = None
        for block in read_blocks(batches):
            if block.control is not None and block.control[0] is None:
                block.control = leave
            row = _rows(SUMMARY, [_summary(block, limit)])
            leave = tuple(row.column(c)[0].as_py() for c in ("exit_need", "exit_skip", "exit_part"))
            yield row

    return run


def _summary(block: Block, limit: int | None):
    buf, fault = block.buf, None
    entry = (None, None, None)
    if block.control is not None:
        need, skip, part = block.control
        entry = (need, skip, part)
        part = part or b""
        data = part + buf
        start = None
        try:
            reached, need = advance(data, skip, need)
            if not need and reached <= len(data):
                start = reached - len(part)
            else:
                inside = (need, max(reached - len(data), 0), data[reached:])
        except Corrupt as bad:
            fault = (CORRUPT_FRAME, str(bad), bad.pos - len(part))
            inside = (0, 0, b"")
    elif block.first_seq == 0:
        start = 0
    else:
        start = guess_boundary(buf)
        inside = (None, None, None)

    if start is not None:
        scan = scan_values(buf, start, limit)
        fault = scan.fault
        boundary, head, count = True, buf[:start], len(scan.bounds) - 1
        stop = len(buf) if not fault else fault[2] + 1
        tail = buf[scan.bounds[-1]:stop]
        tail_us = block.arrival(scan.bounds[-1]) if scan.bounds[-1] < len(buf) else None
        leave = (scan.need, scan.skip, scan.part)
    else:
        boundary, count, tail, tail_us, leave = False, 0, b"", None, inside
        head = buf if not fault else buf[:fault[2] + 1]
    return (
        block.conn_id, block.remote_addr, block.block, block.first_seq, len(block.us), len(buf), block.gap,
        *entry, boundary, len(head), count, len(tail), *leave,
        fault and fault[0], fault and fault[1],
        block.arrival(fault[2]) if fault else None,
        block.first_us,
        block.arrival(len(head) - 1) if head else None, tail_us,
        int(block.us[-1]) if len(block.us) else None, head, tail,
    )


class _Walk:
    """State carried along the blocks of one connection."""

    def __init__(self, conn_id, remote_addr):
        self.conn_id, self.remote_addr = conn_id, remote_addr
        self.need, self.skip, self.part = 0, 0, b""
        self.held, self.held_us = 0, None       # size and arrival of the unfinished value
        self.frame_no, self.next_seq = 0, 0
        self.dead, self.lost, self.closed = False, False, False
        self.last_us = None

    def value(self, us, kind=None, detail=None):
        return self.conn_id, self.remote_addr, self.frame_no, us, kind, detail

    def fail(self, us, kind, detail):
        self.dead = True
        return self.value(us, kind, detail)

    def hold(self, size, us):
        if not self.held:
            self.held_us = us
        self.held += size


def _fit(walk: _Walk, row: dict):
    """How the block continues what came before it: ``(fit, new state, to be checked)``.

    'ends'   the unfinished value ends exactly where the block's first value starts,
    'inside' the whole block lies inside the unfinished value (new state given),
    None     the block must be scanned again from the state that really precedes it; a
             new state is given if the bytes do not matter for it.
    """
    now = (walk.need, walk.skip, walk.part)
    leave = (row["exit_need"], row["exit_skip"], row["exit_part"])
    if row["entry_need"] is not None and (
            row["entry_need"], row["entry_skip"], row["entry_part"]) == now:
        return ("ends", None, False) if row["boundary"] else ("inside", leave, False)
    if not row["size"]:
        return "inside", now, False
    if not walk.need and not walk.skip:
        return ("ends", None, False) if row["boundary"] and not row["head_size"] else (None, None, False)
    beyond = walk.skip - row["size"]
    if beyond > 0 or (beyond == 0 and walk.need):
        known = not row["boundary"] and not row["error_class"]     # then `head` is the block
        return "inside" if known else None, (walk.need, beyond, b""), False
    if row["boundary"]:
        return "ends", None, True
    return None, None, False


def check_heads(batches):
    """mapInArrow body over doubts joined with `head`: those whose guess was wrong."""
    names = [c.split()[0] for c in DOUBT_DDL.split(", ")]
    for batch in batches:
        wrong = []
        for row in batch.to_pylist():
            data = row["part"] + row["head"]
            try:
                good = advance(data, row["skip"], row["need"]) == (len(data), 0)
            except Corrupt:
                good = False
            if not good:
                wrong.append(tuple({**row, "wrong": True}[n] for n in names))
        yield _rows(arrow_schema(DOUBT_DDL), wrong)


def walk_blocks(limit: int | None, want: str, goes_on: bool = False):
    """mapInArrow body over `THIN_COLUMNS` sorted by (conn_id, block).

    ``want``: 'doubt', or 'final' for the plan and the values once there are no doubts; see the DDL of each above.
    """
    schema = arrow_schema({"doubt": DOUBT_DDL, "final": FINAL_DDL}[want])
    rows = []

    def emit(kind, row):
        if kind == want:
            rows.append(row)
        elif want == "final" and kind == "plan":
            rows.append((kind, *row, None, None, None, None, None))
        elif want == "final" and kind == "value":
            rows.append((kind, row[0], None, None, None, None, None, *row[1:]))

    def gap(walk, us):
        if goes_on:
            return leave(walk, us)
        return walk.fail(us, SEQUENCE_GAP, GAP_DETAIL)

    def leave(walk, us):
        return walk.fail(us, OPEN, open_detail(walk.next_seq, walk.held_us if walk.held else None))

    def too_large(walk):
        return walk.fail(walk.held_us, *_too_large(limit, 0)[:2])

    def over(walk):
        return limit is not None and walk.held > limit

    def plan(walk, row, start=-1, base=0, head_of=None, tail_of=None):
        emit("plan", (walk.conn_id, row["block"], start, base, head_of, tail_of))

    def step(walk: _Walk, row: dict):
        if walk.lost:
            # Blocks without a guess of their own can be read on from the lost one.
            walk.closed = walk.closed or row["exit_need"] is not None
            if not walk.closed:
                emit("doubt", (walk.conn_id, row["block"], None, None, None, True))
            return None
        if walk.dead:
            return plan(walk, row)
        if row["first_seq"] != walk.next_seq:
            us = walk.last_us if walk.last_us is not None else row["first_us"]
            emit("value", gap(walk, us))
            return plan(walk, row)
        walk.next_seq += row["segments"]

        fit, state, check = _fit(walk, row)
        if fit is None or check:
            emit("doubt", (walk.conn_id, row["block"], *(walk.need, walk.skip, walk.part), not fit))
        if fit is None:
            # Go on as well as is known, so that one round finds every other wrong block too.
            if state is not None:
                walk.hold(row["size"], row["first_us"])
                walk.need, walk.skip, walk.part = state
                return None
            if row["exit_need"] is None:
                walk.lost = True
                return None
            fit = "ends" if row["boundary"] else "inside"
            state = (row["exit_need"], row["exit_skip"], row["exit_part"])

        if row["last_us"] is not None:
            walk.last_us = row["last_us"]
        number = walk.frame_no
        if fit == "inside":
            walk.hold(row["head_size"], row["first_us"])
            plan(walk, row, head_of=number)     # no value starts in this block
            if row["error_class"]:
                emit("value", too_large(walk) if over(walk) else walk.fail(
                    row["fault_us"], row["error_class"], row["detail"]))
                return None
            walk.need, walk.skip, walk.part = state
        else:
            if walk.held:
                walk.hold(row["head_size"], None)
                if over(walk):
                    emit("value", too_large(walk))
                    return plan(walk, row)
                emit("value", walk.value(row["head_us"]))
                walk.held = 0
                walk.frame_no += 1
            base = walk.frame_no
            walk.frame_no += row["frames"]
            plan(walk, row, row["head_size"], base, number, walk.frame_no)
            walk.hold(row["tail_size"], row["tail_us"])
            if row["error_class"]:
                emit("value", walk.fail(row["fault_us"], row["error_class"], row["detail"]))
                return None
            walk.need, walk.skip, walk.part = (
                row["exit_need"], row["exit_skip"], row["exit_part"])
        if over(walk):
            emit("value", too_large(walk))
        elif row["gap"]:
            us = walk.last_us if walk.last_us is not None else row["first_us"]
            emit("value", gap(walk, us))
        return None

    def finish(walk: _Walk | None):
        if walk and goes_on and not walk.dead and not walk.lost:
            emit("value", leave(walk, walk.last_us))
        elif walk and walk.held and not walk.dead and not walk.lost:
            emit("value", walk.fail(walk.last_us, INCOMPLETE, incomplete_detail(walk.held)))

    def run(batches):
        walk = None
        for batch in batches:
            for row in batch.to_pylist():
                if walk is None or walk.conn_id != row["conn_id"]:
                    finish(walk)
                    walk = _Walk(row["conn_id"], row["remote_addr"])
                step(walk, row)
                if len(rows) >= 4096:
                    yield _rows(schema, rows)
                    rows.clear()
        finish(walk)
        if rows:
            yield _rows(schema, rows)
            rows.clear()

    return run


def assemble_values(batches):
    """mapInArrow body over rows sorted by (conn_id, frame_no, ord).

    The first row (`ord` -1) of a value is its `VALUE_DDL` row, the others its bytes. Only
    one value is held at a time.
    """
    value, parts = None, []

    def built():
        held = _fault_bytes(value["error_class"], b"".join(parts))
        return _rows(FRAME_COLUMNS, [(
            value["conn_id"], value["remote_addr"], value["frame_no"], value["recv_us"],
            None if held is None else len(held), held, value["error_class"], value["detail"])])

    for batch in batches:
        for row in batch.to_pylist():
            if row["ord"] < 0:
                if value:
                    yield built()
                value, parts = row, []
            elif value and (row["conn_id"], row["frame_no"]) == (value["conn_id"], value["frame_no"]):
                parts.append(row["payload"])
    if value:
        yield built()
