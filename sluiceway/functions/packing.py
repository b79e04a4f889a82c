"""MessagePack bytes written by column expressions (acknowledgements, PONGs, test traffic).

Nothing here is shared with the reader in `wire`.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex_bytes(text: str) -> Column:
    return F.unhex(F.lit(text))


def _hex(number: Column, width: int) -> Column:
    return F.lpad(F.hex(number.cast("bigint")), 2 * width, "0")


def _big_endian(number: Column, width: int) -> Column:
    return F.unhex(_hex(number, width))


def _sized(size: Column, small, *steps) -> Column:
    """Header of a sized value: the first step whose limit the size stays below."""
    limit, base = small
    header = F.when(size < limit, F.hex((size + base).cast("bigint"))) if limit else F
    for limit, code, width in steps:
        header = header.when(size < limit, F.concat(F.lit(code), _hex(size, width)))
    return F.unhex(header)


# Fixed values below: first bytes and size limits of the MessagePack format.
def pack_str(text) -> Column:
    raw = _col(text).cast("binary")
    size = F.octet_length(raw)
    return F.concat(_sized(
        size, (32, 0xA0), (1 << 8, "D9", 1), (1 << 16, "DA", 2), (1 << 31, "DB", 4)), raw)


def pack_bin(raw) -> Column:
    raw = _col(raw)
    size = F.octet_length(raw)
    return F.concat(_sized(
        size, (0, 0), (1 << 8, "C4", 1), (1 << 16, "C5", 2), (1 << 31, "C6", 4)), raw)


def array_header(size) -> Column:
    return _sized(_col(size), (16, 0x90), (1 << 16, "DC", 2), (1 << 31, "DD", 4))


def map_header(size) -> Column:
    return _sized(_col(size), (16, 0x80), (1 << 16, "DE", 2), (1 << 31, "DF", 4))


def pack_int(number) -> Column:
    """Positive fixint, or int 64."""
    number = _col(number).cast("bigint")
    return F.when(number.between(0, 127), _big_endian(number, 1)).otherwise(
        F.concat(hex_bytes("D3"), _big_endian(number, 8)))


def pack_event_time(sec, nanos) -> Column:
    """Extension 0 of 8 bytes: signed 32-bit seconds and nanoseconds."""
    four = lambda c: F.unhex(F.right(F.lpad(F.hex(_col(c).cast("bigint")), 16, "0"), F.lit(8)))
    return F.concat(hex_bytes("D700"), four(sec), four(nanos))


@F.pandas_udf(BinaryType())
def _double_bytes(values: pd.Series) -> pd.Series:
    raw = values.to_numpy(dtype=">f8").tobytes()
    return pd.Series([raw[i:i + 8] for i in range(0, len(raw), 8)])


def pack_double(value) -> Column:
    """Spark has no expression for the bits of a double, hence the one vectorised UDF."""
    return F.concat(hex_bytes("CB"), _double_bytes(_col(value).cast("double")))


def join_bytes(pieces) -> Column:
    """All binaries of an array in one."""
    return F.aggregate(
        _col(pieces), F.lit(b""), lambda a, b: F.concat(a, b))


def join_hex(pieces) -> Column:
    """`join_bytes` for long arrays: linear, where repeated concatenation is quadratic."""
    return F.unhex(F.array_join(F.transform(_col(pieces), F.hex), ""))


def joined(column: str, *order: str) -> Column:
    """All binaries of a group in one, in the order of other columns."""
    return F.expr(f"listagg({column}, X'') WITHIN GROUP (ORDER BY {', '.join(order)})")
