"""Pages as WARC archives, the same bytes on every run, and back.

Pages are cut into shards of consecutive pages by a running sum of their sizes in page order, so the
borders follow from the table alone and not from how Spark happened to deal it out. A shard is sorted
and written by one task as gzip members, one record each; files are rolled by their compressed
size. Each attempt of a task writes under names of its own; only the names that Spark's
committer keeps are renamed, and readers see only what the manifest lists, which is written last.
A lost executor therefore leaves at most unlisted files, which go at the end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.components import stored
from sluiceway.operators.joins import measured_join
from sluiceway.operators.running import in_order, running_sum
from sluiceway.session import shared_folder

LEAST_REVISIT = 1000        # shorter payloads are always stored
SHARD_BYTES = 16 << 20      # payload bytes of a shard, at least
MOST_SHARDS = 1 << 16       # so the borders, 29 bytes each, stay below two megabytes
RECORD_BYTES = 512          # what a record counts besides its payload
ROLL_BYTES = 256 << 20      # compressed bytes of a file
DATE = "2000-01-01T00:00:00Z"

# Line end, version and profile of the format.
_END = b"\r\n"
_VERSION = b"WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_WRITTEN = "name STRING, pending STRING, shard BIGINT, roll INT, records BIGINT, bytes BIGINT, sha256 STRING"
_RECORDS = ("file STRING, position BIGINT, record_id STRING, record_type STRING, page_id BIGINT, url STRING, "
            "date STRING, refers_to_id STRING, payload_digest STRING, payload_bytes BIGINT, intact BOOLEAN, payload BINARY")


class Archive(NamedTuple):
    folder: str
    manifest: DataFrame     # name, shard, roll, records, bytes, sha256


def _place(page_id: Column, digest: Column) -> Column:
    """29 bytes that sort as (page_id, nulls first; digest of the payload)."""
    number = F.unhex(F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    head = F.when(page_id.isNull(), F.unhex(F.lit("00" * 9))).otherwise(F.concat(F.unhex(F.lit("01")), number))
    return F.concat(head, F.unhex(digest))


def _page_of(place: bytes) -> int | None:
    return int.from_bytes(place[1:9], "big") - (1 << 63) if place[0] else None


def _record_id(place: bytes, url: str | None, copy: int) -> str:
    """The same name for the same record on every run."""
    told = hashlib.sha256(place + b"\0" + (url or "").encode() + b"\0" + str(copy).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=told[:16], version=5)}>"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _plain(url: str) -> str:
    """A header's value has no control characters or blanks."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member without a time of its own."""
    head = _END.join([_VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None),
                      f"Content-Length: {len(block)}".encode()])
    return zlib.compress(head + _END * 2 + block + _END * 2, 6, wbits=31)


def _http(size: int) -> bytes:
    return _END.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      f"Content-Length: {size}".encode(), b"", b""])


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


class _Files:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, files, base: str, shard: int, roll_bytes: int, date: str):
        self.files, self.base, self.shard, self.roll_bytes, self.date = files, base, shard, roll_bytes, date
        self.roll, self.out = -1, None

    def _open(self) -> None:
        self.roll += 1
        self.name = f"pages-{self.shard:06d}-{self.roll:05d}.warc.gz"
        self.pending = f"{self.name}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(f"{self.base}/pending/{self.pending}", compression=None)
        self.bytes, self.records, self.told = 0, 0, hashlib.sha256()
        told = b"software: sluiceway\r\nformat: WARC File Format 1.1\r\n"
        self._put(_record([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(self.name.encode(), None, 0)),
            ("WARC-Date", self.date), ("WARC-Filename", self.name), ("WARC-Block-Digest", _digest(told)),
            ("Content-Type", "application/warc-fields")], told))

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.told.update(member)
        self.bytes += len(member)

    def add(self, member: bytes) -> Iterator[tuple]:
        if self.out is not None and self.bytes + len(member) > self.roll_bytes and self.records:
            yield from self.close()
        if self.out is None:
            self._open()
        self._put(member)
        self.records += 1

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield self.name, self.pending, self.shard, self.roll, self.records, self.bytes, self.told.hexdigest()


def _members(batches, date: str) -> Iterator[tuple[int, bytes]]:
    """(shard, record) for rows sorted by shard, place, kind and url, largest url first."""
    at, copy, decided = None, 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("shard", "place", "wide", "url", "html", "to_place", "to_url")]
        for shard, place, wide, url, html, to_place, to_url in zip(*columns, strict=True):
            if not wide:        # this payload is held more than once
                decided = (place, to_place, to_url)
                continue
            copy = copy + 1 if at == (place, url) else 0
            payload = (html or "").encode()
            if hashlib.sha1(payload).digest() != place[9:]:
                raise ValueError("payload and digest differ")
            first = at is None or at[0] != place
            at = (place, url)
            target = decided[1:] if decided and decided[0] == place else None
            stored_here = target is None or (target[0] == place and first)
            head = _http(len(payload))
            block = head + payload if stored_here else head
            page = _page_of(place)
            fields = [
                ("WARC-Type", "response" if stored_here else "revisit"), ("WARC-Record-ID", _record_id(place, url, copy)),
                ("WARC-Date", date), ("WARC-Target-URI", None if url is None else _plain(url)),
                ("Page-ID", None if page is None else str(page)), ("WARC-Payload-Digest", _digest(payload)),
                ("WARC-Block-Digest", _digest(block)), ("Content-Type", "application/http;msgtype=response")]
            if not stored_here:
                fields += [
                    ("WARC-Profile", _REVISIT), ("WARC-Refers-To", _record_id(target[0], target[1], 0)),
                    ("WARC-Refers-To-Target-URI", None if target[1] is None else _plain(target[1])),
                    ("WARC-Refers-To-Date", date), ("WARC-Truncated", "length")]
            yield shard, _record(fields, block)


def _write_shards(batches, folder: str, roll_bytes: int, date: str):
    names = [c.split()[0] for c in _WRITTEN.split(", ")]
    files, base = _filesystem(folder)
    out = None

    def told(rows) -> Iterator[pa.RecordBatch]:
        for row in rows:
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, row, strict=True)}, schema=pa.schema([
                (n, {"shard": pa.int64(), "roll": pa.int32(), "records": pa.int64(), "bytes": pa.int64()}.get(n, pa.string()))
                for n in names]))

    for shard, member in _members(batches, date):
        if out is None or out.shard != shard:
            if out:
                yield from told(out.close())
            else:
                files.create_dir(f"{base}/pending", recursive=True)
            out = _Files(files, base, shard, roll_bytes, date)
        yield from told(out.add(member))
    if out:
        yield from told(out.close())


def _publish(batches, folder: str):
    """Give the files that count their names; a second try finds them renamed."""
    files, base = _filesystem(folder)
    for batch in batches:
        for name, pending in zip(batch.column("name").to_pylist(), batch.column("pending").to_pylist(), strict=True):
            try:
                files.move(f"{base}/pending/{pending}", f"{base}/{name}")
            except OSError:
                if files.get_file_info(f"{base}/{name}").type != pafs.FileType.File:
                    raise
        yield batch


def write_warc(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, shard_bytes: int = SHARD_BYTES,
               roll_bytes: int = ROLL_BYTES, date: str = DATE) -> Archive:
    """Write `pages(page_id, url, html)` as WARC files below `folder`, a new one; the manifest comes last.

    Records go by page_id (null first), digest of the payload, url (largest first). Of equal payloads
    of at least `least` bytes the one with the largest page_id, then url, is a response, the others
    revisits of it; of rows equal in all three the first. A null html is an empty payload, a null url
    gives no target, a null page_id no Page-ID. A page of any length is one record; an empty table
    gives a manifest without rows. Other columns are ignored. Equal tables give equal files.
    A file is over `roll_bytes` only if it holds one record.
    """
    spark = pages.sparkSession
    page_id = F.col("page_id").cast("long")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(_place(page_id, F.sha1(html)).alias("place"), F.col("url").cast("string").alias("url"),
                        html.alias("html"))
    narrow = rows.select("place", "url", F.octet_length("html").cast("long").alias("size"))
    ordered = in_order(narrow, ["place"])
    total = ordered.agg(F.sum(F.col("size") + RECORD_BYTES)).first()[0] or 0
    shard_bytes = max(shard_bytes, -(-total // MOST_SHARDS))
    offsets = running_sum(ordered.select("row", "place", (F.col("size") + RECORD_BYTES).alias("counted")), "counted", "before")
    starts = offsets.groupBy(F.floor(F.col("before") / shard_bytes)).agg(F.min("place").alias("start"))
    borders = sorted(bytes(r["start"]) for r in starts.collect())

    large = ordered.filter(F.col("size") >= least).select("place", "url", F.substring("place", 10, 20).alias("digest"))
    shared = large.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("place", "url")).alias("to")).filter("n > 1")
    decided = measured_join(large.select("place", "digest"), shared, ["digest"], "inner", ["place"]).select(
        "place", F.lit(0).alias("wide"), F.col("to.place").alias("to_place"), F.col("to.url").alias("to_url"))

    edges = np.array(borders[1:], dtype="S29")

    @F.pandas_udf("bigint")
    def shard_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, np.array(place.tolist(), dtype="S29"), side="right"))

    both = rows.withColumn("wide", F.lit(1)).unionByName(decided, allowMissingColumns=True)
    dealt = both.withColumn("shard", shard_of("place")).repartitionById(max(len(borders), 1), F.col("shard").cast("int")) \
        .sortWithinPartitions("shard", "place", "wide", F.col("url").desc())
    written = stored(spark, dealt.mapInArrow(partial(_write_shards, folder=folder, roll_bytes=roll_bytes, date=date), _WRITTEN))
    published = written.mapInArrow(partial(_publish, folder=folder), _WRITTEN).drop("pending")
    published.coalesce(1).sortWithinPartitions("shard", "roll").write.json(f"{folder}/manifest")
    files, base = _filesystem(folder)
    if files.get_file_info(f"{base}/pending").type == pafs.FileType.Directory:
        files.delete_dir(f"{base}/pending")
    return open_archive(spark, folder)


def open_archive(spark: SparkSession, folder: str) -> Archive:
    """An archive whose manifest is complete."""
    columns = ", ".join(c for c in _WRITTEN.split(", ") if not c.startswith("pending"))
    return Archive(folder, spark.read.schema(columns).json(f"{folder}/manifest"))


def members(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(position, content) of each gzip member of a file, one at a time in memory."""
    position, held = 0, stream.read(chunk)
    while held:
        reader, content, size = zlib.decompressobj(wbits=31), [], 0
        while not reader.eof:
            held = held or stream.read(chunk)
            if not held:
                raise ValueError("cut off within a record")
            content.append(reader.decompress(held))
            size += len(held) - len(reader.unused_data)
            held = reader.unused_data
        yield position, b"".join(content)
        position += size
        held = held or stream.read(chunk)


def parse_record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = content.partition(_END * 2)
    version, *lines = head.split(_END)
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}
    size = int(fields["content-length"])
    if rest[size:] != _END * 2:
        raise ValueError("block and Content-Length differ")
    return fields, rest[:size]


def _read_files(batches, folder: str, payloads: bool):
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    kinds = {"position": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "intact": pa.bool_(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
    files, base = _filesystem(folder)
    rows, held = [], 0

    def out():
        nonlocal held
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
        rows.clear()
        held = 0
        return batch

    for batch in batches:
        for name in batch.column("name").to_pylist():
            with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                for position, content in members(stream):
                    fields, block = parse_record(content)
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    payload = block.partition(_END * 2)[2] if kind == "response" else None
                    found = None if payload is None else hashlib.sha1(payload).digest()
                    stated = base64.b32decode(fields["warc-payload-digest"].partition(":")[2])
                    page = fields.get("page-id")
                    rows.append((
                        name, position, fields["warc-record-id"], kind, page and int(page), fields.get("warc-target-uri"),
                        fields["warc-date"], fields.get("warc-refers-to"), (found or stated).hex(),
                        None if payload is None else len(payload),
                        _digest(block) == fields["warc-block-digest"] and found in (None, stated),
                        payload if payloads else None))
                    held += len(payload or b"") if payloads else 0
                    if len(rows) >= 10_000 or held > 16 << 20:
                        yield out()
    if rows:
        yield out()


def read_warc(spark: SparkSession, archive: Archive, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the files in the manifest, one task per file.

    `payload_digest` (bare hex) and `payload_bytes` of a response are taken from the bytes read, a revisit has the digest
    it states; `intact` tells whether the digests stated fit the bytes. A file that is cut off or no WARC raises.
    """
    files = archive.manifest.select("name")
    n = max(files.count(), 1)
    spread = files.repartition(n)
    return spread.mapInArrow(partial(_read_files, folder=archive.folder, payloads=payloads), _RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) with revisits led to their response.

    `records` is best a stored table, it is read several times. A revisit whose response is missing or has another
    digest has null payload_bytes and refers_to.
    """
    response = records.filter("record_type = 'response'")
    revisit = records.filter("record_type = 'revisit'").select(
        "page_id", "record_id", F.col("refers_to_id").alias("to"), "payload_digest", "record_type")
    wanted = revisit.select("to").distinct()
    targets = wanted.join(response.select(
        F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("of"), "payload_bytes"), "to")
    led = measured_join(revisit, targets, ["to"], "left", ["record_id"])
    same = F.col("of") == F.col("payload_digest")
    return response.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")) \
        .unionByName(led.select("page_id", F.when(same, F.col("payload_bytes")).alias("payload_bytes"), "payload_digest",
                                "record_type", F.when(same, F.col("refers_to")).alias("refers_to")))


def warc_table(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write the pages to archives in the shared folder and tell each record from what they hold."""
    spark = pages.sparkSession
    archive = write_warc(pages, f"{shared_folder(spark)}-warc", least)
    return resolved(stored(spark, read_warc(spark, archive, payloads=False)))


WARC_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
t AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last <> page_id THEN last END AS refers_to
FROM p LEFT JOIN t USING (payload_digest)"""
