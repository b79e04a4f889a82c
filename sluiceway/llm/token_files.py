"""Token ids in ORC files: sorted by document, bit-packed, indexed, read again stripe by stripe.

A file holds rows (row, doc_id, tokens). ORC writes the ids of a stripe with its integer
run-length encoding, keeps a row index every `INDEX_STRIDE` rows and a Bloom filter on
doc_id for each of them; Spark gives each task a range of stripes, and leaves out the ones whose index or
filter rules a wanted document out.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Sequence
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm import texts as tx
from sluiceway.llm.components import stored
from sluiceway.session import shared_folder

END_ID = 2
INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20
SCHEMA = "row BIGINT, doc_id BIGINT, tokens ARRAY<INT>"
#: Words whose ids a worker remembers, twice as many at most, and the length of the longest such word.
KNOWN_WORDS = 150_000
KNOWN_LENGTH = 40
# Signs that are encoded alone where they stand behind a letter or digit; behind other signs they belong to one piece with these.
_BEHIND = b".,!?;:%$#*&"

# Letters that make one piece with each other and that normalizing changes one by one, if at all (tested per tokenizer).
_LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_WORD = re.compile(f"[{_LETTERS}]+")

_encoders: dict[str, list] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Ids of words as bytes, by word; one not met before is encoded when it is looked up.

    A word of plain letters is one piece, so the tokenizer's model gets many of these at once (`learn`), without
    a search for pieces. End signs are encoded apart from a letter or digit.
    """

    def __init__(self, path: str, earlier: dict[bytes, bytes]):
        super().__init__()
        self.path, self.earlier = path, earlier
        self.tokenizer, self.bare, self.pieces = _tokenizer(path)

    def learn(self, words: set[bytes]) -> None:
        """Remember the ids of the words of plain letters among these, end signs aside."""
        if not self.pieces:
            return
        bare = {w.rstrip(_BEHIND) for w in words.difference(self).difference(self.earlier)}
        fresh = [w.decode() for w in bare.difference(self).difference(self.earlier) if len(w) <= KNOWN_LENGTH]
        texts = list(filter(_WORD.fullmatch, fresh))
        for at in range(0, len(texts), 1000):
            part = texts[at:at + 1000]
            found = self.bare.encode(" ".join(part).translate(self.pieces), add_special_tokens=False)
            ids = array("I", found.ids).tobytes()
            ends = np.searchsorted(found.word_ids, np.arange(len(part) + 1)) * 4
            for text, a, b in zip(part, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                self[text.encode()] = ids[a:b]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(word) <= KNOWN_LENGTH:
            self[word] = ids
        return ids

    def _encode(self, word: bytes) -> bytes:
        text = word.decode()
        bare = word.rstrip(_BEHIND)
        if bare and len(bare) < len(word) and _ends_piece(self.path, bare.decode()[-1]):
            return self[bare] + self[word[len(bare):]]
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@cache
def _tokenizer(path: str) -> tuple:
    """The tokenizer of a worker, its model alone for pieces between spaces, and the piece of each plain letter.

    There are no such pieces if the tokenizer doesn't take words of letters whole, letter by letter.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    pieces = lambda text: [x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text))]
    table = {}
    if tokenizer.normalizer and tokenizer.pre_tokenizer and not tokenizer.post_processor:
        alone = [pieces(c) for c in _LETTERS]
        # Each letter beside each at some distance, as contractions and ligatures would show.
        if all(len(x) == 1 for x in alone) and all(
                pieces(_LETTERS[::k]) == ["".join(x[0] for x in alone[::k])] for k in (1, -1, 2, -2, 3, -3)):
            table = {ord(c): x[0] for c, x in zip(_LETTERS, alone, strict=True)}
    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return tokenizer, bare, table


def _encoder(path: str) -> list:
    """The tokenizer of a worker and the ids of words it has met: the latest, which hold those before."""
    if path not in _encoders:
        _encoders[path] = [_tokenizer(path)[0], _Words(path, {})]
    return _encoders[path]


@cache
def _ends_piece(path: str, last: str) -> bool:
    """Whether the tokenizer parts a sign from the character `last` in front of it, as it does behind letters and digits."""
    tokenizer = _encoder(path)[0]
    pieces = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(last + "."))
    return len(pieces) > 1 and pieces[-1][0] == "."


def encode(texts: list[str | None], path: str, end_id: int) -> list[bytes]:
    """The ids of each text as 32-bit little-endian integers, with `end_id` behind.

    ASCII white space separates what this tokenizer encodes: it normalizes characters within a word,
    drops white space and case, and merges within words. So the words of many texts, most of them met
    before, are encoded once each. Texts with the marks of special tokens keep their case, which counts there.
    """
    held = _encoder(path)
    if len(held[1]) > KNOWN_WORDS:
        latest = held[1]
        latest.earlier = {}
        held[1] = _Words(path, latest)
    end = array("I", [end_id]).tobytes()
    split = [(t.encode() if "<|" in t else t.encode().lower()).split() if t else [] for t in texts]
    held[1].learn(set().union(*split))
    ids = held[1].__getitem__
    return [b"".join(map(ids, parts)) + end for parts in split]


def _encode_rows(batches, path: str, end_id: int):
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            ids = encode(batch.column("text").to_pylist(), path, end_id)
            ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), tokens], ["doc_id", "tokens"])


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode `docs(doc_id, text)` to ORC files below `path`, in ascending order of doc_id.

    File after file and row after row the ids go up; a null doc_id comes first, rows with one
    doc_id go by the hash of their text and the text. A null or empty text has the end id alone. Other columns are
    ignored; an empty table makes files without rows. The tokenizer's file must be on every machine.
    """
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    placed = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("h")) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "text").select("doc_id", "text")
    encoded = placed.mapInArrow(partial(_encode_rows, path=tokenizer, end_id=end_id), "doc_id BIGINT, tokens ARRAY<INT>")
    encoded.select(F.monotonically_increasing_id().alias("row"), "doc_id", "tokens").write \
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01") \
        .option("orc.row.index.stride", str(INDEX_STRIDE)).option("orc.stripe.size", str(STRIPE_BYTES)) \
        .option("compression", "zstd").orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """(row, doc_id, tokens) of the files; with `doc_ids`, of these documents only.

    The ids wanted reach the reader, which skips stripes and row groups by range and Bloom filter.
    """
    found = spark.read.schema(SCHEMA).orc(path)
    return found if doc_ids is None else found.filter(F.col("doc_id").isin(list(doc_ids)))


def _describe(batches):
    for batch in batches:
        tokens = batch.column("tokens")
        ends = np.asarray(tokens.offsets).astype(np.int64)
        flat = np.asarray(tokens.values).astype("<u4")
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
            ["row", "doc_id", "n_tokens", "ids_crc32"])


def describe_tokens(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per row of `read_tokens`, `start` counting all ids before.

    The files' parts are summed first, one row each; within a part rows are counted in order.
    """
    spark = tokens.sparkSession
    rows = stored(spark, tokens.mapInArrow(_describe, "row BIGINT, doc_id BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"))
    rows = rows.withColumn("part", F.shiftright("row", 33))
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = stored(spark, parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset")))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row")) - F.col("n_tokens")
    return rows.withColumn("inside", inside).join(parts, "part").select(
        "doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write `docs` to files in the shared folder and describe each document from what they hold."""
    spark = docs.sparkSession
    path = shared_folder(spark) + "-tokens"
    write_tokens(docs, path, tokenizer, end_id)
    return describe_tokens(read_tokens(spark, path))
