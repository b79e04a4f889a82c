"""Toxicity of texts that hide their words: a noisy channel is decoded, then the restored text scored.

1. A character model: counts of letter triples over all documents.
2. Decoding: a token with digits or signs among its letters, with runs of one letter or with letters
   set apart is a lattice of the characters it may stand for. Viterbi finds the likeliest
   path under the model and the channel's costs. Any other token has one path, itself.
3. A lexicon: restored words and their first letters that labelled documents show to go with
   the label. A document's score is that of its strongest entry.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm import texts as tx
from sluiceway.llm.components import free_name, stored

#: Labelled rows that the lexicon is learnt from, at most; the rows with the smallest hashes of their id.
TRAIN_ROWS = 40_000
#: The chance of a false entry.
FALSE_ENTRIES = 0.02
PREFIXES = (3, 4, 5, 6)
THRESHOLD = 0.7

# What a written character may stand for besides itself: fixed values of the channel.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e", "£": "l", "¡": "i",
}
SIGNS = "".join(STANDS_FOR)
COST_STANDS, COST_DROP, COST_PLAIN = 0.5, 0.3, 4.0
_LETTER = r"[^\W\d_]"
#: Tokens with more than one path: letters mixed with signs, and words with a letter three times in a row.
_MIXED = re.compile(rf"(?<![\w{re.escape(SIGNS)}])[^\W\d{re.escape(SIGNS)}]*+[{re.escape(SIGNS)}\d][\w{re.escape(SIGNS)}]*")
_RUN = re.compile(rf"({_LETTER})\1\1")
#: Four or more single letters or signs with one same separator between them.
_APART = re.compile(rf"(?<![\w{re.escape(SIGNS)}])[\w{re.escape(SIGNS)}](?P<gap>[ .\-_*~/])(?:[\w{re.escape(SIGNS)}](?P=gap)){{2,}}"
                    rf"[\w{re.escape(SIGNS)}](?![\w{re.escape(SIGNS)}])")
_WORD = re.compile(rf"{_LETTER}+")

CLASSES = 28        # a gap, a to z, and any other letter
_CLASS = np.zeros(256, dtype=np.int32)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27


def _letter(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 if ord(c) >= 128 else 0


def _count_triples(batches):
    total = np.zeros(CLASSES ** 3, dtype=np.int64)
    for whole in batches:
        for batch in tx.slices(whole, "text", 1 << 20):
            data, starts = tx.buffers(batch.column("text"))
            # Bytes of one character beyond ASCII count once; a gap parts the texts.
            at = np.flatnonzero((data & 0xC0) != 0x80)
            line = np.insert(_CLASS[data[at]], np.searchsorted(at, starts), 0)
            code = (line[:-2] * CLASSES + line[1:-1]) * CLASSES + line[2:]
            total += np.bincount(code, minlength=CLASSES ** 3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["triple", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log chances of a letter after two others, (CLASSES, CLASSES, CLASSES), from all documents.

    Each task sends one row per triple it saw; no more than CLASSES ** 3 rows reach the driver.
    """
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_triples, "triple INT, n BIGINT")
    counts = np.full(CLASSES ** 3, 0.1)
    for row in rows.groupBy("triple").agg(F.sum("n").alias("n")).collect():
        counts[row["triple"]] += row["n"]
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    return np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)


def decode(token: str, model: list) -> str:
    """The likeliest word behind a token: Viterbi over what its characters may stand for.

    A state is the last two letters of a path. A character that repeats the one before may be
    dropped; signs may stand for letters or for themselves, which ends a word.
    """
    paths = {(0, 0): (0.0, "")}
    before = ""
    for c in token:
        choices = [(c, 0.0)] if c not in STANDS_FOR else \
            [(c, COST_PLAIN)] + [(s, COST_STANDS) for s in STANDS_FOR[c]]
        best: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in paths.items():
            if c == before:
                if (a, b) not in best or cost + COST_DROP < best[a, b][0]:
                    best[a, b] = (cost + COST_DROP, text)
            for s, extra in choices:
                k = _letter(s)
                total = cost + extra - model[(a * CLASSES + b) * CLASSES + k]
                if (b, k) not in best or total < best[b, k][0]:
                    best[b, k] = (total, text + s)
        paths, before = best, c
    return min((cost - model[(a * CLASSES + b) * CLASSES], text) for (a, b), (cost, text) in paths.items())[1]


class Restorer:
    """Restores texts; remembers tokens it has decoded."""

    def __init__(self, model: np.ndarray, limit: int = 100_000):
        self.model, self.limit = model.ravel().tolist(), limit
        self.known: dict[str, str] = {}

    def _token(self, token: str) -> str:
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = decode(token, self.model)
            if len(token) <= 40:
                self.known[token] = found
        return found

    def _mixed(self, match: re.Match) -> str:
        token = match[0]
        return self._token(token) if re.search(_LETTER, token) else token

    def words(self, text: str | None) -> set[str]:
        """The distinct words of the restored text."""
        text = (text or "").lower()
        text = _APART.sub(lambda m: self._token(m[0].replace(m["gap"], "")), text)
        text = _MIXED.sub(self._mixed, text)
        return set(_WORD.findall(text))

    def word(self, word: str) -> str:
        """A word without what its runs of one letter hide."""
        return self._token(word) if _RUN.search(word) else word


def entries(words: set[str]) -> set[str]:
    """What the lexicon may know of a text: whole words, and beginnings of words, marked by a star."""
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


def _count_entries(batches, model: np.ndarray):
    restore = Restorer(model)
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            counts: Counter = Counter()
            for text in batch.column("text").to_pylist():
                counts.update(entries({restore.word(w) for w in restore.words(text)}))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["entry", "n"])


def learn_lexicon(labelled: DataFrame, model: np.ndarray) -> tuple[dict[str, float], float]:
    """The lexicon of `labelled(doc_id, text, toxic)`, and the score of texts without any of it.

    At most TRAIN_ROWS rows are used, so all counts here are bounded: those of the smallest hash of their id, then the smallest id
    and hash of their text, so that reruns learn the same. An entry is kept when so many
    toxic documents and so few others are improbable for any entry that means nothing.
    """
    spark = labelled.sparkSession
    rows = labelled.select("doc_id", "text", "toxic", F.xxhash64("text").alias("t")).mapInArrow(
        _fingerprints, T.StructType([*labelled.select("doc_id", "text", "toxic").schema.fields,
                                     *(T.StructField(n, T.LongType()) for n in ("t", "one", "two"))]))
    rows = stored(spark, rows)
    # What is chosen is decided on narrow rows; the texts stay in the tasks that read them.
    chosen = rows.select("doc_id", "toxic", "t", "one", "two", F.xxhash64("doc_id").alias("h")) \
        .orderBy("h", "doc_id", "t", "toxic").limit(TRAIN_ROWS)
    # Copies of one document would make its own words look telling: of texts with one min-hash one stays.
    row = F.struct("h", "doc_id", "t", "one", "two")
    for least in ("one", "two"):
        chosen = chosen.groupBy(least, "toxic").agg(F.min(row).alias("row")).select("toxic", "row.*")
    kept = rows.select("doc_id", "t", "toxic", "text").join(
        F.broadcast(chosen.select("doc_id", "t", "toxic")), ["doc_id", "t", "toxic"])
    # Spark joins small partitions but for a number that is asked for: decoding takes all cores.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = kept.repartition(tasks, "doc_id", "t").dropDuplicates(["doc_id", "t", "toxic"]).select("text", "toxic")
    rows = stored(spark, rows)
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return {}, (n1 + 0.5) / (n1 + n0 + 1)
    rate = n1 / (n1 + n0)
    count = lambda part, n: part.select("text").mapInArrow(
        partial(_count_entries, model=model), "entry STRING, n BIGINT").groupBy("entry").agg(F.sum("n").alias(n))
    counted = count(rows.filter("toxic = 1"), "a").join(count(rows.filter("toxic = 0"), "b"), "entry", "left")
    counted = stored(spark, counted.select("entry", "a", F.coalesce("b", F.lit(0)).alias("b")))
    a, b = F.col("a"), F.col("b")
    # Entries in too few documents to pass even if all were toxic are no tests.
    held = {r["n"]: r["count"] for r in counted.groupBy((a + b).alias("n")).count().collect()}
    tests, least = sum(held.values()), 1
    while tests and least * math.log(1 / rate) <= math.log(tests / FALSE_ENTRIES):
        tests, least = tests - held.get(least, 0), least + 1
    limit = math.log(FALSE_ENTRIES / max(1, tests))
    # Log of Chernoff's bound of the chance that an entry without meaning has a toxic and b other documents.
    share = a / (a + b)
    luck = -(a + b) * (share * F.log(share / rate) + F.when(b == 0, 0.0).otherwise((1 - share) * F.log((1 - share) / (1 - rate))))
    passed = counted.filter((a + b >= least) & (share > rate) & (luck < limit))
    lexicon = {r["entry"]: (r["a"] + rate) / (r["a"] + r["b"] + 1) for r in passed.collect()}
    return lexicon, _rest(rows, model, lexicon, n1, n0)


def _fingerprints(batches):
    """Two min-hashes of each text's three-word shingles."""
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            value, starts = tx.shingles(*tx.words(batch.column("text")), 3)
            least = []
            for salt in tx.seed_values(41, 2):
                padded = np.append(tx.mix(value ^ salt), np.uint64((1 << 64) - 1))
                found = np.minimum.reduceat(padded, starts[:-1]) if batch.num_rows else padded[:0]
                least.append(pa.array(np.where(np.diff(starts) > 0, found, np.uint64(0)).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *least], [*batch.schema.names, "one", "two"])


def _flag(batches, model: np.ndarray, lexicon: dict[str, float]):
    restore, known = Restorer(model), {}
    for batch in batches:
        hit = [_best(t, restore, lexicon, known) > 0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(hit, pa.bool_())], ["toxic", "hit"])


def _rest(rows: DataFrame, model: np.ndarray, lexicon: dict[str, float], n1: int, n0: int) -> float:
    """How often documents without an entry are toxic."""
    found = rows.select("text", F.col("toxic").cast("int")).mapInArrow(
        partial(_flag, model=model, lexicon=lexicon), "toxic INT, hit BOOLEAN")
    left = {r["toxic"]: r["count"] for r in found.filter("NOT hit").groupBy("toxic").count().collect()}
    a, b = left.get(1, 0), left.get(0, 0)
    return (a + 0.5) / (a + b + 1)


def _best(text: str | None, restore: Restorer, lexicon: dict[str, float], known: dict[str, float]) -> float:
    """The strongest entry of a text; `known` holds words met before."""
    best = 0.0
    for word in restore.words(text):
        score = known.get(word)
        if score is None:
            if len(known) > 200_000:
                known.clear()
            score = max((lexicon.get(e, 0.0) for e in entries({restore.word(word)})), default=0.0)
            known[word] = score
        if score > best:
            best = score
    return best


def _score(batches, model: np.ndarray, lexicon: dict[str, float], rest: float):
    restore, known = Restorer(model), {}
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            scores = [_best(t, restore, lexicon, known) or rest for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names[:], "score"])


def _renamed(batches, name: str, **kw):
    for batch in _score(batches, **kw):
        yield batch.rename_columns([*batch.schema.names[:-1], name])


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with a column score, 0 to 1, of every whole text, learnt from `labels(doc_id, toxic)`.

    Rows of `labels` without id or label, or held out by `held_out`, teach nothing; labels that contradict
    each other count each. Without labels of both kinds every text has one score. Null and empty texts
    score as texts without any entry; repeated rows score alike. The score's name gets trailing
    underscores where the table has it.
    """
    model = character_model(docs)
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id"))) \
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # Of the labels no more than the bound are joined, so the texts needn't be shuffled.
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(TRAIN_ROWS)
    labelled = texts.join(F.broadcast(known), "doc_id")
    lexicon, rest = learn_lexicon(labelled, model)
    name = free_name(docs, "score")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(partial(_renamed, name=name, model=model, lexicon=lexicon, rest=rest), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below `threshold`, with their columns."""
    scored = score_toxicity(docs, labels)
    return scored.filter(F.col(scored.columns[-1]) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
