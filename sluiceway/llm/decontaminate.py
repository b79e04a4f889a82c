"""Benchmark items inside documents, at small edit distance.

Texts are sequences of words (ASCII letters folded, punctuation left out); a window as long as an item
is compared with it in edits of words. The random walk of Chakraborty, Goldenberg and Koucky maps a
sequence to a longer one: at each step it writes the word it stands on and moves on or stays, as
a random bit for this step and word says. Small edit distance becomes small Hamming distance, so hashes of a few
sampled places collide; walks and samples are repeated until simulated edits of the items
reach `TARGET_RECALL`. Pairs that collide are verified exactly.

Windows that cannot match never get that far: with at most e edits in n words, one of the e + 1
stretches between edits keeps (n - e) / (e + 1) words of the item, so a window without such
a run in common with an item is no match.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import texts as tx

#: Edits allowed, as a share of an item's words.
EDIT_SHARE = 0.25
TARGET_RECALL = 0.995
#: Repetitions tried at most, places sampled for each, simulated edits of each item for setting them.
MOST_REPEATS, SAMPLED, TRIALS = 96, 2, 4
#: The longest run that windows are looked up by.
LONGEST_RUN = 3
#: Words of items that go to the executors at once; a larger benchmark takes further passes.
BLOCK_WORDS = 2_000_000


def allowed_edits(n: np.ndarray | int):
    return np.floor(np.asarray(n) * EDIT_SHARE).astype(np.int64)


def sampled_places(n: int, repeats: int) -> np.ndarray:
    """The places each repetition samples for windows of `n` words, of the 2n a walk is likely to write."""
    wide = max(2 * n, SAMPLED)
    return np.stack([np.sort(np.random.default_rng([r, n]).choice(wide, SAMPLED, replace=False)) for r in range(repeats)])


def embed(windows: np.ndarray, sizes: np.ndarray, places: dict[int, np.ndarray]) -> np.ndarray:
    """One hash per repetition and window: what the repetition's random walk writes at its sampled places.

    Row i holds the window for an item of sizes[i] words; 0 is no word. All rows and repetitions
    take each step of their walks together.
    """
    rows, width = windows.shape
    if not rows:
        return np.zeros((0, 0), dtype=np.uint64)
    wanted = np.stack([places[int(n)] for n in sizes])
    repeats, steps = wanted.shape[1], int(wanted.max()) + 1
    bits = tx.seed_values(3, repeats * steps).reshape(repeats, steps)
    row = np.arange(rows)[:, None]
    padded = np.concatenate([windows, np.zeros((rows, 1), dtype=np.uint64)], axis=1)
    at = np.zeros((rows, repeats), dtype=np.int64)
    out = np.zeros((rows, repeats), dtype=np.uint64)
    for step in range(steps):
        word = padded[row, np.minimum(at, width)]
        here = (wanted == step).any(axis=2)
        if here.any():
            out[here] = tx.mix(out[here] ^ word[here])
        at += ((tx.mix(word) ^ bits[None, :, step]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(63)).astype(np.int64)
    return out


def edit_distance(items: np.ndarray, sizes: np.ndarray, regions: np.ndarray, lengths: np.ndarray):
    """Fewest edits that turn each item into some stretch of its region, and where that ends.

    Row i has an item of sizes[i] words and a region of lengths[i]; 0 pads both.
    """
    rows, width = regions.shape
    steps = np.arange(width + 1)
    cost = np.zeros((rows, width + 1), dtype=np.int64)
    last = cost.copy()
    for k in range(items.shape[1]):
        change = cost[:, :-1] + (regions != items[:, k:k + 1])
        fresh = np.empty_like(cost)
        fresh[:, 0] = k + 1
        fresh[:, 1:] = np.minimum(change, cost[:, 1:] + 1)
        cost = np.minimum.accumulate(fresh - steps, axis=1) + steps
        done = sizes == k + 1
        last[done] = cost[done]
    last[steps[None, :] > lengths[:, None]] = np.iinfo(np.int64).max
    end = last.argmin(axis=1)
    return last[np.arange(rows), end], end


class Items:
    """Benchmark items made ready for looking up windows."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        words, starts = tx.words(pa.array(texts, pa.string()), tx.PUNCTUATION)
        parts = [(i, words[a:b]) for i, a, b in zip(ids, starts[:-1], starts[1:], strict=True) if b > a]
        self.ids = np.array([i for i, _ in parts], dtype=np.int64)
        self.sizes = np.array([len(w) for _, w in parts], dtype=np.int64)
        self.edits = allowed_edits(self.sizes)
        self.words = np.zeros((len(parts), int(self.sizes.max(initial=1))), dtype=np.uint64)
        for k, (_, w) in enumerate(parts):
            self.words[k, :len(w)] = w
        run = np.minimum(-(-(self.sizes - self.edits) // (self.edits + 1)), LONGEST_RUN)
        self.tables = []
        for k in range(1, LONGEST_RUN + 1):
            keys, item, offset = [], [], []
            for i in np.flatnonzero(run == k):
                found = tx.chain(self.words[i, :self.sizes[i]], k)
                keys.append(found)
                item.append(np.full(len(found), i))
                offset.append(np.arange(len(found)))
            if keys:
                key = np.concatenate(keys)
                order = np.argsort(key, kind="stable")
                table = (key[order], np.concatenate(item)[order], np.concatenate(offset)[order])
                filter_ = np.zeros(1 << 20, dtype=bool)
                filter_[(key & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
                self.tables.append((k, *table, filter_))
        places = {int(n): sampled_places(int(n), MOST_REPEATS) for n in np.unique(self.sizes)}
        repeats = self._repeats(places)
        self.places = {n: p[:repeats] for n, p in places.items()}
        self.hashes = embed(self.words, self.sizes, self.places)

    def _repeats(self, places: dict[int, np.ndarray]) -> int:
        """Repetitions after which items edited at random, as much as allowed, collide often enough."""
        random = np.random.default_rng(11)
        picked = np.repeat(random.permutation(len(self.ids))[:60], TRIALS)
        if not len(picked):
            return 1
        trials = np.zeros((len(picked), self.words.shape[1]), dtype=np.uint64)
        for row, i in enumerate(picked):
            words, n = list(self.words[i, :self.sizes[i]]), int(self.sizes[i])
            for _ in range(int(self.edits[i])):
                kind, at = random.integers(3), int(random.integers(len(words)))
                new = np.uint64(random.integers(1, 1 << 62))
                if kind == 0:
                    words[at] = new
                elif kind == 1:
                    words.insert(at, new)
                elif len(words) > 1:
                    del words[at]
            trials[row, :min(n, len(words))] = words[:n]
        same = embed(trials, self.sizes[picked], places) == embed(self.words[picked], self.sizes[picked], places)
        hit = np.logical_or.accumulate(same, axis=1).mean(axis=0)
        enough = np.flatnonzero(hit >= TARGET_RECALL)
        return int(enough[0]) + 1 if len(enough) else MOST_REPEATS

    def matches(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item, edits, first word, words) of the best match of each item in each text."""
        words, starts = tx.words(texts, tx.PUNCTUATION)
        found: list[np.ndarray] = []
        for k, keys, item, offset, filter_ in self.tables:
            run = tx.chain(words, k)
            if not len(run):
                continue
            maybe = np.flatnonzero(filter_[(run & np.uint64((1 << 20) - 1)).astype(np.int64)])
            lo, hi = np.searchsorted(keys, run[maybe], "left"), np.searchsorted(keys, run[maybe], "right")
            count = hi - lo
            place = np.repeat(maybe, count)
            entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
            row = np.searchsorted(starts, place, side="right") - 1
            ok = place + k <= starts[row + 1]
            found.append(np.stack([row, item[entry], place - offset[entry] - starts[row]], axis=1)[ok])
        if not found:
            return []
        places = np.unique(np.concatenate(found), axis=0)
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        for at in range(0, len(places), 4096):
            self._verify(words, starts, places[at:at + 4096], out)
        return [(row, item, *best) for (row, item), best in sorted(out.items())]

    def _collide(self, words: np.ndarray, starts: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which windows share a hash with their item."""
        row, item, first = places.T
        lo = np.maximum(first, 0) + starts[row]
        windows = _gather(words, lo, np.minimum(lo + self.sizes[item], starts[row + 1]), self.words.shape[1])
        keep = (windows == self.words[item]).all(axis=1)
        rest = np.flatnonzero(~keep)
        if len(rest):
            hashes = embed(windows[rest], self.sizes[item[rest]], self.places)
            keep[rest] = (hashes == self.hashes[item[rest]]).any(axis=1)
        return keep

    def _verify(self, words, starts, places, out) -> None:
        places = places[self._collide(words, starts, places)]
        if not len(places):
            return
        row, item, first = places.T
        size, edits = self.sizes[item], self.edits[item]
        lo = np.maximum(first - edits, 0) + starts[row]
        hi = np.minimum(first + size + edits + starts[row], starts[row + 1])
        regions = _gather(words, lo, hi, int((hi - lo).max()))
        distance, end = edit_distance(self.words[item], size, regions, hi - lo)
        for k in np.flatnonzero(distance <= edits):
            key = (int(row[k]), int(item[k]))
            stop = int(lo[k] - starts[row[k]] + end[k])
            mine = (int(distance[k]), max(0, stop - int(size[k])), int(size[k]))
            if key not in out or mine < out[key]:
                out[key] = mine


def _gather(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> np.ndarray:
    """Rows of words[lo:hi], padded with 0."""
    at = lo[:, None] + np.arange(width)
    return np.where(at < hi[:, None], words[np.minimum(at, len(words) - 1)], np.uint64(0))


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_WORDS words, one after the other."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                F.col("text").cast("string").alias("text")) \
            .filter("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += len(row["text"].split()) + 1
        if size >= BLOCK_WORDS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


_FOUND = "doc_id BIGINT, item_id BIGINT, edits BIGINT, item_words BIGINT, first_word BIGINT"


def _find(batches, held):
    items = held.value
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            found = items.matches(batch.column("text"))
            if found:
                row, item, edits, first, size = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row)), pa.array(items.ids[item]), pa.array(edits),
                     pa.array(size), pa.array(first)],
                    ["doc_id", "item_id", "edits", "item_words", "first_word"])


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, item_words, first_word): the best match of an item in a document.

    An item of n words is in a document if some stretch of it is at most n * EDIT_SHARE (rounded down) edits of
    words away. Items without id, text or words, and null or empty documents, match nothing; rows
    with one doc_id, and items with one id, are searched each. `first_word` is near where the match begins, from 0.
    Ties take the fewest edits, then the earliest. An empty benchmark gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], _FOUND)
    first = True
    for items in item_blocks(benchmark):
        held = spark.sparkContext.broadcast(items)
        found = texts.mapInArrow(partial(_find, held=held), _FOUND)
        out, first = (found if first else out.unionByName(found)), False
    return out


def _clean(batches, held):
    items = held.value
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            bad = {row for row, *_ in items.matches(batch.column("text"))}
            yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_())) if bad else batch


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item of `benchmark`, with all their columns."""
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)
        docs = docs.mapInArrow(partial(_clean, held=held), docs.schema)
    return docs

