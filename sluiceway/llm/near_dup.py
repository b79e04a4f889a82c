"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

A signature has `LENGTH` places. Every shingle deals its ranks 0, 1, 2 ... to the places in an
order of its own (a permutation i -> a*i + b of a prime number of places), each with a random
fraction added; a place keeps the smallest value dealt to it. The ranks of one shingle are thus
correlated, which lowers the variance of the estimate for small sets, and dealing ends once no
place can improve. Two sets agree in a place with the probability of their Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm import texts as tx
from sluiceway.llm.components import components, free_name, stored
from sluiceway.operators.joins import measured_join

LENGTH = 127        # a prime, so that the orders are permutations
_NONE = np.uint64(np.iinfo(np.uint64).max)
_FRACTION = np.uint64((1 << 56) - 1)
#: Chance of a pair at the threshold to share no band, at most.
MISS = 1e-6
#: Rounds in which each set is compared with the pivots it shares most bands with, and with how many.
PIVOTS = (1, 4)


def band_rows(threshold: float, miss: float = MISS) -> int:
    """The largest number of places in a band that keeps the chance of a miss below `miss`."""
    return max(r for r in range(1, 12) if r == 1 or (1 - threshold ** r) ** (LENGTH // r) <= miss)


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SuperMinHash signature of each set of 64-bit values; (sets, LENGTH), empty sets all ones."""
    sets = len(starts) - 1
    out = np.full(sets * LENGTH, _NONE, dtype=np.uint64)
    owner = np.repeat(np.arange(sets), np.diff(starts))
    step = (tx.mix(values ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(LENGTH - 1)).astype(np.int64) + 1
    place = (tx.mix(values ^ np.uint64(0x14057B7EF767814F)) % np.uint64(LENGTH)).astype(np.int64)
    for rank in range(LENGTH):
        if not len(owner):
            break
        value = (tx.mix(values + np.uint64(rank * 0xD6E8FEB86659FD93 % (1 << 64))) & _FRACTION) \
            | np.uint64(rank << 56)
        np.minimum.at(out, owner * LENGTH + place, value)
        # A set is done when every place holds a value below the next rank.
        worst = out.reshape(sets, LENGTH).max(axis=1)
        open_ = (worst >= np.uint64((rank + 1) << 56))[owner]
        values, owner, step, place = values[open_], owner[open_], step[open_], place[open_]
        place = (place + step) % LENGTH
    return out.reshape(sets, LENGTH)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; bands of different places never share a key by design."""
    bands = LENGTH // rows
    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    keys += tx.seed_values(7, bands)[None, :]
    for r in range(rows):
        keys = tx.mix(keys ^ signature[:, r:bands * rows:rows])
    return keys.view(np.int64)


_SIGNED = "doc_id BIGINT, n_shingles BIGINT, digest BINARY, bands ARRAY<BIGINT>"


def _lists(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1]
    return pa.ListArray.from_arrays(
        np.arange(0, matrix.size + 1, width, dtype=np.int32), pa.array(matrix.ravel()))


def _sign(batches, words: int, rows: int):
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            values, starts = tx.shingles(*tx.words(batch.column("text")), words)
            signature = signatures(values, starts)
            digest = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest()
                      for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(starts).astype(np.int64)),
                pa.array(digest, pa.binary()), _lists(band_keys(signature, rows))],
                ["doc_id", "n_shingles", "digest", "bands"])


def _verify(batches, words: int, percent: int):
    """The pairs whose full sets reach the threshold."""
    for batch in batches:
        yield batch.filter(pa.array(_close(batch, words, percent), pa.bool_())).select(["a", "b"])


def _close(batch: pa.RecordBatch, words: int, percent: int) -> list[bool]:
    out: list[bool] = []
    for part in tx.slices(batch, "text_a", 2 << 20):
        left, at = tx.shingles(*tx.words(part.column("text_a")), words)
        for k, row in enumerate(range(part.num_rows)):
            right, _ = tx.shingles(*tx.words(part.column("text_b").slice(row, 1)), words)
            mine = left[at[k]:at[k + 1]]
            both = len(np.intersect1d(mine, right, assume_unique=True))
            out.append(100 * both >= percent * (len(mine) + len(right) - both))
    return out


_DELTA = "rep BIGINT, pivot BIGINT, apart BOOLEAN, own BIGINT, base BIGINT, " \
    "n BIGINT, n_base BIGINT, linked BOOLEAN, delta ARRAY<BIGINT>"


def _name(values: np.ndarray) -> int:
    """One value that tells the sets of a document, or of a pivot, apart."""
    return int(np.bitwise_xor.reduce(tx.mix(values), initial=np.uint64(0)).view(np.int64))


def _deltas(batches, words: int, percent: int):
    """What each set (text_a) and its pivot's (text_b) don't share, and whether they are linked."""
    schema = pa.schema([("rep", pa.int64()), ("pivot", pa.int64()), ("apart", pa.bool_()), ("own", pa.int64()),
                        ("base", pa.int64()), ("n", pa.int64()), ("n_base", pa.int64()), ("linked", pa.bool_()),
                        ("delta", pa.list_(pa.int64()))])
    for batch in batches:
        for part in tx.slices(batch, "text_a", 2 << 20):
            left, at = tx.shingles(*tx.words(part.column("text_a")), words)
            names, bases, sizes, base_sizes, linked, deltas = [], [], [], [], [], []
            for k in range(part.num_rows):
                right, _ = tx.shingles(*tx.words(part.column("text_b").slice(k, 1)), words)
                mine = left[at[k]:at[k + 1]]
                delta = np.setxor1d(mine, right, assume_unique=True)
                total = len(mine) + len(right)
                names.append(_name(mine))
                bases.append(_name(right))
                sizes.append(len(mine))
                base_sizes.append(len(right))
                linked.append((100 + percent) * len(delta) <= (100 - percent) * total)
                deltas.append(pa.array(delta.view(np.int64)))
            lists = pa.ListArray.from_arrays(
                np.concatenate(([0], np.cumsum([len(d) for d in deltas]))).astype(np.int32), pa.concat_arrays(deltas))
            yield pa.RecordBatch.from_arrays([
                part.column("a"), part.column("b"), part.column("apart"), pa.array(names), pa.array(bases),
                pa.array(sizes), pa.array(base_sizes), pa.array(linked, pa.bool_()), lists], schema=schema)


def _beside_pivots(deltas: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may be linked though neither is the pivot of both.

    With m, n the sizes of a set's delta and of the set, and c = (100 - percent) / (100 + percent), a pair
    is linked exactly if its deltas share at least (m_a + m_b - c * (n_a + n_b)) / 2 shingles. A set that
    is not linked with the pivot has m > c * (n + n_base), so this is more than m * (1 - c) / 2 for each
    partner of such a set, and at least (m - c * (n + n_base)) / 2 for the set itself. Two sets
    linked with the pivot are of one component. So the rarest m - bound + 1 shingles of both deltas meet.
    What sets have in common with their pivot is in no delta: a group of copies brings only shared edits together.
    """
    one = ["pivot", "base", "rep", "own"]
    rows = deltas.withColumn("m", F.size("delta").cast("long"))
    tokens = rows.select(*one, "n", "n_base", "m", "linked", F.explode("delta").alias("token"))
    held = tokens.groupBy("pivot", "base", "token").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = tokens.join(held, ["pivot", "base", "token"]).groupBy(*one).agg(
        *[F.first(c).alias(c) for c in ("n", "n_base", "m", "linked")],
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    # Shingles of one set only are the rarest, and meet nothing.
    alone = F.col("m") - F.size("shared")
    strict = F.floor(percent * F.col("m") / (100 + percent)) + 1
    loose = F.greatest(F.lit(1), F.ceil(
        ((100 + percent) * F.col("m") - (100 - percent) * (F.col("n") + F.col("n_base"))) / (2 * (100 + percent))))
    prefix = ranked.withColumn("alone", alone) \
        .withColumn("strict", F.col("m") - strict + 1 - F.col("alone")) \
        .withColumn("loose", F.when(F.col("linked"), F.col("strict")).otherwise(F.col("m") - loose + 1 - F.col("alone"))) \
        .filter(F.greatest("strict", "loose") > 0)
    prefix = prefix.join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("root", F.coalesce("root", "rep"))
    longest = F.greatest("strict", "loose").cast("int")
    spread = stored(deltas.sparkSession, prefix.select(
        "pivot", "base", "rep", "root", "n", "m", "linked", "alone", "strict",
        F.posexplode(F.slice("shared", F.lit(1), longest)).alias("at", "s")).select(
            "pivot", "base", F.col("s.token").alias("token"), "rep", "root", "n", "m", "linked",
            (F.col("alone") + F.col("at") + 1).alias("at"), (F.col("at") < F.col("strict")).alias("short")))

    def meet(left: DataFrame, right: DataFrame, ordered: bool) -> DataFrame:
        x, y = (side.select("pivot", "base", "token", *[F.col(c).alias(f"{c}_{k}") for c in ("rep", "root", "n", "m", "at")])
                for side, k in ((left, "a"), (right, "b")))
        fits = (100 + percent) * (F.col("m_a") + F.col("m_b")) - (100 - percent) * (F.col("n_a") + F.col("n_b")) \
            <= 2 * (100 + percent) * (1 + F.least(F.col("m_a") - F.col("at_a"), F.col("m_b") - F.col("at_b")))
        same = [x[c] == y[c] for c in ("pivot", "base", "token")]
        where = fits & (F.col("root_a") != F.col("root_b"))
        if ordered:
            where = where & (F.col("rep_a") < F.col("rep_b"))
        for c in same:
            where = c & where
        return x.join(y, where).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))

    far, near = spread.filter("NOT linked"), spread.filter("linked")
    return meet(far.filter("short"), far.filter("short"), True).union(meet(near, far, False)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs(doc_id, text)`.

    Documents are linked when their sets of distinct `words`-word shingles have a Jaccard
    similarity of `percent` hundredths or more, checked on the full sets; `component_id` is the
    smallest doc_id reachable over links. A-Z count as a-z; words end at ASCII white space.
    Texts of fewer words have one shingle. Empty and null texts are linked with nothing. Rows
    that share a doc_id are one node. A null doc_id is linked with nothing, its component is null
    and it is kept. An empty table gives an empty result; other columns are ignored.

    Rows with equal sets are first reduced to one by a digest of the set, so a group of exact
    copies costs one row a task. Then each set that shares bands with others is compared with
    pivots of these bands, the ones it shares most bands with: first the member of each band whose bands hold most
    sets, which in a group of copies is the one with fewest edits, then any. Where a band still holds several
    components, each of its sets is compared with one pivot, and the pairs of the others are found by
    what they don't share with it (`_beside_pivots`), without loss. So every pair that shares a band is either
    of one component or decided on full sets; two sets at the threshold share none with a chance of `MISS` at most.
    """
    spark = docs.sparkSession
    threshold = percent / 100
    rows = band_rows(threshold)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(spark, source.mapInArrow(partial(_sign, words=words, rows=rows), _SIGNED))

    nodes = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    sets = nodes.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    sets = stored(spark, sets)
    banded = sets.select(F.explode("bands").alias("key"), "rep")
    shared = banded.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")) \
        .filter("lo < hi").select("key")
    shared = stored(spark, banded.join(shared, "key", "left_semi").distinct())
    sizes = shared.groupBy("key").agg(F.count("*").alias("size"))
    score = stored(spark, measured_join(shared, sizes, ["key"], "inner", ["rep"]).groupBy("rep").agg(
        F.sum("size").alias("score")))
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    candidates = stored(spark, source.join(wanted, "doc_id", "left_semi"))

    # Rows of one doc_id with different sets belong together.
    member = nodes.select("doc_id", "digest").join(sets.select("digest", "rep"), "digest").select("doc_id", "rep")
    member = stored(spark, member)
    links = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")) \
        .filter("a < b").select("a", "b")

    def with_texts(pairs: DataFrame) -> DataFrame:
        """The pairs with both texts; one pivot may be that of many."""
        pairs = stored(spark, pairs)
        left, right = (candidates.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        return measured_join(pairs, right, ["b"], "inner", ["a"]).join(left, "a").select(*pairs.columns, "text_a", "text_b")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs whose documents are similar."""
        return with_texts(pairs).mapInArrow(partial(_verify, words=words, percent=percent), "a BIGINT, b BIGINT")

    def pivots(rest: DataFrame, order) -> DataFrame:
        """One set of each band, the smallest in this order, joined to the band's rows."""
        least = rest.join(score, "rep").groupBy("key").agg(
            F.min(F.struct(*order, F.col("rep").alias("pivot"), F.col("root").alias("pivot_root"))).alias("p"))
        return measured_join(rest, least.select("key", "p.pivot", "p.pivot_root"), ["key"], "inner", ["rep"])

    def mixed(roots: DataFrame) -> DataFrame:
        """Band rows with their components, where a band holds more than one."""
        here = shared.join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
            .select("key", "rep", F.coalesce("root", "rep").alias("root"))
        several = here.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
            .filter("lo < hi").select("key")
        return here.join(several, "key", "left_semi")

    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root")) if links.isEmpty() else components(links)
    orders = [[-F.col("score")], [F.xxhash64("rep")]]
    for order, most in zip(orders, PIVOTS, strict=True):
        rest = stored(spark, mixed(roots))
        votes = pivots(rest, order).filter("root <> pivot_root").groupBy("rep", "pivot").agg(F.count("*").alias("n"))
        # A set has one pivot a band at most, so the lists are short.
        best = F.slice(F.sort_array(F.collect_list(F.struct("n", "pivot")), asc=False), 1, most)
        pairs = votes.groupBy("rep").agg(best.alias("v")) \
            .select(F.col("rep").alias("a"), F.explode("v.pivot").alias("b"))
        links = stored(spark, links.union(confirmed(pairs)))
        roots = stored(spark, components(links))

    rest = stored(spark, mixed(roots))
    pairs = pivots(rest, orders[0]).filter("rep <> pivot").select(
        F.col("rep").alias("a"), F.col("pivot").alias("b"), (F.col("root") != F.col("pivot_root")).alias("apart")).distinct()
    deltas = stored(spark, with_texts(pairs).mapInArrow(partial(_deltas, words=words, percent=percent), _DELTA))
    direct = deltas.filter("linked AND apart").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    links = stored(spark, links.union(direct))
    roots = stored(spark, components(links))
    links = stored(spark, links.union(confirmed(_beside_pivots(deltas, roots, percent))))
    roots = stored(spark, components(links))

    final = member.groupBy("doc_id").agg(F.min("rep").alias("rep")) \
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("doc_id", F.coalesce("root", "rep").alias("component_id"))
    return signed.select("doc_id", "n_shingles").join(final, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, all columns: that of the smallest doc_id.

    Of several rows with that doc_id the one with the smallest text stays. Rows without a
    doc_id stay all.
    """
    found = near_duplicates(docs, words, percent).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.filter("doc_id IS NOT NULL").join(found, "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy(
        F.col("text").asc_nulls_last(), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    rank = free_name(docs, "rank")
    one = kept.withColumn(rank, F.row_number().over(order)).filter(f"{rank} = 1").select(
        *[F.col(f"`{c}`") for c in docs.columns])
    return one.unionByName(docs.filter("doc_id IS NULL"))
