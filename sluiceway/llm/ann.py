"""Nearest neighbours by inner product with collision-counting hashing.

Vectors get one more component that makes all of one length, so that the largest inner product is the
least distance. Each hash is one random projection, its values kept as a sorted array. A query
opens a window around its own projection in every array; a vector collides in an array when it
lies in the window, and one that collides in enough arrays is verified by its inner product.

Windows grow (virtual rehashing: no array is built anew) until they are wide enough for the k-th best
vector verified: one at distance d collides in an array with the chance that a normal value of deviation d lies
in the window, so a window of `REACH` times d lets each vector that is no further than d miss the threshold only by
`SURE` deviations. Nothing in this depends on how many vectors a block holds.

The vectors lie in blocks, each with its own arrays; the queries, in blocks too, meet every
block, and the best of all blocks are merged.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.components import stored

NEIGHBOURS = 20
#: Projections, and the share of them that a vector must collide in to be verified.
HASHES, COLLIDING = 128, 0.68
#: Deviations by which the expected collisions of a vector that must be found exceed the threshold: a chance of 0.98.
SURE = 2.0
#: The half window in which a vector at distance 1 collides that often.
REACH = NormalDist().inv_cdf(0.5 + (COLLIDING + SURE * (COLLIDING * (1 - COLLIDING) / HASHES) ** 0.5) / 2)
#: Vectors of a block, queries answered together.
BLOCK, QUERY_BLOCK = 16_384, 2_048
#: Queries whose windows are opened in one step.
TOGETHER = 32
#: The first half window, in lengths of a vector, and its growth where too few vectors collide.
FIRST_WINDOW, GROWTH = 0.7, 1.25


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of vectors that can be compared: not null, not zero, all components finite."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<float>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(fine) \
        .filter(F.exists("embedding", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of one width, in double precision."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


class Block:
    """Vectors of one block with their sorted projections."""

    def __init__(self, ids: list[np.ndarray], vectors: np.ndarray, norm: float):
        self.ids, self.vectors = ids, vectors
        rest = np.sqrt(np.maximum(0.0, norm ** 2 - (vectors ** 2).sum(axis=1)))
        long = np.column_stack([vectors, rest])
        random = np.random.default_rng(20)
        self.lines = random.standard_normal((long.shape[1], HASHES))
        values = long @ self.lines
        order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=0).T.copy()
        #: Each vector's place in each sorted array; a window of an array is a range of places.
        self.place = np.argsort(order, axis=0).T.astype(np.uint16 if len(vectors) <= 1 << 16 else np.uint32, order="C")
        self._from, self._inside = np.empty_like(self.place), np.empty(self.place.shape, dtype=bool)
        self.norm = norm

    def colliding(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The vectors within these places of at least the threshold of arrays."""
        if (hi - lo).min() >= len(self.vectors):
            return np.arange(len(self.vectors))
        kind = self.place.dtype.type
        np.subtract(self.place, lo[:, None].astype(kind), out=self._from)
        np.less(self._from, (hi - lo)[:, None].astype(kind), out=self._inside)
        counts = np.add.reduce(self._inside.view(np.uint8), axis=0, dtype=np.uint8)
        return np.flatnonzero(counts >= int(np.ceil(COLLIDING * HASHES)))

    def candidates(self, query: np.ndarray, k: int):
        """For each query the vectors verified and their inner products; see the module on when windows do."""
        size = np.sqrt((query ** 2).sum(axis=1))
        # A query's length changes no order; it is given the common one.
        at = np.column_stack([query * (self.norm / size)[:, None], np.zeros(len(query))]) @ self.lines
        # One vector may be the query's own.
        n, need = len(self.vectors), min(len(self.vectors), k + 1)
        start = FIRST_WINDOW * self.norm        # later what did for three quarters of the queries before
        for first in range(0, len(query), TOGETHER):
            left = np.arange(first, min(first + TOGETHER, len(query)))
            width, did, out = np.full(len(query), start), [], {}
            while len(left):
                lo = np.stack([line.searchsorted(at[left, h] - width[left]) for h, line in enumerate(self.sorted)])
                hi = np.stack([line.searchsorted(at[left, h] + width[left], side="right") for h, line in enumerate(self.sorted)])
                more = []
                for i, q in enumerate(left):
                    found = self.colliding(lo[:, i], hi[:, i])
                    if len(found) < need:
                        width[q] *= GROWTH
                        more.append(q)
                        continue
                    score = self.vectors.take(found, axis=0) @ query[q]
                    worst = np.partition(score, len(score) - need)[len(score) - need]
                    # Distance of the vectors of common length, a hair more for rounding.
                    wanted = REACH * np.sqrt(max(0.0, 2 * self.norm * (self.norm - worst / size[q]))) * (1 + 1e-9)
                    if wanted > width[q] and len(found) < n:
                        width[q] = wanted
                        more.append(q)
                        continue
                    did.append(wanted)
                    out[q] = found, score
                left = np.array(more, dtype=np.int64)
            start = max(float(np.quantile(did, 0.75)), 1e-12 * self.norm)
            yield from (out[q] for q in sorted(out))

    def search(self, query_ids: np.ndarray, query: np.ndarray, k: int):
        """(query, vector, score) of the k best of each query here, ties to the smaller id."""
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q, (found, score) in enumerate(self.candidates(query, k)):
            # Each vector may stand for several ids; the best k + 1 vectors hold the best k ids.
            if len(found) > k + 1:
                edge = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                found = found[score >= edge - 1e-9 * self.norm ** 2]
            # Summed row by row, so that the same vectors give the same bits in every block.
            score = (self.vectors[found] * query[q]).sum(axis=1)
            ids = np.concatenate([self.ids[i] for i in found])
            score = np.repeat(score, [len(self.ids[i]) for i in found])
            other = ids != query_ids[q]
            ids, score = ids[other], score[other]
            best = np.lexsort((ids, -score))[:k]
            rows.append((np.full(len(best), query_ids[q]), ids[best], score[best]))
        return [np.concatenate(x) for x in zip(*rows, strict=True)] if rows else [np.zeros(0)] * 3


def _search(left: pa.Table, right: pa.Table, norm: float, k: int) -> pa.Table:
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    empty = out.empty_table()
    if not left.num_rows or not right.num_rows:
        return empty
    tables = []
    vectors = right.combine_chunks()
    width = np.diff(np.asarray(vectors.column("embedding").combine_chunks().offsets))
    asked = np.array([len(x) for x in left.column("embedding").to_pylist()])
    for dimension in np.unique(width):      # vectors of another length are never compared
        mine = vectors.filter(pa.array(width == dimension))
        queries = left.filter(pa.array(asked == dimension)).combine_chunks()
        if not queries.num_rows:
            continue
        block = Block([np.array(x, dtype=np.int64) for x in mine.column("ids").to_pylist()],
                      _matrix(mine.column("embedding").combine_chunks()), norm)
        found = block.search(np.asarray(queries.column("vec_id")), _matrix(queries.column("embedding").combine_chunks()), k)
        tables.append(pa.table([pa.array(found[0].astype(np.int64)), pa.array(found[1].astype(np.int64)),
                                pa.array(found[2].astype(np.float64))], schema=out))
    return pa.concat_tables(tables) if tables else empty


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of largest inner product found for each query.

    Both tables have vec_id and embedding; a query's own id is no candidate. Vectors that `usable` leaves
    out take no part. Equal scores go to the smaller vec_id; fewer than k candidates are all
    returned. Equal vectors are searched as one, with the k + 1 smallest ids of each, which is all
    a result can need. Rows that repeat an id and vector count once; empty tables give no rows.
    """
    spark = vectors.sparkSession
    index = usable(vectors).distinct()
    alike = Window.partitionBy("embedding").orderBy("vec_id")
    index = index.withColumn("turn", F.row_number().over(alike)).filter(F.col("turn") <= k + 1) \
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    index = stored(spark, index.withColumn("h", F.xxhash64("embedding")))
    asked = stored(spark, usable(queries).distinct())
    found = index.agg(F.count("*").alias("n"), F.max(F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("m")).first()
    questions = asked.count()
    blocks, turns = max(1, -(-found["n"] // BLOCK)), max(1, -(-questions // QUERY_BLOCK))
    norm = float(np.sqrt(found["m"] or 1.0)) * (1 + 1e-9)
    # Every block of queries meets every block of vectors: each row is sent once per block of the other.
    right = index.withColumn("block", F.pmod("h", F.lit(blocks))) \
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))) \
        .select("block", "turn", "embedding", "ids")
    left = asked.withColumn("turn", F.pmod(F.xxhash64("vec_id"), F.lit(turns)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))) \
        .select("block", "turn", "vec_id", "embedding")

    def search(ask, held):
        return _search(ask, held, norm, k)

    pairs = left.groupBy("block", "turn").cogroup(right.groupBy("block", "turn")).applyInArrow(
        search, "query_id BIGINT, vec_id BIGINT, score DOUBLE")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")

