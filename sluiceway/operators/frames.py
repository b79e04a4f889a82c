"""Connection bytes -> MessagePack values, one per row, in order per connection."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway import schemas
from sluiceway.functions import blocks
from sluiceway.operators.running import in_order, running_sum
from sluiceway.session import shared_folder

BLOCK_BYTES = 8 << 20
#: Borders of blocks pass the driver, 16 bytes each; beyond so many blocks grow instead.
MOST_BLOCKS = 1 << 20
#: Connections of fewer segments are one block; the others are found by the scan's statistics.
LONG_SEGMENTS = 256
#: What a segment counts besides its bytes.
SEGMENT_BYTES = 64


def reassemble_frames(
    segments: DataFrame,
    max_chunk_bytes: int | None = None,
    block_segments: int | None = None,
    block_bytes: int = BLOCK_BYTES,
    goes_on: bool = False,
) -> DataFrame:
    """Join split segments and split merged ones; faults are rows with `error_class` set.

    The unit of work is a block of consecutive segments of about ``block_bytes`` (or of ``block_segments`` in number,
    if given), not a connection, so a connection that holds a large share of all bytes is read by many
    tasks of equal size, whatever the size of its segments. A block must fit in a task, and
    should be several times the usual frame: what crosses block borders is handled twice.

    Connections of more than one block take an extra pass, run when this is called: their payload
    lengths are added up along (conn_id, seq) to find the borders, each
    of their blocks is scanned from a guessed boundary, the guesses are checked against
    the neighbours, and the blocks that guessed wrong are scanned again until all agree.
    The result does not depend on the block size. With ``goes_on`` each connection that has not failed also gives an
    `OPEN` row: its unfinished bytes in `frame`, the number of its next frame, what it waits for in `detail`. A value has at most 2 GiB, which is what a row holds.
    """
    limit = min(max_chunk_bytes or blocks.ROW_BYTES, blocks.ROW_BYTES)
    if block_segments:
        block_of = _block_of(segments, F.lit(1), block_segments, block_segments)
    else:
        block_of = _block_of(
            segments, F.octet_length("payload").cast("bigint") + SEGMENT_BYTES, block_bytes, LONG_SEGMENTS)
    frame = blocks.frame_blocks(limit, goes_on)
    if block_of is None:
        return _per_block(_with_block(segments, F.lit(0)), frame, schemas.FRAMES)

    parts = _with_block(segments, block_of)
    summaries = _agreed_summaries(parts.where("block > 0"), limit)
    spark = segments.sparkSession
    path = f"{shared_folder(spark)}-walk"
    _walk(summaries, limit, "final", blocks.FINAL_DDL, goes_on).write.parquet(path)
    final = spark.read.schema(blocks.FINAL_DDL).parquet(path)
    plan, values = (
        final.where(f"kind = '{kind}'").select(*[c.split()[0] for c in ddl.split(", ")])
        for kind, ddl in (("plan", blocks.PLAN_DDL), ("value", blocks.VALUE_DDL)))
    inside = _per_block(
        parts.unionByName(_control(plan, F.lit(None).cast("binary"), "start", "base")),
        frame, schemas.FRAMES)
    return inside.unionByName(_crossing(values, summaries, plan))


def _places(conn: np.ndarray, seq: np.ndarray) -> np.ndarray:
    """Keys of 16 bytes that sort as (conn, seq)."""
    both = np.stack([np.asarray(x, dtype=np.int64) for x in (conn, seq)], axis=1)
    sorted_ = (both.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
    return np.ascontiguousarray(sorted_).view("S16").ravel()


def _block_of(segments: DataFrame, weight: Column, size: int, least_segments: int) -> Column | None:
    """The block of a segment: 0 for connections of one block, else counted along (conn_id, seq).

    Blocks weigh ``size``, or more if there would be over `MOST_BLOCKS`: weights are summed along all
    long connections in order, wherever they lie, and a block begins where the sum passes a multiple.
    None if all connections are short; what has no segment number of ``least_segments`` is short unseen.
    """
    if segments.where(F.col("seq") >= least_segments).select("conn_id").isEmpty():
        return None
    totals = segments.groupBy("conn_id").agg(F.sum(weight).alias("total"))
    longest = lambda over: totals.where(F.col("total") > over).limit(MOST_BLOCKS + 1).collect()
    found = longest(size)
    if len(found) > MOST_BLOCKS:
        size = -(-totals.agg(F.sum("total")).first()[0] // MOST_BLOCKS)
        found = longest(size)       # not more than fit into all weight
    size = max(size, -(-sum(r["total"] for r in found) // MOST_BLOCKS))
    ids = np.array(sorted(r["conn_id"] for r in found if r["total"] > size), dtype=np.int64)
    if not len(ids):
        return None

    @F.pandas_udf("boolean")
    def is_long(conn: pd.Series) -> pd.Series:
        at = np.searchsorted(ids, conn.to_numpy())
        return pd.Series(ids[np.minimum(at, len(ids) - 1)] == conn.to_numpy())

    narrow = segments.select("conn_id", "seq", weight.alias("weight")).where(is_long("conn_id"))
    sums = running_sum(in_order(narrow, ["conn_id", "seq"]), "weight", "before")
    starts = sums.groupBy(F.floor(F.col("before") / size)).agg(F.min(F.struct("conn_id", "seq")).alias("start"))
    found = np.array(sorted(tuple(r["start"]) for r in starts.collect()), dtype=np.int64)
    borders = _places(found[:, 0], found[:, 1])

    @F.pandas_udf("bigint")
    def block_of(conn: pd.Series, seq: pd.Series) -> pd.Series:
        place = np.searchsorted(borders, _places(conn.to_numpy(), seq.to_numpy()), side="right")
        at = np.minimum(np.searchsorted(ids, conn.to_numpy()), len(ids) - 1)
        return pd.Series(np.where(ids[at] == conn.to_numpy(), place, 0))

    return block_of("conn_id", "seq")


def _control(rows: DataFrame, payload, a: str, b: str) -> DataFrame:
    """Rows that go before the segments of a block and tell its task how to read it."""
    none = lambda kind: F.lit(None).cast(kind)
    return rows.select(
        "conn_id", none("string").alias("remote_addr"), "block",
        F.lit(-1).cast("bigint").alias("seq"), none("bigint").alias("recv_us"),
        payload.alias("payload"), F.col(a).alias("ctl_a"), F.col(b).alias("ctl_b"))


def _crossing(values: DataFrame, summaries: DataFrame, plan: DataFrame) -> DataFrame:
    """Values (and faulty ends) that lie in several blocks, from those blocks' edges."""
    edges = summaries.select("conn_id", "block", "head", "tail").join(
        plan.where("head_of IS NOT NULL OR tail_of IS NOT NULL"), ["conn_id", "block"])
    piece = lambda side, order: F.struct(
        F.col(f"{side}_of").alias("frame_no"), order.alias("ord"), F.col(side).alias("payload"))
    pieces = edges.select("conn_id", F.explode(F.array(
        piece("head", F.col("block") * 2), piece("tail", F.col("block") * 2 + 1))).alias("p")
    ).select("conn_id", "p.*").where("frame_no IS NOT NULL AND octet_length(payload) > 0")
    rows = pieces.unionByName(
        values.withColumn("ord", F.lit(-1).cast("bigint")), allowMissingColumns=True)
    return (
        rows.repartition("conn_id", "frame_no")
        .sortWithinPartitions("conn_id", "frame_no", "ord")
        .mapInArrow(blocks.assemble_values, schemas.FRAMES))


def _with_block(segments: DataFrame, block: Column) -> DataFrame:
    return segments.select(
        "conn_id", "remote_addr", block.cast("bigint").alias("block"), "seq",
        F.unix_micros("recv_ts").alias("recv_us"), "payload",
        F.lit(None).cast("bigint").alias("ctl_a"), F.lit(None).cast("bigint").alias("ctl_b"))


def _per_block(rows: DataFrame, body, ddl: str, unit: str = "block") -> DataFrame:
    """Run ``body`` with all rows of a block in one task, control row first, by `seq`.

    The number of tasks is the session's `spark.sql.shuffle.partitions` as it stands:
    adaptive merging goes by compressed bytes, and these tasks are bound by the cores.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(tasks, "conn_id", unit)
        .sortWithinPartitions("conn_id", "block", "seq").drop(*{unit} - {"block"})
        .mapInArrow(body, ddl)
    )


def _walk(summaries: DataFrame, limit, want: str, ddl: str, goes_on: bool = False) -> DataFrame:
    """Go over each connection's block states in order; their bytes are not read.

    A connection's states go through one task: some hundred bytes each, and never more than `MOST_BLOCKS`.
    """
    return (
        summaries.select(*blocks.THIN_COLUMNS).repartition("conn_id")
        .sortWithinPartitions("conn_id", "block")
        .mapInArrow(blocks.walk_blocks(limit, want, goes_on), ddl)
    )


def chains(wrong: DataFrame, turn: int) -> DataFrame:
    """Runs of neighbouring wrong blocks in pieces of 2 ** ``turn``, which one task scans one after another.

    The first block of a `chain` has to go on from a known state. As pieces double, a run
    of any length, even one that is a whole connection, is right after a logarithmic number of rounds.
    """
    run = F.col("block") - F.row_number().over(Window.partitionBy("conn_id").orderBy("block"))
    place = F.row_number().over(Window.partitionBy("conn_id", "_run").orderBy("block")) - 1
    first = F.first("need").over(Window.partitionBy("conn_id", "chain").orderBy("block"))
    cut = wrong.withColumn("_run", run).withColumn(
        "chain", F.col("block") - (place % (1 << min(turn, 30)))).withColumn("_first", first)
    alone = F.col("chain") == F.col("block")
    return cut.where("_first IS NOT NULL").select(
        "conn_id", "block", "chain", *[F.when(alone, F.col(c)).alias(c) for c in ("need", "skip", "part")])


def _agreed_summaries(many: DataFrame, limit) -> DataFrame:
    """Summaries of the blocks of long connections, once all of them fit together.

    Written tables carry each round, so a lost executor costs one round at most. The
    first block whose entry is not yet proven is right after every round, and so are the blocks of its
    chain; hence the end.
    """
    spark = many.sparkSession
    folder = shared_folder(spark)
    scan = blocks.summarise_blocks(limit)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    summaries = stored(_per_block(many, scan, blocks.SUMMARY_DDL), "scan-0")
    turn = 0
    while True:
        doubts = stored(_walk(summaries, limit, "doubt", blocks.DOUBT_DDL), f"doubt-{turn}")
        to_check = doubts.where("NOT wrong").join(
            summaries.select("conn_id", "block", "head"), ["conn_id", "block"])
        wrong = stored(
            doubts.where("wrong").unionByName(
                to_check.mapInArrow(blocks.check_heads, blocks.DOUBT_DDL)), f"wrong-{turn}")
        if wrong.isEmpty():
            return summaries
        chained = stored(chains(wrong, turn), f"chain-{turn}")
        turn += 1
        keys = chained.select("conn_id", "block", "chain")
        again = many.join(keys, ["conn_id", "block"])
        control = _control(chained, F.col("part"), "need", "skip").join(keys, ["conn_id", "block"])
        rescanned = stored(_per_block(again.unionByName(control), scan, blocks.SUMMARY_DDL, "chain"), f"scan-{turn}")
        summaries = summaries.join(keys, ["conn_id", "block"], "left_anti").unionByName(rescanned)


def frames_only(frames: DataFrame) -> DataFrame:
    """The complete values, without the fault rows."""
    return frames.where("error_class IS NULL").drop("error_class", "detail")


def framing_rejects(frames: DataFrame) -> DataFrame:
    """The fault that ended each broken or cut-off connection."""
    return frames.where("error_class IS NOT NULL").select(
        "conn_id", "frame_no", "recv_ts", "error_class", "detail", "frame")
