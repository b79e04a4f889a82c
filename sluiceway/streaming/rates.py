"""Windowed rates of a stream kept in a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.operators.delivery import query_folder, run_folder
from sluiceway.operators.streams import throughput
from sluiceway.streaming.versions import folders, remove, written

#: Epochs that a replay may still write.
_OPEN = 2


def throughput_to_table(requests: DataFrame, path: str, checkpoint: str, every: str = "1 second",
                        by_tag: bool = False, available_now: bool = False, compact: int = 100):
    """Write each micro-batch's counts per window below its own folder, replaced on replay.

    Counts of a window add up over the folders, so an entry counts however late it comes and the query
    keeps no state. After every ``compact`` epochs those that are finished are merged into one table.
    """
    def keep(batch: DataFrame, epoch: int) -> None:
        throughput(batch, every, by_tag, fill=False).write.mode("overwrite").parquet(run_folder(batch, path, epoch))
        if epoch % compact == compact - 1:
            compact_run(batch.sparkSession, query_folder(batch, path))

    writer = requests.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _parts(spark: SparkSession, run: str) -> tuple[int, list[int], list[str]]:
    """Up to which epoch a run is merged (-1: none), the epochs after that, and the folders that count."""
    merged = max((int(e) for e in folders(spark, run, "upto=") if written(spark, f"{run}/upto={e}")), default=-1)
    later = sorted(e for e in map(int, folders(spark, run)) if e > merged)
    return merged, later, [f"{run}/upto={merged}"] * (merged >= 0) + [f"{run}/epoch={e}" for e in later]


def _summed(spark: SparkSession, parts: list[str]) -> DataFrame:
    counts = spark.read.parquet(*parts)
    keys = [c for c in ("window_start", "tag") if c in counts.columns]
    return counts.groupBy(*keys).agg(F.sum("entries").alias("entries"))


def compact_run(spark: SparkSession, run: str) -> None:
    """Merge the finished epochs of one query into one table, then remove what it replaces.

    A reader takes the last merged table that is complete and the epochs after it, so it
    counts each epoch once whenever it looks, also if this is cut short.
    """
    merged, later, _ = _parts(spark, run)
    done = later[:-_OPEN]
    if done:
        parts = [f"{run}/upto={merged}"] * (merged >= 0) + [f"{run}/epoch={e}" for e in done]
        _summed(spark, parts).write.mode("overwrite").parquet(f"{run}/upto={done[-1]}")
    last = done[-1] if done else merged
    for epoch in map(int, folders(spark, run)):
        if epoch <= last:
            remove(spark, f"{run}/epoch={epoch}")
    for epoch in map(int, folders(spark, run, "upto=")):
        if epoch < last:
            remove(spark, f"{run}/upto={epoch}")


def latest_rates(spark: SparkSession, path: str, every: str | None = None) -> DataFrame:
    """The counts of each window so far, of all queries that wrote there; with ``every`` rolled up to larger windows."""
    runs = [f"{path}/run={r}" for r in folders(spark, path, "run=")]
    parts = reduce(lambda a, b: a + b, (_parts(spark, r)[2] for r in runs), [])
    counts = _summed(spark, parts)
    if every is None:
        return counts
    keys = [c for c in counts.columns if c == "tag"]
    return counts.groupBy(F.window("window_start", every).alias("w"), *keys).agg(F.sum("entries").alias("entries")).select(
        F.col("w.start").alias("window_start"), *keys, "entries")
