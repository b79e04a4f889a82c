"""Where segments come from and where events go: Spark's own readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sluiceway import schemas


def read_segments(spark: SparkSession, path: str, stream: bool = False,
                  files_per_trigger: int | None = None, bytes_per_trigger: str | None = None) -> DataFrame:
    """Recorded connection bytes from Parquet; a stream picks up new files as they come."""
    schema = StructType.fromDDL(schemas.SEGMENTS)
    if not stream:
        return spark.read.schema(schema).parquet(path)
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def segments_from_messages(messages: DataFrame) -> DataFrame:
    """Segments from a topic read by Spark's Kafka source with `includeHeaders`.

    The key is the connection id as text, the value its bytes, the headers `seq` (the
    segment's number as text) and `remote_addr`.
    """
    header = lambda name: F.expr(
        f"CAST(element_at(filter(headers, h -> h.key = '{name}'), 1).value AS STRING)")
    return messages.select(
        F.col("key").cast("string").cast("bigint").alias("conn_id"),
        header("remote_addr").alias("remote_addr"),
        header("seq").cast("bigint").alias("seq"),
        F.col("timestamp").alias("recv_ts"),
        F.col("value").alias("payload"))


def write_events(events: DataFrame, path: str, mode: str = "append",
                 partition_by: tuple[str, ...] = ("event_date", "tag"), checkpoint: str | None = None):
    """Events as Parquet below one folder per date and tag.

    In a batch, rows of one folder are brought together first so that files are few and
    large; a folder with much data is spread over several tasks.
    """
    dated = events.withColumn("event_date", F.to_date("event_ts"))
    if events.isStreaming:
        writer = dated.writeStream.format("parquet").outputMode("append").option("path", path)
        if checkpoint:
            writer = writer.option("checkpointLocation", checkpoint)
        return writer.partitionBy(*partition_by).trigger(availableNow=True).start()
    dated.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    return None


def epoch_sink(path: str):
    """A `deliver` function: each epoch's events below their own folder of its query, replaced on replay."""
    from sluiceway.operators.delivery import run_folder
    from sluiceway.operators.requests import explode_events

    def write(batch: DataFrame, epoch: int) -> None:
        explode_events(batch).write.mode("overwrite").parquet(run_folder(batch, path, epoch))

    return write
