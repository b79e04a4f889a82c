"""Counts beside the entries, and rates merged while a query runs."""

import datetime as dt
import re
import shutil

from pyspark.sql import functions as F

from sluiceway import schemas
from sluiceway.operators.delivery import dedupe_redelivery
from sluiceway.operators.streams import tag_totals, throughput
from sluiceway.plans import stream_queries, traffic
from sluiceway.plans.ingest import ingest
from sluiceway.streaming.rates import compact_run, latest_rates, throughput_to_table
from sluiceway.streaming.versions import folders

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_rates_and_totals_of_an_ingested_table_read_no_entry(spark, tmp_path):
    found = ingest(traffic.recorded(traffic.mixed_mode_segments(spark, SF)), str(tmp_path / "decoded"))
    for make in (tag_totals, lambda r: throughput(r, "1 hour", by_tag=True)):
        assert rows(make(found.counts)) == rows(make(found.requests))
        read = re.findall(r"ReadSchema: struct<(.*)", plan(make(found.counts)))
        assert read and not any(re.search(r"\bentries\b|record|props", s) for s in read)


def test_merged_epochs_count_once(spark, tmp_path):
    requests = stream_queries.event_requests(spark, SF)
    requests.repartition(7, "frame_no").write.parquet(str(tmp_path / "in"))
    path = str(tmp_path / "rates")

    def run(compact):
        stream = spark.readStream.schema(schemas.REQUESTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = throughput_to_table(stream, path, str(tmp_path / "check"), "1 hour", by_tag=True, available_now=True, compact=compact)
        query.awaitTermination(120)
        return f"{path}/run={query.id}"

    want = rows(throughput(requests, "1 hour", by_tag=True, fill=False))
    folder = run(3)
    epochs = sorted(map(int, folders(spark, folder)))
    assert len(epochs) <= 5 and len(folders(spark, folder, "upto=")) == 1
    assert rows(latest_rates(spark, path)) == want
    # Cut short between the merged table and the removal, or within the merged table.
    shutil.copytree(f"{folder}/epoch={epochs[0]}", f"{tmp_path}/kept")
    compact_run(spark, folder)
    merged = max(map(int, folders(spark, folder, "upto=")))
    assert merged >= epochs[0]
    shutil.copytree(f"{tmp_path}/kept", f"{folder}/epoch={epochs[0]}")
    (tmp_path / "rates" / folder.rsplit("/", 1)[1] / "upto=999").mkdir()
    assert rows(latest_rates(spark, path)) == want
    compact_run(spark, folder)
    assert str(epochs[0]) not in folders(spark, folder)
    # The query goes on after all that, and a second one has a folder of its own.
    requests.limit(50).withColumn("recv_ts", F.lit(dt.datetime(2031, 1, 1))).write.mode("append").parquet(str(tmp_path / "in"))
    assert run(100) == folder
    assert latest_rates(spark, path).agg(F.sum("entries")).first()[0] == requests.count() + 50
    days = rows(latest_rates(spark, path, "1 day").where("year(window_start) < 2031"))
    assert days == rows(throughput(requests, "1 day", by_tag=True, fill=False))


def test_a_stream_is_deduplicated_in_one_scan(spark, tmp_path):
    requests = stream_queries.order_requests(spark, SF)
    requests.unionByName(requests).repartition(3, "frame_no").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.REQUESTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = dedupe_redelivery(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    text = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    assert text.count("FileScan parquet") <= 1 and "Union" not in text
    assert spark.read.parquet(str(tmp_path / "out")).count() == requests.count()
