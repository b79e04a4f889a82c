"""The plans the operators are meant to get: shuffles, pushdown, join kinds."""

import re

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.frames import reassemble_frames
from sluiceway.operators.requests import decode_requests, explode_events
from sluiceway.plans import admission_queries, stream_queries, traffic
from sluiceway.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def segments(spark):
    return traffic.recorded(traffic.mixed_mode_segments(spark, SF))


def test_one_shuffle_from_segments_to_events(segments):
    text = plan(explode_events(decode_requests(reassemble_frames(segments))))
    assert len(re.findall(r"Exchange ", text)) == 1
    assert len(re.findall(r"MapInArrow", text)) == 2
    assert "EvalPython" not in text


@pytest.mark.parametrize("hot", [False, True])
def test_traffic_is_dealt_once(spark, hot):
    text = plan(traffic.mixed_mode_segments(spark, SF, hot))
    assert len(re.findall(r"Exchange ", text)) == 1


def test_long_connections_are_found_by_pushdown(segments):
    text = plan(segments.where(F.col("seq") >= 8192).select("conn_id"))
    assert "PushedFilters: [IsNotNull(seq), GreaterThanOrEqual(seq,8192)]" in text
    assert "ReadSchema: struct<conn_id:bigint,seq:bigint>" in text


@pytest.mark.parametrize("name", [
    "match_clients", "check_pings", "pong_rows", "admit", "eligible_users", "decode_pings",
    "acks", "unacked", "dedupe_redelivery", "throughput_by_tag", "stream_difference", "order_streams"])
def test_no_nested_loops_or_cross_joins(spark, name):
    text = plan(QUERIES[name][0](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_each_distinct_address_is_parsed_once(spark):
    text = plan(admission_queries.matched(spark, SF))
    assert len(re.findall(r"ArrowEvalPython \[address_bits", text)) == 1
    assert text.index("ArrowEvalPython [address_bits") < text.index("FileScan parquet", text.index("address_bits"))


def test_rates_read_two_columns(spark):
    text = plan(stream_queries.throughput_by_tag(spark, SF))
    assert all(set(re.findall(r"(\w+):", s)) <= {"ts", "event_type", "props"} for s in re.findall(r"ReadSchema: struct<([^>]*)>", text))


def test_hot_keys_are_salted_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(admission_queries.admitted(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[conn_id#\d+L, _salt#\d+\]", text)


def test_salted_copies_are_not_broadcast(spark):
    """Spark takes the copies for no larger than what they are made of."""
    text = plan(admission_queries.admitted_any_verdict(spark, SF))
    assert re.search(r"SortMergeJoin \[conn_id#\d+L, _salt#\d+\]", text) and "BroadcastExchange" not in text


@pytest.mark.parametrize("name", ["match_clients", "check_pings", "decode_pings", "admit", "dedupe_redelivery"])
def test_shuffled_joins_give_the_same_rows(spark, name):
    """What small tables broadcast is shuffled on large ones."""
    query = QUERIES[name][0]
    want = sorted(map(str, query(spark, SF).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, query(spark, SF).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
