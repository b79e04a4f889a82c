"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the input
and the cores. Wire traffic is recorded once, outside the timed part, as a server would
have left it; a timed query then reads that recording.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sluiceway.operators.frames import reassemble_frames  # noqa: E402
from sluiceway.operators.requests import decode_requests, explode_events  # noqa: E402
from sluiceway.plans import traffic  # noqa: E402
from sluiceway.plans.catalog import QUERIES  # noqa: E402
from sluiceway.session import local_session, ship_package  # noqa: E402
from sluiceway.sources.tables import read_segments  # noqa: E402

WHOLE = ["throughput_by_tag", "tag_totals", "acks", "dedupe_redelivery", "order_streams",
         "render_streams", "distinct_events", "match_clients", "check_pings", "admit",
         "documents_roundtrip", "rejects_by_class"]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, 2 * int(cpus))
    ship_package(spark)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    recorded = {}
    for name, hot in (("plain", False), ("hot", True)):
        path = f"{folder}/{name}"
        traffic.mixed_mode_segments(spark, sf_dir, hot).write.parquet(path)
        recorded[name] = read_segments(spark, path)
    size = recorded["plain"].agg(F.sum(F.octet_length("payload"))).first()[0]

    def events(segments, **options):
        return explode_events(decode_requests(reassemble_frames(segments, **options)))

    jobs = {
        "framing_only": lambda: reassemble_frames(recorded["plain"]).drop("frame"),
        "segments_to_events": lambda: events(recorded["plain"]),
        "segments_to_events_hot": lambda: events(recorded["hot"], block_segments=512),
        **{name: (lambda q=QUERIES[name][0]: q(spark, sf_dir)) for name in WHOLE},
    }
    times = {}
    for name, job in jobs.items():
        took = []
        for _ in range(2):      # the first run also compiles
            began = time.perf_counter()
            run(job())
            took.append(time.perf_counter() - began)
        times[name] = round(min(took), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "total seconds of the headline queries, best of two",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "events_per_sec": round(rows / times["segments_to_events"]),
        "framing_mb_per_sec": round(size / 1e6 / times["framing_only"], 2)}))


if __name__ == "__main__":
    main()
