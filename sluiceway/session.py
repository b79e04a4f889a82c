"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# What the jobs rely on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, **settings) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sluiceway")
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        **settings,
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, as `--py-files` would; does nothing the second time."""
    if getattr(spark.sparkContext, "_sluiceway_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sluiceway-")) / "sluiceway.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, Path(root.name) / source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    spark.sparkContext._sluiceway_shipped = True


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir` for tables that cut a job in two.

    The setting must name storage every executor reaches. Only a local master may go
    without it: there a folder of this machine is as good.
    """
    global _local_folder
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if _local_folder is None:
            _local_folder = tempfile.mkdtemp(prefix="sluiceway-")
        base = _local_folder
    return f"{base.rstrip('/')}/sluiceway-{uuid.uuid4().hex}"
