"""Tables that the epochs of a streaming query hand on to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _place(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, folder: str, prefix: str = "epoch=") -> list[str]:
    """What follows ``prefix`` in the names of a folder's folders; any storage that Spark reaches."""
    path, files = _place(spark, folder)
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


def remove(spark: SparkSession, folder: str) -> None:
    path, files = _place(spark, folder)
    files.delete(path, True)


def written(spark: SparkSession, folder: str) -> bool:
    """Whether a table there was written to its end."""
    path, files = _place(spark, f"{folder}/_SUCCESS")
    return files.exists(path)


def _epochs(spark: SparkSession, folder: str) -> list[int]:
    return sorted(map(int, folders(spark, folder)))


class Versions:
    """State as a table: each epoch reads the version before its own and writes a whole new one.

    An epoch that is run again finds the same version before it and replaces its own, so a replay
    changes nothing; the last `KEPT` versions stay for that. What is in the state is
    spread over tasks like any table, and no connection's state has to fit in one of them.
    """

    KEPT = 3

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, schema

    def _read(self, epochs: list[int]) -> DataFrame:
        if not epochs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/epoch={epochs[-1]}")

    def before(self, epoch: int) -> DataFrame:
        return self._read([e for e in _epochs(self.spark, self.folder) if e < epoch])

    def latest(self) -> DataFrame:
        """The last version written; meant for a query that doesn't run."""
        return self._read(_epochs(self.spark, self.folder))

    def write(self, rows: DataFrame, epoch: int) -> None:
        names = [c.split()[0] for c in self.schema.split(", ")]
        rows.select(*names).write.mode("overwrite").parquet(f"{self.folder}/epoch={epoch}")
        for old in [e for e in _epochs(self.spark, self.folder) if e < epoch][:-self.KEPT]:
            remove(self.spark, f"{self.folder}/epoch={old}")
