"""Sums and numbers along an order that no single task holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway.session import shared_folder


def in_order(rows: DataFrame, order: list[Column | str], then: tuple[Column | str, ...] = (),
             name: str = "row") -> DataFrame:
    """The rows as a stored table with a number that goes up along ``order``, then ``then``.

    Range-partitioned by ``order`` and sorted, so no task holds more than its range; numbers have gaps
    between ranges: `name >> 33` is the range, the rest counts within it. Rows equal in ``order`` share a
    range, and its borders pass the driver, so ``order`` holds narrow columns and long ones come in ``then``.
    """
    spark = rows.sparkSession
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order, *then).withColumn(
        name, F.monotonically_increasing_id())
    path = f"{shared_folder(spark)}-order"
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def running_sum(rows: DataFrame, value: str, name: str, row: str = "row") -> DataFrame:
    """Add the sum of ``value`` over all rows before each row of an `in_order` table.

    Ranges are summed first; only their sums, one row each, are added up in one task.
    """
    part = F.shiftright(row, 33)
    sums = rows.groupBy(part.alias("_part")).agg(F.sum(value).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_part", part)
        .withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_inside")).drop("_part", "_inside", "_offset"))
