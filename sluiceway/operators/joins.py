"""Joins against a table with unique keys when the other side may have hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FAN = 16


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str, spread_by: list[str],
                fan: int = FAN) -> DataFrame:
    """Equi-join on ``key`` with each key of ``left`` spread over ``fan`` tasks.

    ``right`` holds each key once and only narrow columns; it is repeated ``fan`` times.
    ``spread_by`` names columns of ``left`` that differ between rows of one key. The copies are never
    broadcast: Spark's estimate counts an `explode` as no more than its input, and so ``fan`` times what
    may be broadcast would go through the driver.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(fan)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
    return salted.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")


#: A key is heavy if it holds more than this part of all rows, so there are fewer heavy keys than that.
HEAVY_PART = 512
LEAST_HEAVY = 2_000


def measured_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, spread_by: list[str],
                  part: int = HEAVY_PART, least: int = LEAST_HEAVY) -> DataFrame:
    """Equi-join whose keys of ``left`` are counted first; only heavy ones are salted.

    A key with more than 1/``part`` of the rows (and more than ``least``) goes to as many tasks as
    it exceeds that, its rows of ``right`` to each of them; at most ``part`` keys are heavy, and only
    those are broadcast. ``right`` holds each key once; ``left`` is read twice, so it is best a
    stored table. Null keys match nothing and are never heavy.
    """
    counts = left.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).agg(
        F.count("*").alias("_n"))
    limit = max(least, left.count() // part)
    heavy = F.broadcast(counts.where(F.col("_n") > limit).select(
        *keys, F.ceil(F.col("_n") / limit).cast("int").alias("_fan")))
    fan = F.coalesce("_fan", F.lit(1))
    salted = left.join(heavy, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), fan).cast("int")).drop("_fan")
    copies = right.join(heavy, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), fan - 1))).drop("_fan")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
