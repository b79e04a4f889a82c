"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Every document of a source is taken in whole copies first: the source's rate (target words over
words it has), rounded down. The rest of the target is a sample without repeats. Documents are ranked
by their random odds u / (1 - u) divided by their inclusion odds p / (1 - p), and the sample is as many
of them, in that order, as come nearest to the words still wanted: its size is fixed, while the
chances differ from document to document with its source's rate (and its own weight, if given).

The place where a source's sample ends is found without sorting the source: ranks fall into
`BUCKETS` buckets whose words are summed first, and only the bucket that holds the end is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.components import free_name, stored

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
BUCKETS = 1 << 14
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(doc_id: Column) -> Column:
    """A fixed number in (0, 1) for each document id."""
    text = F.concat(F.lit(SEED + "|"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from `sizes(source, source_size)`, one row per source.

    Sources by code point, null last, weigh `weights`, repeating. Their targets share all words by
    weight; none is above `max_repeats` times its source's words, and what that leaves goes to
    the others by weight. With caps in the order of cap over weight, the sources behind some place
    share what the caps before it leave: the first place whose share fits under its own cap is right.
    """
    n = len(weights)
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    held = sizes.withColumn("rank", rank) \
        .withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % n + 1)) \
        .withColumn("cap", F.col("source_size") * float(max_repeats)) \
        .withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", "rank")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    held = held.withColumn("total", F.sum("source_size").over(everything)) \
        .withColumn("share", (F.col("total") - before) / behind)
    level = F.max(F.when(F.col("share") <= F.col("ratio"), F.col("share"))).over(everything)
    return held.withColumn("level", level).select(
        "source", "source_size", F.least("cap", F.col("w") * F.coalesce("level", F.lit(0.0))).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = MAX_REPEATS,
                weight: Column | None = None) -> DataFrame:
    """The rows of `docs(doc_id, text, source, ...)` with (size, source_size, target, copies).

    `copies` says how often the mix holds a row, 0 to `max_repeats`; `size` counts the words
    between ASCII white space (null: 0). `weight`, a positive column, makes some documents of a source
    likelier than others; without it all have the rate of their source. New columns get a
    trailing underscore where the table has their name. Choices depend on doc_id alone, so a second run
    agrees; rows with one doc_id share their fate. A source without words takes nothing, null is a
    source of its own, the last; an empty table gives none. A source's taken words miss its target
    by at most half the size of the document at the end of its sample, if weights leave room.
    """
    spark = docs.sparkSession
    size, odds, whole = (free_name(docs, n) for n in ("size", "odds", "whole"))
    sized = docs.withColumn(size, word_count(F.col("text")))
    if weight is None:
        sums = sized.groupBy("source").agg(F.sum(size).alias("source_size"))
        sums = sums.withColumn("mean_weight", F.lit(1.0))
    else:
        sums = sized.groupBy("source").agg(
            F.sum(size).alias("source_size"),
            (F.sum(weight * F.col(size)) / F.sum(size)).alias("mean_weight"))
    sums = stored(spark, sums)
    rates = source_targets(sums.select("source", "source_size"), weights, max_repeats)
    rates = rates.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))) \
        .join(sums.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"), "mean_weight"), "key")
    rates = stored(spark, rates.select(
        "key", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0).alias("rate"), "mean_weight"))

    names = {n: free_name(docs, n) for n in ("key", "source_size", "target", "rate", "mean_weight", "end_odds",
                                             "end_id", "copies")}
    named = rates.select(*[F.col(c).alias(names[c]) for c in rates.columns])
    source_key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    own = F.lit(1.0) if weight is None else weight
    ranked = sized.withColumn(names["key"], source_key).join(named, names["key"])
    expected = F.least(F.lit(float(max_repeats)), F.col(names["rate"]) * own / F.col(names["mean_weight"]))
    p = expected - F.floor(expected)
    u = _uniform(F.col("doc_id"))
    ranked = ranked.withColumn(whole, F.floor(expected).cast("long")) \
        .withColumn(odds, F.when((p > 0) & (p < 1), (u / (1 - u)) / (p / (1 - p))))

    # Where each source's sample ends.
    drawn = ranked.select(
        F.col(names["key"]).alias("key"), F.col("doc_id").alias("id"), F.col(size).alias("size"),
        F.col(odds).alias("odds"), F.col(whole).alias("whole"),
        F.floor(F.col(odds) / (1 + F.col(odds)) * BUCKETS).alias("bucket"))
    buckets = drawn.groupBy("key", "bucket").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("certain"))
    inside = Window.partitionBy("key").orderBy(F.col("bucket").asc_nulls_last())
    buckets = buckets.join(rates.select("key", "target"), "key") \
        .withColumn("rest", F.col("target") - F.sum("certain").over(Window.partitionBy("key"))) \
        .withColumn("before", F.sum("words").over(inside) - F.col("words")) \
        .withColumn("next", F.lead("bucket").over(inside)) \
        .filter("bucket IS NOT NULL AND before <= rest AND (rest < before + words OR next IS NULL)")
    ends = drawn.join(buckets.select("key", "bucket", "rest", "before"), ["key", "bucket"]) \
        .groupBy("key", "rest", "before", "odds", "id").agg(F.sum("size").alias("size"))
    run = F.sum("size").over(Window.partitionBy("key").orderBy("odds", F.col("id").asc_nulls_first()))
    ends = ends.withColumn("middle", F.col("before") + run - F.col("size") / 2)
    # The last one in; if none of the bucket is, an end in front of them all.
    last = F.max(F.when(F.col("middle") <= F.col("rest"), F.struct("odds", F.coalesce("id", F.lit(-(1 << 63))).alias("id"))))
    first = F.min("odds")
    ends = stored(spark, ends.groupBy("key").agg(last.alias("last"), first.alias("first")).select(
        F.col("key").alias(names["key"]),
        F.coalesce("last.odds", F.col("first")).alias(names["end_odds"]),
        F.when(F.col("last").isNotNull(), F.col("last.id")).alias(names["end_id"])))

    here, end = F.col(odds), F.col(names["end_odds"])
    identity = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    extra = (here < end) | ((here == end) & (identity <= F.col(names["end_id"])))
    return ranked.join(ends, names["key"], "left").withColumn(
        names["copies"], F.col(whole) + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)).select(
        *[F.col(f"`{c}`") for c in docs.columns], size, names["source_size"], names["target"], names["copies"])


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, with its own columns."""
    mixed = mix_sources(docs)
    copies, turn = mixed.columns[-1], free_name(docs, "turn")
    return mixed.filter(F.col(copies) > 0) \
        .withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


#: DuckDB SQL of the same mix, for the rows of a relation `{documents}`.
MIX_SQL = r"""
sized AS (SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size_ FROM {documents}),
sources AS (SELECT source, sum(size_)::BIGINT AS source_size_ FROM sized GROUP BY source),
weighed AS (SELECT *, (((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::DOUBLE AS w,
                   row_number() OVER (ORDER BY source NULLS LAST) AS rank_, source_size_ * 3.0::DOUBLE AS cap FROM sources),
shared AS (SELECT *, cap / w AS ratio,
       ((sum(source_size_) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, rank_
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       / (sum(w) OVER (ORDER BY cap / w, rank_ ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS share FROM weighed),
levels AS (SELECT *, max(CASE WHEN share <= ratio THEN share END) OVER () AS level FROM shared),
targets AS (SELECT source, source_size_, least(cap, w * coalesce(level, 0)) AS target_,
                   CASE WHEN source_size_ > 0 THEN least(cap, w * coalesce(level, 0)) / source_size_ ELSE 0 END AS rate
            FROM levels),
chances AS (SELECT s.*, t.source_size_, t.target_, floor(least(3.0, rate))::BIGINT AS whole,
                   least(3.0, rate) - floor(least(3.0, rate)) AS p,
                   (('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
                   / 4503599627370496.0::DOUBLE AS u
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (SELECT *, CASE WHEN p > 0 AND p < 1 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds,
                  sum(size_ * whole) OVER (PARTITION BY source) AS certain FROM chances),
summed AS (SELECT *, sum(CASE WHEN odds IS NOT NULL THEN size_ END) OVER (PARTITION BY source
                         ORDER BY odds NULLS LAST, doc_id NULLS FIRST) AS upto,
                  sum(size_) OVER (PARTITION BY source, odds, doc_id) AS same FROM ranked),
mix AS (SELECT *, whole + CASE WHEN odds IS NOT NULL AND upto - same / 2 <= target_ - certain THEN 1 ELSE 0 END AS copies_
        FROM summed)
"""
