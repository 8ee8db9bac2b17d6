"""Profiling aggregates.

All of them are partial-then-final hash aggregations; totals for percentages
come from a one-row aggregate cross-joined back (broadcast of one row), so no
value passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustlens.functions.text import col_of


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """G1: rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def distribution(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """Rows per value and share of all rows in percent."""
    counts = value_counts(df, col)
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
                  .withColumn("pct", F.round(F.col("count") * 100.0 / F.col("_total"), digits))
                  .drop("_total"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def duplicates(df: DataFrame, col: str) -> DataFrame:
    """Non-null values that occur more than once, with their counts."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1))


def histogram(df: DataFrame, col: str, bins: int = 30, lo: float = 0.0, hi: float = 200.0
              ) -> DataFrame:
    """Equal-width histogram of ``clip(col, lo, hi)``.

    Edges run from the clipped minimum to the clipped maximum of the data (the
    way numpy builds them); the last bin is closed. Empty bins are included:
    the bin list is generated from ``bins`` (bounded) and left-joined.
    """
    v = F.least(F.greatest(F.col(col).cast("double"), F.lit(lo)), F.lit(hi))
    clipped = df.select(v.alias("_v"))
    rng = clipped.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    counted = (clipped.crossJoin(F.broadcast(rng)).select(b.alias("bin"))
                      .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = all_bins.crossJoin(F.broadcast(rng)).select(
        "bin",
        (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_end"))
    return (edges.join(counted, "bin", "left")
                 .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long")))


def score_histogram(df: DataFrame, col: str = "fake_score", threshold: int = 4) -> DataFrame:
    """Rows per integer score, flagged at or above the threshold."""
    return (value_counts(df, col)
            .withColumn("at_or_above_threshold", F.col(col) >= threshold))


def rate(df: DataFrame, flag: Column | str, digits: int = 6) -> DataFrame:
    """Share of rows where ``flag`` is true, in percent."""
    return df.agg(F.round(F.avg(col_of(flag).cast("int")) * 100.0, digits).alias("pct"))


def count_where(df: DataFrame, pred: Column, name: str = "count") -> DataFrame:
    """G8."""
    return df.agg(F.count_if(pred).alias(name))


def class_counts(df: DataFrame, col: str = "y") -> DataFrame:
    """G9."""
    return value_counts(df, col)


# The two approximate percentiles around the median: their rank error is at most
# n / MEDIAN_ACCURACY each, so the exact median always lies between them.
MEDIAN_ACCURACY = 100_000
MEDIAN_MARGIN = 2 / MEDIAN_ACCURACY


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One row ``median``: exact, without all values in one task. Rows below two
    close percentiles are only counted; the few distinct values between them are
    ranked with their counts. No values: null."""
    v = df.select(F.col(col).cast("double").alias("v")).where("v IS NOT NULL")
    ends = v.agg(F.percentile_approx("v", [0.5 - MEDIAN_MARGIN, 0.5 + MEDIAN_MARGIN], MEDIAN_ACCURACY).alias("e"),
                 F.count("*").alias("n"))
    near = v.crossJoin(F.broadcast(ends)).where("v <= e[1]")
    per = near.groupBy(F.when(F.col("v") >= F.col("e")[0], F.col("v")).alias("v"), "n").agg(F.count("*").alias("c"))
    w = Window.orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = per.withColumn("upto", F.sum("c").over(w)).where(
        "v IS NOT NULL AND upto >= (n + 1) div 2 AND upto - c < n div 2 + 1")
    return at.agg(F.avg("v").alias("median"))


def confidence_stats(df: DataFrame, col: str = "confidence", high: float = 0.8,
                     exact: bool = True, digits: int = 6) -> DataFrame:
    """Mean, median, sample std and count above ``high``.

    ``exact=False`` takes ``percentile_approx``: one pass over the input instead of three.
    """
    c = F.col(col)
    aggs = [F.count(c).alias("n"), F.round(F.avg(c), digits).alias("mean"),
            F.round(F.stddev_samp(c), digits).alias("std"), F.count_if(c > high).alias("n_high")]
    if not exact:
        return df.agg(*aggs, F.round(F.percentile_approx(c, 0.5, 10000), digits).alias("median"))
    return df.agg(*aggs).crossJoin(F.broadcast(exact_median(df, col))).withColumn("median", F.round("median", digits))


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "review_id",
             cols: list[str] | None = None) -> DataFrame:
    """N rows in the order of a seeded hash of the key (the limit is the
    feature: a fixed-size sample). ``orderBy().limit()`` plans a
    TakeOrderedAndProject: each task keeps its n best, one merge of n x tasks."""
    from trustlens.operators.sampling import hash_key
    out = df.withColumn("_h", hash_key(seed, "sample", key)).orderBy("_h", key).limit(n)
    return out.select(*(cols or df.columns))
