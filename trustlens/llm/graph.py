"""Connected components over an edge table, by alternating star rounds.

Every round is written to the shared checkpoint folder; nodes with very many
neighbours only meet in minima (combined before the shuffle) and in joins whose
other side has one row per node, which Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.session import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(u, v): each linked node above the smallest of its component, and that one."""
    state = None
    e = materialize(edges.where("u <> v").select("u", "v"), name)
    while True:
        e = materialize(_small_star(_large_star(e)), name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return e
        state = now
