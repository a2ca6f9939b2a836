"""Bounded samples of rows and tables for the driver, without sending each task's best to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANGE = 1 << 40


def sample_ids(rows: DataFrame, id_col: str, most: int) -> list:
    """At most ``most`` ids, those of least hash; null ids never.

    A share of the hash range that holds about twice as many is filtered first, so
    that tasks send few rows at any size.
    """
    ids = rows.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull())
    n = ids.count()
    place = F.pmod(F.xxhash64("id"), F.lit(_RANGE))
    near = ids.where(place < int(_RANGE * min(1.0, 2 * most / max(n, 1))))
    return [r[0] for r in near.distinct().orderBy(F.xxhash64("id"), "id").limit(most).collect()]


def sample_ids_by(rows: DataFrame, id_col: str, by: str, most: int) -> list:
    """At most ``most`` ids with an equal share for each value of ``by`` (few values), those of least hash."""
    ids = rows.select(F.col(id_col).alias("id"), F.col(by).alias("by")).where(F.col("id").isNotNull())
    counts = {r["by"]: r["count"] for r in ids.groupBy("by").count().collect()}
    share = max(1, most // max(1, len(counts)))
    if not counts:
        return []
    cuts = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(_RANGE * min(1.0, 2 * share / n))))])
    place = F.pmod(F.xxhash64("id"), F.lit(_RANGE))
    near = ids.where(place < cuts[F.col("by")]).select("by", "id", F.xxhash64("id").alias("h")).distinct()
    order = Window.partitionBy("by").orderBy("h", "id")  # about twice the share in each
    found = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= share).select("id").distinct()
    return [r[0] for r in found.orderBy("id").limit(most).collect()]


def at_least(counts: DataFrame, n_col: str, least: int, most: int) -> int:
    """The least count from which on there are at most ``most`` rows, not below ``least``.

    Found from a histogram with 16 steps to each doubling, so of bounded size; it may
    leave out rows of one step that would have fitted.
    """
    step = F.floor(F.log2(F.col(n_col)) * 16)
    bars = counts.where(F.col(n_col) >= least).groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min(n_col).alias("low")).collect()
    total, cut = 0, None
    for bar in sorted(bars, key=lambda b: -b.step):
        if (total := total + bar.n) > most:
            break
        cut = bar.low
    return cut if cut is not None else 1 << 62
