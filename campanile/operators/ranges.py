"""Global ranks without a task that sorts the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 256
_SAMPLED = 20


def cuts(df: DataFrame, order: str, buckets: int = BUCKETS, seed: int = 7) -> tuple[list, int]:
    """(at most buckets - 1 ascending values of a column, the number of rows). Wherever they lie, only tasks' sizes depend on it."""
    n = df.count()
    some = df.select(order).where(F.col(order).isNotNull()).sample(min(1.0, _SAMPLED * buckets / max(1, n)), seed=seed)
    found = [r[0] for r in some.distinct().orderBy(order).limit(2 * _SAMPLED * buckets).collect()]  # about 20 for each bucket
    step = max(1, len(found) // buckets)
    return found[step::step][: buckets - 1], n


def bucket(value: Column, bounds: list, at: int = 0) -> Column:
    """How many of the ascending bounds a value isn't below, by bisection; NULL is in the first bucket."""
    if not bounds:
        return F.lit(at)
    mid = len(bounds) // 2
    return F.when(value >= F.lit(bounds[mid]), bucket(value, bounds[mid + 1 :], at + mid + 1)).otherwise(bucket(value, bounds[:mid], at))


def ranked(df: DataFrame, order: str, name: str = "rank", buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """(df with each row's rank from 1 by a column that names rows uniquely, NULL first; the number of rows).

    A rank is what the buckets before hold plus the place in one's own, so a task sorts a bucket at a time.
    """
    bounds, n = cuts(df, order, buckets)
    held = df.withColumn("_bucket", bucket(F.col(order), bounds))
    sizes = held.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))  # a row for each bucket
    before = F.sum("_size").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    return held.join(F.broadcast(starts), "_bucket").withColumn(name, F.col("_start") + place).drop("_bucket", "_start"), n
