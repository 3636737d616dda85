"""Joins by fallback keys, best-of choices, set operations and directory matches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.functions.paths import sanitized, strip_functional


def last_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the greatest order (NULL is the least); ties go to the greatest hash of the row, by an aggregate that starts in each task."""
    others = [c for c in df.columns if c != key]
    hashed = F.xxhash64(*[c for c in others if not df.schema[c].dataType.typeName() == "map"])
    best = F.max_by(F.struct(*others), F.struct(F.col(order), hashed)).alias("_best")
    return df.groupBy(key).agg(best).select(key, "_best.*").select(df.columns)


def spine(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """The distinct keys of all tables."""
    return reduce(DataFrame.unionByName, [t.select(key) for t in tables]).distinct()


def on_spine(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Every key of any table with each table's columns, prefixed by its name."""
    out = spine(list(tables.values()), key)
    for name, t in tables.items():
        out = out.join(t.select(key, *[F.col(c).alias(f"{name}_{c}") for c in t.columns if c != key]), key, "left")
    return out


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows; columns that a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def best_of(main: DataFrame, alt: DataFrame, key: str, valid: Column, value: str) -> DataFrame:
    """Of two runs of each key the valid one, else the one with the lower value (ties and missing values: main); ``source`` says which.

    valid: a condition over a run's columns. Keys without a valid run are kept, with ``has_valid`` false.
    """
    side = lambda df, n: df.select(key, F.struct(*[c for c in df.columns if c != key], F.coalesce(valid, F.lit(False)).alias("_valid")).alias(n))
    both = side(main, "main").join(side(alt, "alt"), key, "full")
    vm, va = F.coalesce(F.col("main._valid"), F.lit(False)), F.coalesce(F.col("alt._valid"), F.lit(False))
    lower = F.coalesce(F.col(f"alt.{value}") < F.col(f"main.{value}"), F.lit(False))
    use_alt = F.col("main").isNull() | (va & ~vm) | ((vm == va) & F.col("alt").isNotNull() & lower)
    chosen = F.when(use_alt, F.col("alt")).otherwise(F.col("main"))
    return both.select(key, F.when(use_alt, "alt").otherwise("main").alias("source"), (vm | va).alias("has_valid"), chosen[value].alias(value))


def by_fallback_key(left: DataFrame, right: DataFrame, name: str, key: str, value: str) -> DataFrame:
    """left with right's first value for the sanitised name, else for the name without its functional suffix."""
    lookup = right.groupBy(F.col(key).alias("_key")).agg(F.min(value).alias("_value"))
    first = left.join(lookup, sanitized(F.col(name)) == F.col("_key"), "left").withColumnRenamed("_value", "_direct").drop("_key")
    second = first.join(lookup, sanitized(strip_functional(F.col(name))) == F.col("_key"), "left").drop("_key")
    return second.withColumn(value, F.coalesce("_direct", "_value")).drop("_direct", "_value")


def with_directory(jobs: DataFrame, existing: DataFrame, stored: str = "job_dir", rendered: str = "rendered_dir") -> DataFrame:
    """jobs with ``found_dir``: the stored directory if it exists, else the rendered one, else NULL."""
    dirs = existing.select(F.col("job_dir").alias("_dir")).distinct()
    one = jobs.join(dirs, F.col(stored) == F.col("_dir"), "left").withColumnRenamed("_dir", "_stored")
    return one.join(dirs, F.col(rendered) == F.col("_dir"), "left").withColumn("found_dir", F.coalesce("_stored", "_dir")).drop("_stored", "_dir")


def by_index_suffix(jobs: DataFrame, dirs: DataFrame, index: str = "orig_index") -> DataFrame:
    """jobs with the directory ``job_<index>``, else the only one that ends in ``_<index>`` or ``-<index>``; ``ambiguous`` counts several."""
    d = dirs.select("job_dir", F.regexp_extract("job_dir", r"[_-](\d+)$", 1).try_cast("long").alias("_i")).where("_i is not null")
    exact = F.col("job_dir").rlike(r"(^|/)job_\d+$")
    found = d.groupBy("_i").agg(F.min(F.when(exact, F.col("job_dir"))).alias("_exact"), F.min("job_dir").alias("_any"), F.count(F.lit(1)).alias("_n"))
    out = jobs.join(found, F.col(index) == F.col("_i"), "left")
    many = F.col("_exact").isNull() & (F.coalesce("_n", F.lit(0)) > 1)
    return out.withColumn("found_dir", F.coalesce("_exact", F.when(~many, F.col("_any")))).withColumn("ambiguous", many).drop("_i", "_exact", "_any", "_n")


def dead_workers(tracked: DataFrame, active: DataFrame | None, key: str = "worker_id") -> DataFrame:
    """Tracked rows whose worker isn't active; none where the scheduler could not be asked."""
    return tracked.limit(0) if active is None else tracked.join(active.select(key).distinct(), key, "left_anti")


def listed(df: DataFrame, mapping: DataFrame, key: str, ids: str) -> DataFrame:
    """Rows whose key is among the mapping's id arrays."""
    return df.join(mapping.select(F.explode(ids).alias(key)).distinct(), key, "left_semi")


def bag_difference(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What either side has more of, rows counted."""
    return a.exceptAll(b), b.exceptAll(a)


def geometry_by_multiplicity(geometry: DataFrame, multiplicity: DataFrame, key: str = "molecule") -> DataFrame:
    """A row for each geometry and each of its molecule's multiplicities."""
    return geometry.join(multiplicity, key)


def with_cache(rows: DataFrame, cache: DataFrame, key: str = "job_dir") -> DataFrame:
    """rows (key, mtime) with cached metrics that are no older than their source; ``hit`` tells."""
    c = cache.select(key, F.col("source_mtime").alias("_at"), *[x for x in cache.columns if x not in (key, "source_mtime")])
    fresh = F.coalesce(F.col("_at") >= F.col("mtime"), F.lit(False))
    out = rows.join(c, key, "left").withColumn("hit", fresh)
    return out.withColumns({x: F.when(F.col("hit"), F.col(x)) for x in cache.columns if x not in (key, "source_mtime")}).drop("_at")


def range_pairs(left: DataFrame, right: DataFrame, left_at: str, right_at: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs with right_at within width of left_at: an equi-join on grid cells, the right side in three of them."""
    cell = lambda c: F.floor(F.col(c) / width).cast("long")
    a = left.withColumn("_cell", cell(left_at))
    b = right.withColumn("_cell", F.explode(F.array(cell(right_at) - 1, cell(right_at), cell(right_at) + 1)))
    return a.join(b, [*keys, "_cell"]).where(F.abs(F.col(left_at) - F.col(right_at)) <= width).drop("_cell")


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, value: str) -> DataFrame:
    """left with the value of right's latest row at or before its time: one union and window, no range join."""
    a = left.select(*left.columns, F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_side"))
    b = right.select(*by, at, F.col(value).alias("_v"), F.lit(0).alias("_side"))
    w = Window.partitionBy(*by).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return a.unionByName(b, allowMissingColumns=True).withColumn(f"last_{value}", F.last("_v", ignorenulls=True).over(w)).where("_side = 1").drop("_v", "_side")


def by_formula(jobs: DataFrame, spins: DataFrame, name: str = "name") -> DataFrame:
    """jobs with charge, mult and mults of their sanitised name in a table (formula, charge, mult, mult_list); those it lacks go.

    mult_list is a text such as ``1, 3,5``; where it holds anything but whole numbers, mult stands for it. Of repeated formulas the least row counts.
    """
    parts = F.filter(F.transform(F.split("mult_list", ","), F.trim), lambda x: x != "")
    numbers = F.transform(parts, lambda x: x.try_cast("int"))
    good = F.col("mult_list").isNotNull() & ~F.exists(numbers, lambda x: x.isNull())
    mults = F.when(good, numbers).otherwise(F.array(F.col("mult").cast("int")))
    table = spins.groupBy(F.col("formula").alias("_formula")).agg(F.min(F.struct(F.col("charge"), F.col("mult"), mults.alias("mults"))).alias("_s"))
    return jobs.join(table, sanitized(F.col(name)) == F.col("_formula")).select(*jobs.columns, "_s.charge", "_s.mult", "_s.mults")
