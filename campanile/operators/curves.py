"""Energy curves: distances, medians, relative energies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campanile.constants import ACTINIDES, HARTREE_KCAL
from campanile.functions import geometry, xyz


def relative_energy(df: DataFrame, energy: str, by: Sequence[str], factor: float = HARTREE_KCAL) -> DataFrame:
    return df.withColumn("relative", (F.col(energy) - F.min(energy).over(Window.partitionBy(*by))) * factor)


def near_median(df: DataFrame, energy: str, by: Sequence[str], within: float = 1.0, exact: bool = True) -> DataFrame:
    """Negative energies within so much of their group's median. The medians are one aggregate, joined back.

    An exact median keeps a group's distinct values in memory; for groups of billions take ``exact=False`` (a sketch).
    """
    below = df.where(F.col(energy) < 0)
    medians = below.groupBy(*by).agg((F.median(energy) if exact else F.percentile_approx(energy, 0.5, 10_000)).alias("_median"))
    return below.join(medians, list(by)).where(F.abs(F.col(energy) - F.col("_median")) <= within).drop("_median")


def equilibrium_distance(df: DataFrame, distance: str = "distance", margin: float = 0.2) -> DataFrame:
    return df.agg((F.min(distance) + margin).alias("equilibrium"))


def leaving_atom(df: DataFrame, by: Sequence[str], geometry_col: str = "geometry") -> DataFrame:
    """Of each group the zero-based index of the atom whose distance from the first actinide varies most (ties: the lowest)."""
    a = xyz.atoms(F.col(geometry_col), True)
    rows = df.withColumn("_a", a).withColumn("_s", xyz.symbols_and_positions(F.col("_a")))
    long = rows.select(*by, "_s", F.posexplode("_s.symbols").alias("i", "e")).where(~F.col("e").isin(*ACTINIDES))
    d = long.withColumn("d", geometry.centre_distance(F.col("_s.symbols"), F.col("_s.positions"), ACTINIDES, F.col("i")))
    spread = d.groupBy(*by, "i").agg(F.var_pop("d").alias("v"))
    return spread.groupBy(*by).agg(F.max_by("i", F.struct("v", (-F.col("i")).alias("first"))).alias("index"))


def with_distance(df: DataFrame, by: Sequence[str], geometry_col: str = "geometry") -> DataFrame:
    """df with the distance of its group's leaving atom from the first actinide."""
    s = xyz.symbols_and_positions(xyz.atoms(F.col(geometry_col), True))
    out = df.join(leaving_atom(df, by, geometry_col), list(by))
    return out.withColumn("distance", geometry.centre_distance(s["symbols"], s["positions"], ACTINIDES, F.col("index"))).drop("index")


def dissociation(df: DataFrame, by: Sequence[str], spin: str = "spin", energy: str = "final_energy") -> DataFrame:
    """The sweep's table: distances, energies near their spin's median, relative to their minimum."""
    return relative_energy(near_median(with_distance(df, by), energy, [*by, spin]), energy, [*by, spin])
