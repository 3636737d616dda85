"""Numbers over arrays of three-vectors: norms, distances, neighbours, without a shuffle or a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    return F.when(F.size(a) > 0, total(a) / F.size(a))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def distance(a: Column, b: Column) -> Column:
    return norm(F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double")))


def triples(flat: Column) -> Column:
    """A flat array cut into three-vectors; an incomplete one at the end is dropped."""
    n = F.floor(F.size(flat) / 3).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(flat, i * 3 + 1, 3))).otherwise(F.array().cast("array<array<double>>"))


def norms(vectors: Column) -> Column:
    return F.transform(vectors, norm)


def rms_components(vectors: Column) -> Column:
    """sqrt of the mean over all components."""
    return F.sqrt(mean(F.transform(F.flatten(vectors), lambda x: x * x)))


def rms_norms(vectors: Column) -> Column:
    """sqrt of the mean squared norm: it divides by vectors, not components."""
    return F.sqrt(mean(F.transform(vectors, lambda v: norm(v) * norm(v))))


def rmsd(a: Column, b: Column, labels_a: Column | None = None, labels_b: Column | None = None) -> Column:
    """Ordered root mean square distance; NULL where sizes or labels differ."""
    same = F.size(a) == F.size(b)
    if labels_a is not None and labels_b is not None:
        same = same & (labels_a == labels_b)
    return F.when(same & (F.size(a) > 0), F.sqrt(mean(F.zip_with(a, b, lambda x, y: distance(x, y) * distance(x, y)))))


def pick(values: Column, labels: Column, wanted: Sequence[str], there: bool = True) -> Column:
    """The values whose label is (or isn't) among the wanted ones."""
    pairs = F.arrays_zip(values.alias("v"), labels.alias("l"))
    hit = lambda p: p["l"].isin(*wanted) if there else ~p["l"].isin(*wanted)
    return F.transform(F.filter(pairs, hit), lambda p: p["v"])


def force_summary(forces: Column) -> Column:
    """struct<max, mean, n> of norms; NULLs for none."""
    return F.struct(F.array_max(forces).alias("max"), mean(forces).alias("mean"), F.size(forces).alias("n"))


def neighbours(elements: Column, coords: Column, centres: Sequence[str], cutoff: float) -> Column:
    """array of struct<centre, element, nearest, count>: of each centre atom its other atoms within the cutoff.

    Atoms at the same place (closer than 1e-8) are no neighbours; without any the nearest is NULL and the count 0.
    """
    all_ = F.arrays_zip(elements.alias("e"), coords.alias("c"))

    def around(a: Column) -> Column:
        near = F.filter(F.transform(all_, lambda b: F.struct(distance(a["c"], b["c"]).alias("d"), b["e"].alias("e"))), lambda x: (x["d"] > 1e-8) & (x["d"] <= cutoff))
        first = F.array_min(near)
        return F.struct(a["e"].alias("centre"), first["e"].alias("element"), first["d"].alias("nearest"), F.size(near).alias("count"))

    return F.transform(F.filter(all_, lambda a: a["e"].isin(*centres)), around)


def near_any(elements: Column, coords: Column, centres: Sequence[str], cutoff: float) -> Column:
    """Of each atom whether it is no centre itself and within the cutoff of one."""
    all_ = F.arrays_zip(elements.alias("e"), coords.alias("c"))
    hubs = F.filter(all_, lambda a: a["e"].isin(*centres))
    return F.transform(all_, lambda a: ~a["e"].isin(*centres) & F.exists(hubs, lambda h: distance(a["c"], h["c"]) <= cutoff))


def centre_distance(elements: Column, coords: Column, centres: Sequence[str], index: Column) -> Column:
    """Distance from the first centre atom to the atom at a zero-based index."""
    all_ = F.arrays_zip(elements.alias("e"), coords.alias("c"))
    hub = F.try_element_at(F.filter(all_, lambda a: a["e"].isin(*centres)), F.lit(1))
    return distance(hub["c"], F.try_element_at(coords, (index + 1).cast("int")))


def keep_first_distinct(frames: Column, threshold: float = 0.02) -> Column:
    """Greedy selection in order: a frame goes if one that stays has its shape and lies within the threshold (RMSD)."""
    return F.aggregate(
        frames,
        F.filter(frames, lambda f: F.lit(False)),
        lambda kept, f: F.when(F.exists(kept, lambda k: F.coalesce(rmsd(k, f) < threshold, F.lit(False))), kept).otherwise(F.concat(kept, F.array(f))),
    )
