"""Formatting, JSON and clock helpers as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def size_text(size: Column) -> Column:
    """Bytes as B, KB, MB or GB with one decimal, by 1024."""
    unit = lambda k, name: F.format_string(f"%.1f {name}", size.cast("double") / F.lit(float(1024**k)))
    return F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B"))).when(size < 1024**2, unit(1, "KB")).when(size < 1024**3, unit(2, "MB")).otherwise(unit(3, "GB"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; 0 of nothing."""
    return F.when(whole > 0, part.cast("double") * 100 / whole).otherwise(F.lit(0.0))


def truncated(value: Column, most: int = 30, null: str = "N/A") -> Column:
    """At most so many characters, the last three dots where something is cut."""
    return F.when(value.isNull(), null).when(F.length(value) > most, F.concat(F.left(value, F.lit(most - 3)), F.lit("..."))).otherwise(value)


def walltime(hours: Column) -> Column:
    seconds = F.round(hours.cast("double") * 3600).cast("long")
    return F.format_string("%02d:%02d:%02d", F.expr("1") * F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)


def number_list(text: Column) -> Column:
    """A JSON list as array<double>; NULL or '' is empty, anything but numbers gives NULL."""
    parsed = F.from_json(text, "array<string>")
    numbers = F.transform(parsed, lambda x: x.try_cast("double"))
    bad = parsed.isNull() | F.exists(F.coalesce(numbers, F.array(F.lit(None).cast("double"))), lambda v: v.isNull())
    return F.when(text.isNull() | (F.trim(text) == ""), F.array().cast("array<double>")).when(~bad, numbers)


def number_list_note(text: Column, length: Column | None = None) -> Column:
    """NULL for a good list, else what is wrong with it."""
    got = number_list(text)
    return F.when(got.isNull(), "not a list of numbers").when((F.size(got) != length) & (F.size(got) > 0) if length is not None else F.lit(False), "unexpected length")


def finite(value: Column) -> Column:
    """NaN and infinities as NULL."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def finite_list(values: Column) -> Column:
    return F.transform(values, finite)


def mapped(value: Column, table: Mapping, default: object = None) -> Column:
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(value == F.lit(k), F.lit(v)).otherwise(out)
    return out


def marker_message(prefix: str, reason: Column, most: int = 200) -> Column:
    clean = F.nullif(F.trim(reason), F.lit(""))
    return F.when(clean.isNull(), prefix).otherwise(F.concat(F.lit(f"{prefix}: "), F.left(clean, F.lit(most))))


def by_boundaries(value: Column, boundaries: Sequence[int], names: Sequence[str]) -> Column:
    """Shard by ascending boundaries: below the first, between two, else the last; NULL counts as 0."""
    out = F.lit(names[len(boundaries)])
    for b, n in reversed(list(zip(boundaries, names, strict=False))):
        out = F.when(F.coalesce(value, F.lit(0)) < b, n).otherwise(out)
    return out


def by_values(value: Column, groups: Sequence[Sequence], names: Sequence[str]) -> Column:
    """Shard by lists of values, compared as text; a value listed twice goes to the later shard, others to the last."""
    table = {str(v): n for vs, n in zip(groups, names, strict=False) for v in vs}
    return mapped(value.cast("string"), table, names[-1])
