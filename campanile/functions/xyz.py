"""Geometry texts as columns: elements, atoms, and back to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from campanile.schemas import ATOMS


def lines(text: Column) -> Column:
    """Non-blank lines."""
    return F.filter(F.split(text, "\r?\n"), lambda x: x.rlike(r"\S"))


def tokens(line: Column) -> Column:
    return F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")


def body(text: Column, skip_always: bool = False) -> Column:
    """A geometry's atom lines: two header lines are skipped if the first is an integer (or always)."""
    all_ = lines(text)
    rest = F.when(F.size(all_) > 2, F.slice(all_, 3, 1 << 30)).otherwise(F.array().cast("array<string>"))
    if skip_always:
        return rest
    first = F.try_element_at(all_, F.lit(1))
    return F.when(F.regexp_replace(first, r"\s", "").try_cast("int").isNotNull(), rest).otherwise(all_)


def elements(text: Column, skip_always: bool = False) -> Column:
    """Symbols in atom order; NULL text gives NULL, a text without atoms an empty array."""
    return F.transform(body(text, skip_always), lambda x: tokens(x)[0])


def elements_text(text: Column) -> Column:
    return F.array_join(elements(text), ";")


def _atom(t: Column) -> Column:
    number = lambda i: F.try_element_at(t, F.lit(i)).try_cast("double")
    return F.struct(t[0].alias("element"), number(2).alias("x"), number(3).alias("y"), number(4).alias("z"))


def atoms(text: Column, skip_always: bool = False) -> Column:
    """array<struct<element, x, y, z>>; lines with fewer than four tokens are skipped."""
    rows = F.filter(F.transform(body(text, skip_always), tokens), lambda t: F.size(t) >= 4)
    return F.transform(rows, _atom).cast(ATOMS)


def input_atoms(text: Column) -> Column:
    """Atoms of an input deck, between the ``*xyz`` line and ``*``."""
    block = F.regexp_extract(text, r"(?m)^\s*\* ?xyz[^\n]*\n([\s\S]*?)^\s*\*", 1)
    rows = F.filter(F.transform(lines(block), tokens), lambda t: F.size(t) >= 4)
    return F.transform(rows, _atom).cast(ATOMS)


def counted_atoms(text: Column) -> Column:
    """Atoms of a file that starts with their number and a comment; leading blank lines are skipped."""
    trimmed = F.split(F.regexp_replace(text, r"^\s+", ""), "\r?\n")
    count = F.coalesce(F.regexp_replace(trimmed[0], r"\s", "").try_cast("int"), F.lit(0))
    rows = F.transform(F.slice(trimmed, 3, F.greatest(count, F.lit(0))), tokens)
    return F.transform(F.filter(rows, lambda t: F.size(t) >= 4), _atom).cast(ATOMS)


def charge_and_multiplicity(text: Column) -> Column:
    """struct<charge, mult> of the first ``* xyz`` line; NULLs where there is none."""
    found = lambda i: F.regexp_extract(text, r"(?m)^\s*\* ?xyz\S*\s+(-?\d+)\s+(\d+)", i).try_cast("int")
    return F.struct(found(1).alias("charge"), found(2).alias("mult"))


def to_text(atoms_: Column, comment: Column | None = None, header: bool = True) -> Column:
    """A geometry text with ten decimals; with a header its count and comment lines come first."""
    rows = F.array_join(F.transform(atoms_, lambda a: F.format_string("%s %.10f %.10f %.10f", a["element"], a["x"], a["y"], a["z"])), "\n")
    return F.concat_ws("\n", F.size(atoms_).cast("string"), comment if comment is not None else F.lit(""), rows) if header else rows


def aligned_text(atoms_: Column) -> Column:
    return F.array_join(F.transform(atoms_, lambda a: F.format_string("%-2s %15.10f %15.10f %15.10f", a["element"], a["x"], a["y"], a["z"])), "\n")


def symbols_and_positions(atoms_: Column) -> Column:
    """struct<symbols array, positions array of three>."""
    return F.struct(F.transform(atoms_, lambda a: a["element"]).alias("symbols"), F.transform(atoms_, lambda a: F.array(a["x"], a["y"], a["z"])).alias("positions"))
