"""Paths, file names and rendered directory names as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from campanile.constants import ATOM_OUTPUT, ESSENTIAL_FILES, FUNCTIONAL_SUFFIXES, LEVEL_SUFFIXES, SCRATCH_BAS, SCRATCH_DIR, SCRATCH_TMP, TRAJECTORY

PLACEHOLDERS = ("hostname", "orig_index", "id", "formula", "charge", "spin")
DEFAULT_PATTERN = "job_{orig_index}"


def formula(elements: Column) -> Column:
    """Compact formula of ``;``-joined symbols in first-seen order; ``unknown`` without any."""
    symbols = F.filter(F.transform(F.split(F.coalesce(elements, F.lit("")), ";"), lambda s: F.trim(s)), lambda s: s != "")
    count = lambda e: F.size(F.filter(symbols, lambda s: s == e))
    parts = F.transform(F.array_distinct(symbols), lambda e: F.concat(e, F.when(count(e) > 1, count(e).cast("string")).otherwise("")))
    return F.when(F.size(symbols) > 0, F.array_join(parts, "")).otherwise("unknown")


def with_prefix(pattern: str, prefix: str | None) -> str:
    if prefix and not re.fullmatch(r"[A-Za-z0-9._-]+", prefix):
        raise ValueError(f"invalid prefix: {prefix!r}")
    return f"{prefix}_{pattern}" if prefix else pattern


def render(pattern: str, *, orig_index: Column, job_id: Column, hostname: str = "localhost", elements: Column | None = None, charge: Column | None = None, spin: Column | None = None) -> Column:
    """A directory name from a pattern of six placeholders; a stray brace is an error here, not in a task."""
    rest = re.sub("|".join(f"{{{p}}}" for p in PLACEHOLDERS).replace("{", r"\{").replace("}", r"\}"), "", pattern)
    if "{" in rest or "}" in rest:
        raise ValueError(f"stray brace or unknown placeholder: {pattern!r}")
    values = {
        "hostname": F.lit(hostname),
        "orig_index": orig_index.cast("string"),
        "id": job_id.cast("string"),
        "formula": formula(elements if elements is not None else F.lit(None).cast("string")),
        "charge": F.coalesce(charge.cast("string") if charge is not None else F.lit(None), F.lit("0")),
        "spin": F.coalesce(spin.cast("string") if spin is not None else F.lit(None), F.lit("1")),
    }
    pieces = re.split(r"\{(\w+)\}", pattern)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces) if p])


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def path_info(path: Column) -> Column:
    """struct<lot, cat, name, spin> around the right-most part that starts with ``spin``, else from the last four parts."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    back = F.reverse(parts)
    at = F.aggregate(back, F.struct(F.lit(0).alias("i"), F.lit(0).alias("hit")), lambda s, p: F.struct((s["i"] + 1).alias("i"), F.when((s["hit"] == 0) & p.startswith("spin"), s["i"] + 1).otherwise(s["hit"]).alias("hit")))["hit"]
    part = lambda i: F.coalesce(F.try_element_at(back, i), F.lit(""))
    pick = lambda after, plain: F.when(at > 0, part(at + after)).otherwise(part(F.lit(plain)))
    return F.struct(pick(3, 4).alias("lot"), pick(2, 3).alias("cat"), strip_level(pick(1, 1)).alias("name"), pick(0, 2).alias("spin"))


def strip_first_suffix(name: Column, suffixes: tuple[str, ...]) -> Column:
    """The name without the first listed suffix that it ends in."""
    out = name
    for s in reversed(suffixes):
        out = F.when(name.endswith(s), F.substring(name, F.lit(1), F.length(name) - len(s))).otherwise(out)
    return out


def strip_level(name: Column) -> Column:
    return strip_first_suffix(name, LEVEL_SUFFIXES)


def strip_functional(name: Column) -> Column:
    return strip_first_suffix(name, FUNCTIONAL_SUFFIXES)


def sanitized(key: Column) -> Column:
    out = key
    for x in ("-", "ECP", "ZORA"):
        out = F.replace(out, F.lit(x), F.lit(""))
    return out


def swap_root(path: Column, old: str, new: str) -> Column:
    """The first occurrence of the old root replaced."""
    at = F.instr(path, old)
    return F.when(at > 0, F.concat(F.substring(path, F.lit(1), at - 1), F.lit(new), F.substr(path, at + len(old)))).otherwise(path)


def contained(path: Column, root: str) -> Column:
    """Whether a normalised path lies under the root; ``..`` never does."""
    return path.startswith(root.rstrip("/") + "/") & ~path.rlike(r"(^|/)\.\.(/|$)")


def extension(name: Column) -> Column:
    """A file type key: numbered scratch names collapse, ``.x.gz`` stays whole, none is ``(no ext)``."""
    suffix, double = F.regexp_extract(name, r"[^.](\.[^.]+)$", 1), F.regexp_extract(name, r"(?i)[^.](\.[^.]+\.gz)$", 1)
    return (
        F.when(name.rlike(r"\.tmp(\.\d+)?$"), ".tmp")
        .when(name.rlike(r"\.bas\d*$"), ".bas")
        .when(name.rlike(r"^core(\.\d+)?$|\.core$"), "core")
        .when(double != "", F.lower(double))
        .when(suffix != "", F.lower(suffix))
        .otherwise("(no ext)")
    )


def essential(name: Column) -> Column:
    return name.isin(*ESSENTIAL_FILES) | name.rlike(ATOM_OUTPUT) | name.rlike(TRAJECTORY)


def scratch(name: Column, is_dir: Column, categories: frozenset[str] = frozenset({"tmp", "bas"})) -> Column:
    """Whether the active categories clean a name. Essential names win; directories only by their own pattern."""
    out = F.lit(False)
    if "tmp" in categories:
        out = out | F.when(is_dir, name.rlike(SCRATCH_DIR)).otherwise(name.rlike("|".join(SCRATCH_TMP)))
    if "bas" in categories:
        out = out | (~is_dir & name.rlike("|".join(SCRATCH_BAS)))
    return ~essential(name) & out


def file_class(name: Column, in_scratch_dir: Column) -> Column:
    return (
        F.when(in_scratch_dir, "scratch_tmp")
        .when(essential(name), "essential")
        .when(name.rlike("|".join(SCRATCH_TMP)), "scratch_tmp")
        .when(name.rlike("|".join(SCRATCH_BAS)), "scratch_bas")
        .otherwise("other")
    )


def in_scratch_dir(rel_path: Column) -> Column:
    return F.exists(F.slice(F.split(rel_path, "/"), 1, F.greatest(F.size(F.split(rel_path, "/")) - 1, F.lit(0))), lambda p: p.rlike(SCRATCH_DIR))


def real_output(name: Column) -> Column:
    """Whether a file shows that its job has started writing output."""
    return ~name.rlike(ATOM_OUTPUT) & (name.rlike(r"\.out$|\.out\.gz$|\.logs$") | (name.startswith("flux-") & name.endswith("out")) | name.isin("sella_status.txt", "sella.log"))


def of_optimiser(path: Column) -> Column:
    """Whether a path's last part names the optimiser, in any case."""
    return F.lower(F.regexp_extract(path, r"([^/]*)/*$", 1)).contains("sella")
