"""Facts from a calculation's whole output text, as columns over (text, mtime)."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from campanile.constants import ABORTED, DONE, FAILED_LINE
from campanile.functions.xyz import tokens
from campanile.schemas import METRICS, POPULATION

#: Of each timing line: what it contains, its name, the place of its number.
TIMES = (("Sum of individual times", "Total", 6), ("Startup", "Startup", 4), ("SCF iterations ", "SCF_iterations", 4), ("Property", "Property", 4), ("Gradient", "Gradient", 5), ("Geometry", "Geometry", 4))


def all_lines(text: Column) -> Column:
    """Lines without the empty piece after a last newline; NULL text gives none."""
    parts = F.split(F.coalesce(text, F.lit("")), "\r?\n")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), 0)


def tail(text: Column, n: int = 10) -> Column:
    """The last n lines, all where there are fewer. The text is searched from its end only."""

    def last(parts: Column) -> Column:
        size = F.size(parts) - F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
        return F.slice(parts, F.greatest(size - n + 1, F.lit(1)), F.least(size, F.lit(n)))

    lines = let(F.split(F.substring_index(F.coalesce(text, F.lit("")), "\n", -(n + 1)), "\n"), last)
    return F.transform(lines, lambda x: F.rtrim(x, F.lit("\r")))


def _has(lines: Column, what: str) -> Column:
    return F.exists(lines, lambda x: x.contains(what))


def _failed(line: Column) -> Column:
    return line.contains(ABORTED) | line.contains(FAILED_LINE)


def stale(mtime: Column, now: Column, hours: float) -> Column:
    return F.unix_timestamp(mtime) < F.unix_timestamp(now) - F.lit(int(hours * 3600))


def termination(text: Column, mtime: Column, now: Column, hours: float = 6, lines: int = 10) -> Column:
    """1 done, -1 failed, -2 stale, 0 running or nothing there. A success line beats any failure line among the last ones."""
    aged = F.when(F.coalesce(stale(mtime, now, hours), F.lit(False)), -2).otherwise(0)
    return let(tail(text, lines), lambda last: F.when(F.size(last) == 0, 0).when(_has(last, DONE), 1).when(F.exists(last, _failed), -1).otherwise(aged))


def failure_reason(text: Column, lines: int = 10) -> Column:
    """The first failure line among the last ones, stripped; NULL on success or without one."""
    first = lambda last: F.regexp_replace(F.try_element_at(F.filter(last, _failed), F.lit(1)), r"^\s+|\s+$", "")
    return let(tail(text, lines), lambda last: F.when(~_has(last, DONE), first(last)))


def numbers_at_end(text: Column, mark: str) -> Column:
    """The last tokens, where they are numbers, of the lines that contain a mark."""
    rest = F.regexp_extract_all(text, F.lit(re.escape(mark) + r"([^\n]*)"), F.lit(1))
    number = lambda x: F.when(x.rlike(r"\s\S+\s*$"), F.element_at(tokens(x), -1).try_cast("double"))
    return F.filter(F.transform(rest, number), lambda v: v.isNotNull())


def last_number(text: Column, mark: str) -> Column:
    return F.try_element_at(numbers_at_end(text, mark), F.lit(-1))


def max_forces(text: Column) -> Column:
    return last_number(text, "MAX gradient")


def final_energy(text: Column) -> Column:
    return last_number(text, "FINAL SINGLE POINT ENERGY")


def processes(text: Column) -> Column:
    return F.try_element_at(numbers_at_end(text, "nprocs"), F.lit(1)).cast("int")


def scf_steps(text: Column) -> Column:
    """The sum over all converged cycles; NULL without any."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"SCF CONVERGED AFTER\s+(\d+)\s+CYCLES"), F.lit(1)), lambda x: x.cast("int"))
    return F.when(F.size(found) > 0, F.aggregate(found, F.lit(0), lambda s, x: (s + x).cast("int")))


def total_energies(text: Column) -> Column:
    """All values of ``Total Energy       :`` lines."""
    found = F.regexp_extract_all(text, F.lit(r"Total Energy       :\s+(\S+)"), F.lit(1))
    return F.filter(F.transform(found, lambda x: x.try_cast("double")), lambda v: v.isNotNull())


def convergence_forces(text: Column) -> Column:
    """array<struct<rms, max>>: the gradients of each geometry convergence block."""
    block = F.regexp_extract_all(text, F.lit(r"(?i)Geometry convergence([\s\S]*?)(?:\n\s*\n|\z)"), F.lit(1))
    value = lambda b, what: F.regexp_extract(b, rf"(?im)^\s*{what} gradient\s+(\S+)", 1).try_cast("double")
    return F.filter(F.transform(block, lambda b: F.struct(value(b, "RMS").alias("rms"), value(b, "MAX").alias("max"))), lambda s: s["rms"].isNotNull() | s["max"].isNotNull())


def last_cycle(text: Column) -> Column:
    """The number of the last geometry optimisation cycle."""
    found = F.regexp_extract_all(text, F.lit(r"GEOMETRY OPTIMIZATION CYCLE\s+(\d+)"), F.lit(1))
    return F.try_element_at(found, F.lit(-1)).cast("int")


def times(text: Column, lines: int = 30) -> Column:
    """map of timing names to seconds, from the last lines of a finished output; empty otherwise."""

    def pair(line: Column) -> Column:
        out = F.lit(None).cast("struct<key:string,value:double>")
        for mark, name, at in reversed(TIMES):
            out = F.when(line.contains(mark), F.struct(F.lit(name).alias("key"), F.try_element_at(tokens(line), F.lit(at)).try_cast("double").alias("value"))).otherwise(out)
        return out

    def newest(found: Column, name: str) -> Column:
        """The last line of a kind wins."""
        of = F.filter(found, lambda p: p["key"] == name)
        return F.struct(F.lit(name).alias("key"), F.try_element_at(of, F.lit(-1))["value"].alias("value"))

    def kept(found: Column) -> Column:
        return F.map_from_entries(F.filter(F.array(*[newest(found, n) for _, n, _ in TIMES]), lambda p: p["value"].isNotNull()))

    none = F.create_map().cast("map<string,double>")
    pairs = lambda last: F.filter(F.transform(last, pair), lambda p: p["value"].isNotNull())
    return let(tail(text, lines), lambda last: F.when(_has(last, DONE), let(pairs(last), kept)).otherwise(none))


#: A population block after its kind: up to the line of sums, a blank line or the end.
_BLOCK = r" ATOMIC CHARGES AND SPIN POPULATIONS[^\n]*\n[^\n]*\n[\s\S]*?(?:\n\s*Sum of|\n[ \t\r]*\n|\z)"


def population(text: Column, kind: str = "MULLIKEN", which: str = "last") -> Column:
    """struct of arrays (elements, indices, charges, spins) of the first or last block with spins; NULL without one."""
    if which not in ("first", "last"):
        raise ValueError(which)
    return _population(F.regexp_extract_all(text, F.lit(kind + _BLOCK), F.lit(0)), which)


def _population(blocks: Column, which: str) -> Column:
    block = F.try_element_at(blocks, F.lit(1 if which == "first" else -1))
    t = F.filter(F.transform(F.split(block, "\r?\n"), tokens), lambda x: F.size(x) >= 4)

    def row(x: Column) -> Column:
        joined = x[1].endswith(":")
        at = lambda i: F.when(joined, F.try_element_at(x, F.lit(i))).otherwise(F.try_element_at(x, F.lit(i + 1))).try_cast("double")
        element = F.when(joined, F.regexp_replace(x[1], ":+$", "")).when(x[2] == ":", x[1])
        return F.struct(x[0].try_cast("int").alias("i"), element.alias("e"), at(3).alias("c"), at(4).alias("s"))

    rows = F.filter(F.transform(t, row), lambda r: r["i"].isNotNull() & r["e"].isNotNull() & r["c"].isNotNull() & r["s"].isNotNull())
    part = lambda f: F.transform(rows, lambda r: r[f])
    return F.when(F.size(rows) > 0, F.struct(part("e").alias("elements"), part("i").alias("indices"), part("c").alias("charges"), part("s").alias("spins"))).cast(POPULATION)


#: What one scan of an output takes out of it: population blocks whole, and the lines of single facts from their marks on.
MARKED = rf"(?:MULLIKEN|LOEWDIN){_BLOCK}|(?:MAX gradient|FINAL SINGLE POINT ENERGY|nprocs|SCF CONVERGED AFTER)[^\n]*"


def marked(text: Column) -> Column:
    """The parts of a text that facts come from, in order, by one scan; a line's part starts at its first mark."""
    return F.regexp_extract_all(text, F.lit(MARKED), F.lit(0))


def metrics(text: Column, mtime: Column, now: Column, hours: float = 6, lines: int = 30) -> Column:
    """All facts of one output from one scan of its text and the lines at its end.

    A line counts for one fact, the first of: force, energy, processes, cycles. Lines in a population block count for none.
    """
    number = lambda x: F.when(x.rlike(r"\s\S+\s*$"), F.element_at(tokens(x), -1).try_cast("double"))
    single = lambda found: F.filter(found, lambda x: ~x.rlike("^(?:MULLIKEN|LOEWDIN) "))

    def numbers(found: Column, mark: str, *but: str) -> Column:
        of = F.filter(single(found), lambda x: reduce(lambda a, b: a & ~x.contains(b), but, x.contains(mark)))
        return F.filter(F.transform(of, number), lambda v: v.isNotNull())

    def cycles(found: Column) -> Column:
        got = F.transform(single(found), lambda x: F.regexp_extract(x, r"SCF CONVERGED AFTER\s+(\d+)\s+CYCLES", 1).try_cast("int"))
        got = F.filter(got, lambda v: v.isNotNull())
        return F.when(F.size(got) > 0, F.aggregate(got, F.lit(0), lambda s, x: (s + x).cast("int")))

    def facts(ended: Column) -> Column:
        code, t, found = ended["code"], ended["times"], ended["found"]
        blocks = lambda kind: F.filter(found, lambda x: x.startswith(kind + " "))
        return F.struct(
            F.try_element_at(numbers(found, "MAX gradient"), F.lit(-1)).alias("max_forces"),
            cycles(found).alias("scf_steps"),
            F.try_element_at(numbers(found, "FINAL SINGLE POINT ENERGY", "MAX gradient"), F.lit(-1)).alias("final_energy"),
            F.try_element_at(numbers(found, "nprocs", "MAX gradient", "FINAL SINGLE POINT ENERGY"), F.lit(1)).cast("int").alias("nprocs"),
            F.try_element_at(t, F.lit("Total")).alias("wall_time"),
            t.alias("time_dict"),
            code.alias("termination_status"),
            (code == 1).alias("success"),
            (code == -2).alias("is_timeout"),
            _population(blocks("MULLIKEN"), "last").alias("mulliken"),
            _population(blocks("LOEWDIN"), "last").alias("loewdin"),
        )

    ended = F.struct(termination(text, mtime, now, hours, lines).alias("code"), times(text, lines).alias("times"), marked(text).alias("found"))
    return let(ended, facts).cast(METRICS)


def gradient_file(text: Column) -> Column:
    """struct<total_energy, gradient, elements, coords, max_force> of a gradient file; max_force is the largest norm."""
    from campanile.functions.geometry import norms, triples

    data = F.filter(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda x: x.rlike(r"\S") & ~x.rlike(r"^\s*#"))
    n = F.coalesce(F.regexp_replace(F.try_element_at(data, F.lit(1)), r"\s", "").try_cast("int"), F.lit(0))
    energy = F.regexp_replace(F.try_element_at(data, F.lit(2)), r"\s", "").try_cast("double")
    gradient = F.transform(F.slice(data, 3, n * 3), lambda x: F.regexp_replace(x, r"\s", "").try_cast("double"))
    rows = F.transform(F.slice(data, n * 3 + 3, n), tokens)
    number = lambda r, i: F.try_element_at(r, F.lit(i)).try_cast("double")
    return F.struct(
        energy.alias("total_energy"),
        gradient.alias("gradient"),
        F.transform(rows, lambda r: number(r, 1).cast("int")).alias("elements"),
        F.transform(rows, lambda r: F.array(number(r, 2), number(r, 3), number(r, 4))).alias("coords"),
        F.array_max(norms(triples(gradient))).alias("max_force"),
    )


def key_values(text: Column) -> Column:
    """map of ``key: value`` lines, stripped; the last of a key wins."""
    pairs = F.transform(F.filter(all_lines(text), lambda x: x.contains(":")), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("v")))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))


def sella_termination(status: Column, log_mtime: Column, dir_mtime: Column, now: Column, hours: float = 6) -> Column:
    """From the status file's text, else the log's age, else the directory's."""
    not_converged = status.contains("NOT_CONVERGED")
    aged = lambda t: F.when(stale(t, now, hours), -2).otherwise(0)
    return (
        F.when(status.contains("CONVERGED") & ~not_converged, 1).when(not_converged | status.contains("ERROR"), -1).when(log_mtime.isNotNull(), aged(log_mtime)).otherwise(aged(dir_mtime))
    )


def sella_steps(text: Column, valid_only: bool = False) -> Column:
    """array<struct<step, energy, force>> of the lines that name the optimiser."""
    rows = F.transform(F.filter(all_lines(text), lambda x: x.contains("Sella:") | x.rlike(r"^\s*Sella\s")), tokens)
    at = lambda r, i: F.try_element_at(r, F.lit(i))
    out = F.transform(rows, lambda r: F.struct(at(r, 2).try_cast("int").alias("step"), at(r, 4).try_cast("double").alias("energy"), at(r, 5).try_cast("double").alias("force")))
    out = F.filter(out, lambda s: s["step"].isNotNull() & s["energy"].isNotNull() & s["force"].isNotNull())
    return F.filter(out, lambda s: (s["energy"] != 0) & ~F.isnan(s["force"])) if valid_only else out


def ase_converged(text: Column, cutoff: float = 0.01) -> Column:
    """Whether the last force of an optimiser log (fourth token of lines that end in a plain number) is below the cutoff."""
    rows = F.filter(F.transform(F.filter(all_lines(text), lambda x: x.rlike(r"\S")), tokens), lambda r: F.element_at(r, -1).rlike(r"^\d+\.?\d*$|^\.\d+$"))
    last = F.try_element_at(F.try_element_at(rows, F.lit(-1)), F.lit(4)).try_cast("double")
    return F.coalesce(last < cutoff, F.lit(False))


def frames(text: Column) -> Column:
    """array<struct<step, energy, force>> of a trajectory: energies in the comment lines, one for each frame."""
    found = F.regexp_extract_all(text, F.lit(r"(?m)^[^\n]*\bE\s+(-?\d+\.\d+)"), F.lit(1))
    return F.transform(found, lambda e, i: F.struct((i + 1).cast("int").alias("step"), e.cast("double").alias("energy"), F.lit(None).cast("double").alias("force")))


def fold_statuses(codes: Column) -> Column:
    """Of several files' codes: all 1 gives 1; any -2 gives -2; any -1 gives -1; else 0."""
    any_ = lambda c: F.array_contains(codes, F.lit(c))
    return F.when((F.size(codes) > 0) & F.forall(codes, lambda c: c == 1), 1).when(any_(-2), -2).when(any_(-1), -1).otherwise(0)


def ended_well(text: Column) -> Column:
    """Whether the line before the last says that all went well; a text of fewer lines didn't."""
    return F.coalesce(F.try_element_at(all_lines(text), F.lit(-2)).contains(DONE), F.lit(False))
