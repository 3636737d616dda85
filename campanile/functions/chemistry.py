"""Elements, spins and estimates as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from campanile.constants import ACTINIDES, CORE_ELECTRONS, ELEMENTS, LIGAND_ORDER, MEMORY_CLOSED, MEMORY_LEAST, MEMORY_OPEN


def literal_map(pairs: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def symbol(number: Column) -> Column:
    """Atomic number to symbol; others as ``Z<number>``."""
    return F.coalesce(F.try_element_at(F.array(*[F.lit(e) for e in ELEMENTS]), F.when(number > 0, number.cast("int"))), F.concat(F.lit("Z"), number.cast("string")))


def atomic_number(symbol_: Column) -> Column:
    return F.try_element_at(literal_map({e: i + 1 for i, e in enumerate(ELEMENTS)}), symbol_)


def first_actinide(elements: Column, actinides: Sequence[str] = ACTINIDES) -> Column:
    return F.try_element_at(F.filter(elements, lambda e: e.isin(*actinides)), F.lit(1))


def leaving_ligand(elements: Column, actinides: Sequence[str] = ACTINIDES) -> Column:
    """The ligand that comes first in the fixed order, else the first element that is no actinide."""
    ordered = F.filter(F.array(*[F.lit(x) for x in LIGAND_ORDER]), lambda x: F.array_contains(elements, x) & ~x.isin(*actinides))
    return F.coalesce(F.try_element_at(ordered, F.lit(1)), F.try_element_at(F.filter(elements, lambda e: ~e.isin(*actinides)), F.lit(1)))


def spin_states(ground: Column, unpaired: Column) -> Column:
    """Sorted multiplicities: the ground state, two above it, and the greatest (unpaired electrons + 1), within the greatest."""
    most = F.greatest(ground, unpaired + 1)
    return F.array_sort(F.array_distinct(F.filter(F.array(ground, most, ground + 2), lambda s: s <= most)))


def spin_ladder(ground: Column) -> Column:
    """ground, ground - 2, ... down to 1 or 2."""
    return F.sequence(ground, F.when(ground % 2 == 1, 1).otherwise(2), F.lit(-2))


def spin_check(spin: Column, electrons: Column | None = None, reasonable: int = 11) -> Column:
    """struct<valid, note>: at least 1; above ``reasonable`` a warning; odd multiplicities need even electrons."""
    parity = (electrons % 2 == spin % 2) if electrons is not None else F.lit(False)
    note = F.when(spin.isNull() | (spin < 1), "spin < 1").when(parity, "parity").when(spin > reasonable, "unusual")
    return F.struct((~F.coalesce(note.isin("spin < 1", "parity"), F.lit(False))).alias("valid"), note.alias("note"))


def conservation(charges: Column, spins: Column, charge: Column, multiplicity: Column, tolerances: tuple[float, float] = (0.01, 0.05)) -> Column:
    """struct<charge_ok, spin_ok>: sums against the expected charge and unpaired electrons; NULL where nothing is expected."""
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return F.struct((F.abs(add(charges) - charge) <= tolerances[0]).alias("charge_ok"), (F.abs(add(spins) - (multiplicity - 1)) <= tolerances[1]).alias("spin_ok"))


def core_electrons(number: Column) -> Column:
    out = F.lit(0)
    for a, b, n in CORE_ELECTRONS:
        out = F.when(number.between(a, b), n).otherwise(out)
    return out


def lumo_index(numbers: Column, charge: Column, all_electron: Sequence[int] = ()) -> Column:
    """(electrons - charge - those of core potentials) div 2."""
    left = F.transform(numbers, lambda z: z - F.when(z.isin(*all_electron), 0).otherwise(core_electrons(z)) if all_electron else z - core_electrons(z))
    return F.floor((F.aggregate(left, F.lit(0), lambda s, x: (s + x).cast("int")) - charge) / 2)


def basis_functions(elements: Column, sizes: Mapping[str, int]) -> Column:
    return F.aggregate(elements, F.lit(0), lambda s, e: (s + F.coalesce(F.try_element_at(literal_map(sizes), e), F.lit(0))).cast("int"))


def memory_mb(n_basis: Column, multiplicity: Column, has_actinides: Column) -> Column:
    """Estimated megabytes, at least 4000."""
    need = lambda ab: F.lit(ab[0]) * F.pow(n_basis.cast("double"), F.lit(1.5)) + F.lit(ab[1])
    open_ = (multiplicity != 1) | has_actinides
    return F.floor(F.greatest(F.when(open_, need(MEMORY_OPEN)).otherwise(need(MEMORY_CLOSED)), F.lit(float(MEMORY_LEAST)))).cast("int")


def bag(values: Column) -> Column:
    """The values as a sorted array: equal bags compare equal."""
    return F.array_sort(F.filter(values, lambda v: v.isNotNull()))


def bags_match(row: Column, file: Column, extra: Sequence[str] = ACTINIDES) -> Column:
    """Whether two element bags are equal, or the second has exactly one more, an extra one."""
    more = F.size(file) == F.size(row) + 1
    without = lambda e: bag(F.concat(row, F.array(F.lit(e)))) == bag(file)
    one_more = F.lit(False)
    for e in extra:
        one_more = one_more | without(e)
    return (bag(row) == bag(file)) | (more & one_more)
