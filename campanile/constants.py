"""Fixed values that results depend on: elements, actinides, units, statuses, file names."""

from __future__ import annotations

#: Element symbols in order of atomic number.
ELEMENTS = (
    "H", "He", "Li", "Be", "B", "C", "N", "O", "F", "Ne", "Na", "Mg", "Al", "Si", "P", "S", "Cl", "Ar",
    "K", "Ca", "Sc", "Ti", "V", "Cr", "Mn", "Fe", "Co", "Ni", "Cu", "Zn", "Ga", "Ge", "As", "Se", "Br", "Kr",
    "Rb", "Sr", "Y", "Zr", "Nb", "Mo", "Tc", "Ru", "Rh", "Pd", "Ag", "Cd", "In", "Sn", "Sb", "Te", "I", "Xe",
    "Cs", "Ba", "La", "Ce", "Pr", "Nd", "Pm", "Sm", "Eu", "Gd", "Tb", "Dy", "Ho", "Er", "Tm", "Yb", "Lu", "Hf",
    "Ta", "W", "Re", "Os", "Ir", "Pt", "Au", "Hg", "Tl", "Pb", "Bi", "Po", "At", "Rn", "Fr", "Ra", "Ac", "Th",
    "Pa", "U", "Np", "Pu", "Am", "Cm", "Bk", "Cf", "Es", "Fm", "Md", "No", "Lr",
)
#: The fifteen actinides.
ACTINIDES = tuple(ELEMENTS[88:103])
#: Ligands in the order in which one is chosen to leave.
LIGAND_ORDER = ("F", "Cl", "Br", "I", "O", "S", "N", "C", "Si", "P", "H")
#: Units. Several roundings of the same constant are in use; each operator names its own.
BOHR_ANGSTROM, BOHR_ANGSTROM_SHORT = 0.529177210903, 0.529177
HARTREE_EV, HARTREE_EV_SHORT, HARTREE_EV_TABLE = 27.211386245988, 27.211386, 27.2114
HARTREE_KCAL = 627.5094740631
#: Job statuses in report order, and the legacy one.
STATUSES = ("to_run", "running", "completed", "failed", "timeout")
LEGACY_READY = "ready"
#: File names that no cleaning ever touches.
ESSENTIAL_FILES = (
    "orca.out", "orca.out.gz", "orca.inp", "orca.inp.gz", "orca.engrad", "orca.engrad.gz",
    "orca.xyz", "orca_metrics.json", "generator_metrics.json", "orca.property.txt", "orca.property.txt.gz", "orca.gbw",
    "orca.densities", "flux_job.flux", "slurm_job.sh", "sella_status.txt", "sella.log", "opt.traj",
    "sella_config.json", "run_sella.py", "results.pkl", "sella_driver.log", ".do_not_rerun.json",
)
#: Patterns of essential and of scratch files.
ATOM_OUTPUT, TRAJECTORY, SCRATCH_DIR = r"^orca_atom\d+\.out$", r"_trj\.xyz$", r"^orca_tmp_[a-zA-Z0-9_]+$"
SCRATCH_TMP = (r"\.tmp$", r"\.tmp\.\d+$", r"^core$", r"^core\.\d+$", r"\.core$")
SCRATCH_BAS = (r"\.bas$", r"\.bas\d+$")
#: Electrons that an effective core potential replaces, by atomic number.
CORE_ELECTRONS = ((37, 54, 28), (55, 57, 46), (58, 71, 28), (72, 88, 60), (89, 102, 78))
#: Memory in MB as a * n**1.5 + b for n basis functions; closed-shell, and everything else.
MEMORY_CLOSED, MEMORY_OPEN, MEMORY_LEAST = (0.0076739752343756434, 361.4745947062764), (0.016460518374501867, -320.38502508802776), 4000
#: Column types that extra job columns may have, and names they may not.
COLUMN_TYPES = ("TEXT", "INTEGER", "REAL", "BLOB", "NUMERIC", "TEXT NOT NULL", "INTEGER NOT NULL", "REAL NOT NULL", "INTEGER PRIMARY KEY", "TEXT UNIQUE")
RESERVED_NAMES = ("SELECT", "DROP", "INSERT", "DELETE", "UPDATE", "TABLE")
#: Suffixes that name a level of theory.
LEVEL_SUFFIXES = ("_TPS", "_TPSSH", "_PBE", "_PBE0", "_B3LYP", "_M06L")
FUNCTIONAL_SUFFIXES = ("_PBE0", "_TPSSH", "_PBE", "_pbe0", "_tpssh", "_pbe")
#: Messages that filters match by their beginnings.
MARKER_MESSAGE, ORPHAN_MESSAGE = "Blocked by .do_not_rerun.json marker", "Orphaned job failed on disk"
#: What ends a calculation's output.
DONE, ABORTED, FAILED_LINE = "ORCA TERMINATED NORMALLY", "aborting the run", "Error"
