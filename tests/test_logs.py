import datetime as dt

import pytest
from pyspark.sql import functions as F

from campanile.functions import logs, xyz
from campanile.operators import extraction

NOW = dt.datetime(2024, 1, 2)
OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 23)
#: Lines in the wording of the outputs that the parsers are for.
LOG = """ %pal nprocs 4 end nprocs 4
SCF CONVERGED AFTER  27 CYCLES
MULLIKEN ATOMIC CHARGES AND SPIN POPULATIONS
--------------------------------------------
   0 Am:    0.651357    7.204302
   1 O :   -0.651357   -0.204302
Sum of atomic charges         :    0.0000000
MAX gradient               0.0004      0.0003  NO
MAX gradient    ...  0.0009
FINAL SINGLE POINT ENERGY      -670.5
SCF CONVERGED AFTER  29 CYCLES
MULLIKEN ATOMIC CHARGES AND SPIN POPULATIONS
--------------------------------------------
   0 Am:    0.626082    7.193624
   1 O :   -0.626082   -0.193624
Sum of atomic charges         :    0.0000000
LOEWDIN ATOMIC CHARGES AND SPIN POPULATIONS
-------------------------------------------
   0 Am:    0.875660    7.045929
   1 O :   -0.875660   -0.045929

 GEOMETRY OPTIMIZATION CYCLE   7            *
MAX gradient    ...  0.0001282697
MAX gradient               0.00012      0.0003  YES
FINAL SINGLE POINT ENERGY      -670.534993289315
Total Energy       :         -670.5349 Eh
Sum of individual times          ...       79.073 sec (=   1.318 min)
Startup calculation              ...        4.463 sec (=   0.074 min)   5.6 %
SCF iterations                   ...       66.719 sec (=   1.112 min)  84.4 %
Property calculations            ...        0.269 sec
SCF Gradient evaluation          ...        7.618 sec
Geometry relaxation              ...        0.004 sec
some Error larger than 1e-5
                             ****ORCA TERMINATED NORMALLY****
TOTAL RUN TIME: 0 days
"""


def one(spark, column, text=LOG, mtime=NEW):
    return spark.createDataFrame([(text, mtime)], "text string, mtime timestamp").select(column.alias("x")).first().x


def test_facts(spark):
    t = F.col("text")
    m = one(spark, logs.metrics(t, F.col("mtime"), F.lit(NOW)))
    assert (m.max_forces, m.scf_steps, m.final_energy, m.nprocs, m.wall_time) == (0.0001282697, 56, -670.534993289315, 4, 79.073)
    assert m.time_dict == {"Total": 79.073, "Startup": 4.463, "SCF_iterations": 66.719, "Property": 0.269, "Gradient": 7.618, "Geometry": 0.004}
    assert m.termination_status == 1 and m.success and not m.is_timeout
    assert m.mulliken.charges == [0.626082, -0.626082] and m.mulliken.elements == ["Am", "O"] and m.mulliken.indices == [0, 1]
    assert m.loewdin.spins == [7.045929, -0.045929]
    assert one(spark, logs.population(t, which="first")).charges == [0.651357, -0.651357]
    assert one(spark, logs.last_cycle(t)) == 7 and one(spark, logs.total_energies(t)) == [-670.5349]


def test_one_scan_keeps_the_lines_apart(spark):
    """A line counts for its first fact only, and lines in a population block for none."""
    text = "MAX gradient then nprocs 7\nnprocs 3\nnprocs 5\nMULLIKEN ATOMIC CHARGES AND SPIN POPULATIONS\n---\n 0 U : 1.0 2.0\nMAX gradient 0.9\nSum of it\nSCF CONVERGED AFTER 4 CYCLES\nFINAL SINGLE POINT ENERGY none\n"
    m = one(spark, logs.metrics(F.col("text"), F.col("mtime"), F.lit(NOW)), text)
    assert (m.max_forces, m.nprocs, m.scf_steps, m.final_energy) == (7.0, 3, 4, None) and m.mulliken.charges == [1.0] and m.loewdin is None


def test_no_facts(spark):
    for text in ("", "nothing here", None):
        m = one(spark, logs.metrics(F.col("text"), F.col("mtime"), F.lit(NOW)), text)
        assert m.max_forces is None and m.scf_steps is None and m.mulliken is None and m.time_dict == {}


@pytest.mark.parametrize(
    ("text", "mtime", "code"),
    [
        ("x\nORCA TERMINATED NORMALLY\nError\n", OLD, 1), ("a\n Error 5 \nb", NEW, -1), ("aborting the run\n", OLD, -1), ("plain\n", OLD, -2), ("plain\n", NEW, 0), ("", OLD, 0), (None, OLD, 0),
        ("ORCA TERMINATED NORMALLY\n" + "y\n" * 10, NEW, 0), ("ORCA TERMINATED NORMALLY\n" + "y\n" * 9, NEW, 1),
    ],
)
def test_termination(spark, text, mtime, code):
    assert one(spark, logs.termination(F.col("text"), F.col("mtime"), F.lit(NOW)), text, mtime) == code


def test_tail_modes_and_reason(spark):
    text = "ORCA TERMINATED NORMALLY\n" + "y\n" * 20
    assert one(spark, logs.termination(F.col("text"), F.col("mtime"), F.lit(NOW), 6, 30), text) == 1
    assert one(spark, logs.failure_reason(F.col("text")), "a\n  Error 5 \naborting the run") == "Error 5"
    assert one(spark, logs.failure_reason(F.col("text")), "Error\nORCA TERMINATED NORMALLY") is None


ENGRAD = "#\n# Number of atoms\n#\n 2\n#\n# energy\n#\n  -10.5\n#\n# gradient\n#\n 0.0\n 3.0\n 4.0\n 1.0\n 0.0\n 0.0\n#\n# atoms\n#\n  95 0.0 0.0 0.0\n   8 0.0 0.0 3.5\n"


def test_gradient_file(spark):
    g = one(spark, logs.gradient_file(F.col("text")), ENGRAD)
    assert (g.total_energy, g.max_force, g.elements) == (-10.5, 5.0, [95, 8]) and g.coords[1] == [0.0, 0.0, 3.5] and len(g.gradient) == 6


def test_status_file_and_optimiser_log(spark):
    kv = one(spark, logs.key_values(F.col("text")), "status: CONVERGED\nsteps: 12\nfinal_fmax: 0.01\nmessage: a: b\n")
    assert kv == {"status": "CONVERGED", "steps": "12", "final_fmax": "0.01", "message": "a: b"}
    none = F.lit(None).cast("timestamp")
    code = lambda text, log=none: one(spark, logs.sella_termination(F.col("text"), log, F.col("mtime"), F.lit(NOW)), text, OLD)
    assert [code("status: CONVERGED"), code("NOT_CONVERGED"), code("ERROR"), code(None), code(None, F.lit(NEW))] == [1, -1, -1, -2, 0]
    steps = one(spark, logs.sella_steps(F.col("text")), "  Step Time\nSella:  1 10:00:00 -5.5 0.20 x\nSella:  2 10:01:00 -5.6 0.01 x\n")
    assert [(s.step, s.energy, s.force) for s in steps] == [(1, -5.5, 0.2), (2, -5.6, 0.01)]


def test_fold(spark):
    got = [one(spark, logs.fold_statuses(F.array(*map(F.lit, c)))) for c in ([1, 1], [1, -2, -1], [1, -1], [1, 0])]
    assert got == [1, -2, -1, 0]


@pytest.mark.parametrize(("text", "symbols"), [("O 0 0 0\nH 1 0 0", ["O", "H"]), ("2\ncomment\nO 0 0 0\n\nH 1 0 0\n", ["O", "H"]), ("2\n", []), ("", []), (None, None), ("2\nc", [])])
def test_xyz(spark, text, symbols):
    assert one(spark, xyz.elements(F.col("text")), text) == symbols


def test_atoms_round_trip(spark):
    atoms = one(spark, xyz.atoms(F.col("text")), "2\nc\n U 0.1 0.2 0.3\nO 1 2 x\nshort 1\n")
    assert [(a.element, a.x, a.z) for a in atoms] == [("U", 0.1, 0.3), ("O", 1.0, None)]
    assert one(spark, xyz.to_text(xyz.atoms(F.col("text")), F.lit("hi")), "U 0.1 0.2 0.3") == "1\nhi\nU 0.1000000000 0.2000000000 0.3000000000"
    inp = "! opt\n* xyz -1 3\nU 0 0 0\nO 0 0 1.8\n*\n"
    assert one(spark, xyz.charge_and_multiplicity(F.col("text")), inp) == (-1, 3)
    assert [a.element for a in one(spark, xyz.input_atoms(F.col("text")), inp)] == ["U", "O"]
    assert one(spark, xyz.charge_and_multiplicity(F.col("text")), "* xyzfile 0 1 f.xyz\n") == (0, 1)


def test_primary_logs(spark):
    rows = [("a", "x.out", OLD), ("a", "run.logs", OLD), ("b", "orca_atom95.out", NEW), ("b", "z.out", OLD), ("b", "y.out", NEW), ("c", "orca_atom1.out", NEW), ("d", "q.out.gz", NEW), ("d", "flux-1.out", NEW)]
    df = spark.createDataFrame(rows, "job_dir string, name string, mtime timestamp")
    assert {r.job_dir: r.name for r in extraction.primary_logs(df).collect()} == {"a": "run.logs", "b": "y.out", "d": "flux-1.out"}
    assert {r.job_dir: r.name for r in extraction.termination_logs(df).collect()} == {"a": "x.out", "b": "y.out", "d": "flux-1.out"}


def test_job_metrics_and_baselines(spark):
    texts = lambda t: spark.createDataFrame([("j", t, NEW)], "job_dir string, text string, mtime timestamp")
    none = texts("x").limit(0)
    got = extraction.job_metrics(texts(LOG), texts("* xyz 0 8\nAm 0 0 0\nO 0 0 1.8\n*"), texts(ENGRAD), none, F.lit(NOW)).first()
    assert (got.charge, got.mult, got.max_forces_source, got.success) == (0, 8, "log", True) and got.mulliken_check == (True, True)
    got = extraction.job_metrics(texts("plain"), none, texts(ENGRAD), texts("status: CONVERGED\nsteps: 3\nfinal_fmax: 0.02"), F.lit(NOW)).first()
    assert (got.max_forces, got.max_forces_source, got.success, got.sella_steps) == (0.02, "sella", True, 3)
    jobs = spark.createDataFrame([(1, "j", True, 2), (2, None, False, 2), (3, "k", False, 2), (4, "l", True, 2), (5, "j", True, 3)], "id long, job_dir string, dir_exists boolean, natoms int")
    rows = {r.id: r for r in extraction.force_baselines(jobs, texts(ENGRAD)).collect()}
    assert [rows[i].parse_note for i in range(1, 6)] == [None, "no_job_dir", "dir_not_found", "no_engrad", "atom_count_mismatch"]
    assert (rows[1].all_max, rows[1].actinide_mean, rows[1].other_max, rows[1].neighbor_max) == (5.0, 5.0, 1.0, 1.0)


def test_dataset_and_summary(spark):
    schema = "job_dir string, out_text string, code int, engrad_text string, inp_text string"
    inp = "* xyz 0 1\nU 0 0 0\n*"
    df = spark.createDataFrame([("a", "t", 1, ENGRAD, inp), ("b", None, 1, ENGRAD, inp), ("c", "t", 0, ENGRAD, inp), ("d", "t", 1, None, inp), ("e", "t", 1, ENGRAD, "none")], schema)
    rows = {r.job_dir: r for r in extraction.dataset_rows(df).collect()}
    assert [rows[k].failure for k in "abcde"] == [None, "no_out", "not_terminated", "no_engrad", "inp_parse_failed"]
    assert abs(rows["a"].forces[1] + 3 * 27.211386245988 / 0.529177210903) < 1e-9
    runs = spark.createDataFrame([("x", 1, [(1, -1.0, 0.0), (2, -1.5, 0.0)]), ("y", 1, [(1, -1.0, 0.0)]), ("z", 1, None)], "name string, status int, frames array<struct<step:int,energy:double,force:double>>")
    assert {r.name: (r.status, r.delta_energy) for r in extraction.run_summary(runs).collect()} == {"x": (1, -0.5), "y": (0, 0.0), "z": (0, None)}
