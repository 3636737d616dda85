import datetime as dt

import pytest
from pyspark.sql import functions as F

from campanile.operators import hooks, inventory, state, validation


def ends_with_one(path):
    if path.endswith("x"):
        raise OSError("gone")
    return 1 if path.endswith("1") else -1


def needs_charge(path, row):
    if row["charge"] is None or row["charge"] != row["charge"]:
        raise ValueError("no charge")


def test_hooks(spark):
    dirs = spark.createDataFrame([(1, "a1", 0), (2, "b", None), (3, "x", 2)], "id long, job_dir string, charge int")
    got = {r.job_dir: (r.code, r.error) for r in hooks.check_directories(dirs, ends_with_one).collect()}
    assert got == {"a1": (1, None), "b": (-1, None), "x": (0, "OSError: gone")}
    assert {r.id: r.ok for r in hooks.set_up(dirs, needs_charge).collect()} == {1: True, 2: False, 3: True}
    for bad in (lambda p: 1, 5):
        with pytest.raises(ValueError):
            hooks.check_directories(dirs, bad)
    e = hooks.Extractors()
    e.register("n", F.length)
    with pytest.raises(ValueError):
        e.register("n", F.length)
    assert [r.n for r in e.apply(dirs, "job_dir").orderBy("id").collect()] == [2, 1, 1]


def test_validation(spark):
    deck = "* xyz 0 1\nO 0 0 0\nH 1 0 0\n*\n"
    jobs = spark.createDataFrame([(i, f"d{i}", "H; O", "to_run") for i in range(30)] + [(99, None, "H", "failed")], "id long, job_dir string, elements string, status string")
    inputs = spark.createDataFrame([(f"d{i}", deck) for i in range(30)], "job_dir string, text string")
    gate, reasons = validation.validate(jobs, inputs)
    assert gate.first().passed and {r.verdict: r.n for r in reasons.collect()} == {"match": 30}
    gate, _ = validation.validate(jobs, inputs.withColumn("text", F.regexp_replace("text", "H 1", "F 1")))
    assert not gate.first().passed
    gate, _ = validation.validate(jobs, inputs.limit(5))
    assert not gate.first().passed and not validation.validate(jobs.limit(0), inputs)[0].first().passed


def test_geometry_fallback(spark):
    rows = spark.createDataFrame([("[[0,0,0]]", "[92]", None), (None, None, "1\nc\nO 1 2 3\n"), ("[[0,0,0]]", '["U"]', "x"), ("[]", "[]", "1\n\nF 0 0 1")], "final_coords string, final_elements string, xyz_text string")
    assert [r.atoms[0].element for r in validation.geometry_or_file(rows).collect()] == ["U", "O", "U", "F"]


def test_multi_spin_rows(spark):
    now = dt.datetime(2024, 1, 2)
    dirs = spark.createDataFrame([("/r/lot/cat/M_PBE/spin_1",), ("/r/lot/cat/N/spin_3",)], "path string")
    out = spark.createDataFrame([("/r/lot/cat/M_PBE/spin_1", "FINAL SINGLE POINT ENERGY -5.5\nORCA TERMINATED NORMALLY", now)], "job_dir string, text string, mtime timestamp")
    grad = spark.createDataFrame([("/r/lot/cat/N/spin_3", "#\n1\n#\n-7.0\n#\n3.0\n0.0\n4.0\n#\n8 0 0 0\n")], "job_dir string, text string")
    rows = {r.name: (r.lot, r.spin, r.status, r.final_energy, r.max_force) for r in validation.multi_spin_rows(dirs, out, grad, F.lit(now)).collect()}
    assert rows == {"M": ("lot", "spin_1", 1, -5.5, None), "N": ("lot", "spin_3", 0, -7.0, 5.0)}
    assert validation.refined(out).first().moved is False and validation.failure_facts(out).first().failure_reason is None


def test_purge_and_totals(spark):
    jobs = spark.createDataFrame([(1, "failed", "a"), (2, "failed", "b"), (3, "timeout", "c"), (4, "running", "d"), (5, "completed", "e"), (6, "to_run", "f")], "id long, status string, job_dir string")
    disk = spark.createDataFrame([("a", -1, -1), ("b", 1, 1), ("c", -1, -1), ("d", 0, 0), ("e", 1, 1), ("f", -2, -2)], "job_dir string, code int, still_code int")
    sizes = spark.createDataFrame([("a", 10), ("f", 5)], "job_dir string, bytes long")
    plan = {r.id: (r.action, r.bytes) for r in inventory.purge_plan(jobs, disk, sizes).collect()}
    assert plan == {1: ("purged", 10), 2: ("protected", 0), 3: ("looks_failed", 0), 4: ("skipped", 0), 6: ("purged", 5)}
    raced = inventory.purge_plan(jobs, disk.withColumn("still_code", F.lit(0)), sizes).where("id = 1").first()
    assert raced.action == "skipped"


def test_missing_directories(spark):
    jobs = spark.createDataFrame([(1, "running", None, "w", "d1"), (2, "failed", 3, None, "d2"), (3, "to_run", None, None, "d3")], "id long, status string, fail_count int, worker_id string, rendered_dir string")
    out = {r.id: (r.status, r.fail_count, r.worker_id) for r in state.reset_missing(jobs, spark.createDataFrame([("d2",)], "job_dir string")).collect()}
    assert out == {1: ("to_run", 1, None), 2: ("failed", 3, None), 3: ("to_run", None, None)}
