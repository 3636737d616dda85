import pytest
from pyspark.sql import functions as F

from campanile.operators import joins, sampling, state
from campanile.operators import jobs as sel
from campanile.operators import reports
from campanile.schemas import JOBS, migrate_jobs, migrate_multi_spin, validate_extra_columns, with_missing_columns

ROWS = [(1, 10, "to_run", None, None), (2, 11, "to_run", 7, None), (3, 12, "running", 1, "w1"), (4, 13, "failed", 4, "w2"), (5, 14, "completed", 30, None), (6, 15, "timeout", 0, None), (7, 16, "running", None, "w9")]


@pytest.fixture
def jobs(spark):
    return with_missing_columns(spark.createDataFrame(ROWS, "id long, orig_index long, status string, fail_count int, worker_id string"), JOBS).select(JOBS.names)


def by_id(df, *columns):
    return {r.id: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_claims_are_disjoint_and_conserve_rows(jobs):
    after, mine = state.claim(jobs, 1, "me")
    again, yours = state.claim(after, 5, "you")
    assert [r.id for r in mine.collect()] == [1] and [r.id for r in yours.collect()] == [2]
    assert again.count() == 7 and by_id(again, "status", "worker_id")[2] == ("running", "you")
    assert state.claim(again, 5)[1].count() == 0
    capped, _ = state.claim(jobs, 5, cap=5, seed=3)
    assert by_id(capped, "status")[2] == "to_run" and by_id(capped, "status")[1] == "running"


def test_resets(jobs):
    out = by_id(state.reset(jobs, ["failed", "timeout"], cap=4), "status", "fail_count", "worker_id")
    assert out[4] == ("failed", 4, "w2") and out[6] == ("to_run", 1, None)
    assert by_id(state.fail_over_cap(jobs, 25), "status")[5] == "failed"


def test_compare_and_set_and_order(jobs):
    out = state.set_many(jobs, [{"ids": [1], "status": "running"}, {"ids": [1, 2], "status": "failed", "only_if": "running", "bump": True}])
    assert by_id(out, "status", "fail_count")[1] == ("failed", 1) and by_id(out, "status")[2] == "to_run"
    assert by_id(state.set_status(jobs, [3], "to_run", worker=None), "worker_id")[3] is None
    assert by_id(state.set_status(jobs, [3], "to_run"), "worker_id")[3] == "w1"


def test_merges(spark, jobs):
    updates = spark.createDataFrame([(1, 5, None), (2, None, "x")], "id long, scf_steps int, error_message string")
    out = by_id(state.sparse_merge(state.sparse_merge(jobs, updates), spark.createDataFrame([(1, None)], "id long, scf_steps int")), "scf_steps", "error_message")
    assert out[1] == (5, None) and out[2] == (None, "x")
    rows = spark.createDataFrame([(5, "failed"), (99, "to_run")], "id long, status string")
    assert by_id(state.upsert(jobs.select("id", "status", "fail_count"), rows, "id"), "status", "fail_count")[5] == ("failed", None)


def test_orphans(spark, jobs):
    codes = spark.createDataFrame([(3, -1, "why")], "id long, code int, reason string")
    active = spark.createDataFrame([("w9",)], "worker_id string")
    out = by_id(state.recover_orphans(jobs, active, codes), "status", "fail_count", "worker_id", "error_message")
    assert out[3] == ("failed", 2, None, "why") and out[7] == ("running", None, "w9", None)
    assert by_id(state.recover_orphans(jobs, active.limit(0), codes), "status")[7] == "to_run"
    assert state.recover_orphans(jobs, None, codes).collect() == jobs.collect()
    silent = spark.createDataFrame([(3, -1, None)], "id long, code int, reason string")
    assert by_id(state.recover_orphans(jobs, active, silent), "error_message")[3] == "Orphaned job failed on disk"


def test_every_change_dates_the_rows_it_changes_and_no_others(spark, jobs):
    now = F.expr("timestamp'2024-05-06 07:08:09'")
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    codes = frame([(1, 1, "r"), (3, -1, "r"), (4, -1, "r"), (7, 5, "r")], "id long, code int, reason string")
    steps = {
        "set_status": (state.set_status(jobs, [1, 4], "failed", now=now), {1, 4}),
        "cas": (state.set_status(jobs, [1, 4], "failed", only_if="to_run", now=now), {1}),
        "claim": (state.claim(jobs, 1, "me", now=now)[0], {1}),
        "reset": (state.reset(jobs, ["failed", "timeout"], 4, now), {6}),
        "cap": (state.fail_over_cap(jobs, 25, now), {5}),
        "merge": (state.sparse_merge(jobs, frame([(1, 5), (2, None)], "id long, scf_steps int"), now=now), {1}),
        "missing": (state.reset_missing(jobs.withColumn("rendered_dir", F.col("id").cast("string")), frame([("4",)], "job_dir string"), now=now), {3, 6, 7}),
        "unlinked": (state.fix_unlinked(jobs, frame([(1, 1, "d")], "id long, code int, found_dir string"), 5, now), {1, 4, 6}),
        "orphans": (state.recover_orphans(jobs, frame([("w9",)], "worker_id string"), codes, now), {3}),
        "reconcile": (state.reconcile(jobs, codes, frame([(5, "x")], "id long, reason string"), now), {1, 3, 5}),
        "metrics": (state.write_metrics(jobs, frame([(1, None, 5), (2, "bad", None), (3, None, None)], "id long, error string, scf_steps int"), now), {1, 2}),
        "outcomes": (state.apply_outcomes(jobs, frame([(3, "completed", False, None, 1.0)], "id long, status string, bump boolean, message string, wall_time double"), now), {3}),
    }
    for name, (after, changed) in steps.items():
        dated = {r.id for r in after.where("updated_at = timestamp'2024-05-06 07:08:09'").collect()}
        assert dated == changed, name
        assert after.where("updated_at is not null").count() == len(changed), name


def test_reconcile_twice_changes_nothing_more(spark, jobs):
    codes = spark.createDataFrame([(1, 1), (3, -2), (4, 0)], "id long, code int")
    markers = spark.createDataFrame([(6, None), (4, " bad ")], "id long, reason string")
    once = state.reconcile(jobs, codes, markers)
    assert sorted(state.changed(jobs, once).collect()) == [(1, "to_run", "completed"), (3, "running", "timeout"), (6, "timeout", "failed")]
    got = by_id(once, "status", "fail_count", "error_message")
    assert got[4] == ("failed", 4, "Blocked by .do_not_rerun.json marker: bad") and got[6] == ("failed", 1, "Blocked by .do_not_rerun.json marker")
    assert sorted(state.reconcile(once, codes, markers).collect(), key=lambda r: r.id) == sorted(once.collect(), key=lambda r: r.id)


def test_selection(jobs):
    assert sel.by_status(jobs, []).count() == 0 and sel.by_status(jobs).count() == 7 and "geometry" not in sel.by_status(jobs).columns
    assert [r.id for r in sel.ready(jobs, 9, cap=5).collect()] == [1]
    assert sel.ready(jobs, 1, seed=5).collect() == sel.ready(jobs, 1, seed=5).collect()
    assert by_id(sel.records(jobs), "fail_count")[1] == 0
    with pytest.raises(Exception, match="unknown status"):
        sel.records(jobs.withColumn("status", F.lit("odd"))).collect()


def test_reports(jobs):
    got = {r.status: (r.n, round(r.pct, 2)) for r in reports.status_summary(jobs).collect()}
    assert got["running"] == (2, 28.57) and got["total"] == (7, 100.0) and sum(n for n, _ in got.values()) == 14
    empty = {r.status: r.n for r in reports.status_summary(jobs.limit(0)).collect()}
    assert len(empty) == 6 and set(empty.values()) == {0}
    assert reports.chronic(jobs).first() == (1, 0) and reports.chronic(jobs.limit(0)).first() == (0, 0)


def test_schemas(spark, jobs):
    assert validate_extra_columns({"a_1": "text"}) == {"a_1": "TEXT"}
    for bad in ({"a;b": "TEXT"}, {"select": "TEXT"}, {"a": "VARCHAR"}):
        with pytest.raises(ValueError):
            validate_extra_columns(bad)
    assert by_id(migrate_jobs(jobs.withColumn("status", F.lit("ready")).drop("optimizer")), "status")[1] == "to_run"
    with pytest.raises(ValueError):
        migrate_multi_spin(jobs, 3)


def test_sampling(spark):
    df = spark.range(1000).withColumnRenamed("id", "orig_index")
    shards = sampling.shard_by_fractions(df, [0.25, 0.5, 0.25], ["a", "b", "c"])
    assert {r.shard: r["count"] for r in shards.groupBy("shard").count().collect()} == {"a": 250, "b": 500, "c": 250} and shards.distinct().count() == 1000
    with pytest.raises(ValueError):
        sampling.shard_by_fractions(df, [0.5, 0.4], ["a", "b"])
    assert sampling.fraction(df, 0.0001, "orig_index").count() == 1
    got = sampling.stratified(spark.range(500), "id < 200", 100, 50).collect()
    assert len(got) == 100 and sum(r.id < 200 for r in got) == 50


def test_sessions_are_runs_of_the_order(spark):
    from campanile.operators import ranges

    for n, k in ((0, 3), (2, 5), (1000, 7), (20_003, 9)):
        df = spark.range(n).select((F.col("id") * 7919 % 20_011).alias("at"))
        got = sorted((r.at, r.session) for r in sampling.sessions(df, k, "at").collect())
        sizes = [n // k + (i < n % k) for i in range(k)]
        assert [s for _, s in got] == [i + 1 for i, size in enumerate(sizes) for _ in range(size)]
    names = spark.createDataFrame([(f"x{i % 500:03}{i}",) for i in range(3000)] + [(None,)], "name string")
    ranked, n = ranges.ranked(names, "name", buckets=16)
    rows = sorted(((r.name is not None, r.name), r["rank"]) for r in ranked.collect())
    assert n == 3001 and [k for _, k in rows] == list(range(1, 3002))


def test_last_by_has_one_row_for_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, None, "c"), (2, 1, "d"), (None, 3, "e")], "k int, o int, v string")
    got = {r.k: r.v for r in joins.last_by(df, "k", "o").collect()}
    assert got.pop(1) in ("a", "b") and got == {2: "d", None: "e"}
    assert joins.last_by(df.repartition(7), "k", "o").where("k = 1").first() == joins.last_by(df, "k", "o").where("k = 1").first()


def test_first_distinct_frames(spark):
    import numpy as np

    from campanile.operators import selection

    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 4, 3))
    frames = [(base[i % 12] + rng.normal(size=(4, 3)) * 0.02).tolist() for i in range(300)] + [base[0][:2].tolist(), None, []]
    rows = [(i % 2, i, f, "x") for i, f in enumerate(frames)]
    df = spark.createDataFrame(rows, "label int, id int, frame array<array<double>>, flat string")
    expected = set()
    for label in (0, 1):
        kept = []
        for _, i, f, _ in sorted(r for r in rows if r[0] == label):
            near = f and any(len(k) == len(f) and np.sqrt(((np.array(k) - np.array(f)) ** 2).sum() / len(f)) < 0.05 for k in kept)
            if not near:
                kept += [f] if f else []
                expected.add(i)
    got = selection.first_distinct(df, "label", "id", "frame", 0.05)
    assert got.columns == df.columns and {r.id for r in got.collect()} == expected and 20 < len(expected) < 250


def test_new_selections(spark, jobs):
    runs = spark.createDataFrame([(1, "spin_1", 1), (2, "spin_1", 0), (3, "spin_3", 1), (4, "spin_1", -1)], "id int, spin string, status int")
    assert [r.id for r in sel.spin_runs(runs).collect()] == [1] and sel.spin_runs(runs, "spin_1", (1, -1)).count() == 2
    done = jobs.withColumn("job_dir", F.concat(F.lit("d"), F.col("id").cast("string")))
    metrics = spark.createDataFrame([("d5", True), ("d5", True), ("d4", True), ("d1", False)], "job_dir string, success boolean")
    assert [r.id for r in sel.verified(done, metrics).collect()] == [5]
    files = spark.createDataFrame([("d5", "a.engrad", 5), ("d5", "a.gbw", 5), ("d5", "a.out", 5), ("d4", "a.engrad", 5)], "job_dir string, rel_path string, size int")
    assert [(r.id, r.orig_index, r.status, r.fail_count, r.seed_dir) for r in sel.seeded_jobs(done, files).collect()] == [(1, 14, "to_run", 0, "d5")]
    assert sel.completed_energies(jobs.withColumn("final_energy", F.lit(-1.0))).count() == 1


def test_as_of_and_range(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 3)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 1.0), ("a", 5, 2.0), ("b", 4, 9.0)], "k string, t int, v double")
    assert {(r.k, r.t): r.last_v for r in joins.as_of(left, right, ["k"], "t", "v").collect()} == {("a", 5): 2.0, ("a", 1): None, ("b", 3): None}
    pairs = joins.range_pairs(left, right.withColumnRenamed("t", "u"), "t", "u", 1.5, ["k"]).collect()
    assert sorted((r.k, r.t, r.u) for r in pairs) == [("a", 1, 2), ("a", 5, 5), ("b", 3, 4)]
