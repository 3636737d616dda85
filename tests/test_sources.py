import datetime as dt
import gzip
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from campanile import sinks
from campanile.functions import chemistry, geometry, paths, values
from campanile.operators import curves, inventory, joins
from campanile.sources import files, tables, texts
from campanile.streaming import events

XYZ = '"3\nc\nO 0 0 0\nH 0.7 0.5 0\nH -0.7 0.5 0"'


def test_csv_to_jobs(spark, tmp_path):
    (tmp_path / "s.csv").write_text(f"aligned_csd_core,charge,uhf,other_col\n{XYZ},0,1,a\n,1,1,b\n\"U 0 0 0\",,,c\n{XYZ},2,0,d\n")
    raw = tables.read_structures(spark, str(tmp_path / "s.csv"))
    jobs = tables.structures(raw, extra={"other_col": "TEXT"}).orderBy("id").collect()
    assert [(r.id, r.orig_index, r.elements, r.natoms, r.charge, r.spin, r.status, r.other_col) for r in jobs] == [
        (1, 0, "O;H;H", 3, 0, 1, "to_run", "a"),
        (2, 2, "U", 1, None, None, "to_run", "c"),
    ]
    with pytest.raises(ValueError):
        tables.structures(raw, extra={"nope": "TEXT"})
    rows = {r.orig_index: (r.chunk_file, r.index_in_chunk) for r in sinks.manifest(raw, "aligned_csd_core", 2).collect()}
    assert rows == {0: ("chunk_0.xyz", 0), 2: ("chunk_1.xyz", 0), 3: ("chunk_1.xyz", 1)}
    sinks.write_chunks(raw, str(tmp_path / "out"), "aligned_csd_core", 2)
    assert spark.read.text(str(tmp_path / "out/chunks")).where("chunk = 1").count() == 2 + 5 + 1


def test_row_numbers_follow_the_file(spark):
    df = tables.with_row_number(spark.range(0, 1000, 1, 7))
    assert all(r.id == r.orig_index for r in df.collect())


def test_texts(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.out").write_bytes(b"one\nbad \xff byte\n")
    whole = gzip.compress(b"line\n" * 1000)
    (tmp_path / "a/y.out.gz").write_bytes(whole)
    (tmp_path / "a/z.out.gz").write_bytes(whole[: len(whole) // 2])
    got = texts.read_texts(spark, str(tmp_path), "*.out").collect()
    assert [(os.path.basename(r.job_dir), r.name, r.text) for r in got] == [("a", "x.out", "one\nbad \ufffd byte\n")]
    zipped = {r.name: (r.whole, len(r.text)) for r in texts.read_zipped(spark, str(tmp_path)).collect()}
    assert zipped["y.out.gz"] == (True, 5000) and zipped["z.out.gz"][0] is False


def test_zipped_members_and_damage(spark, tmp_path):
    lines = "".join(f"line {i} {i * i}\n" for i in range(20_000)).encode()
    one, two = gzip.compress(lines), gzip.compress(b"second\n")
    broken = bytearray(one)
    broken[len(one) // 2] ^= 0xFF
    cases = {"two": one + two, "padded": one + b"\0" * 700 + two + b"\0" * 9, "cut": one + two[:12], "rest": one + b"garbage", "broken": bytes(broken), "none": gzip.compress(b"")}
    for name, raw in cases.items():
        (tmp_path / f"{name}.gz").write_bytes(raw)
    got = {r.name[:-3]: (r.text.encode(), r.whole) for r in texts.read_zipped(spark, str(tmp_path)).collect()}
    assert got["two"] == got["padded"] == (lines + b"second\n", True)
    assert got["cut"][0].startswith(lines) and got["cut"][1] is False
    assert got["rest"] == (lines, False) and got["none"] == (b"", True)
    text, whole = got["broken"]
    assert whole is False and len(text) > 1000 and text[:1000] == lines[:1000]


def test_blocks(spark):
    df = lambda t: spark.createDataFrame([("p", t)], "path string, text string")
    got = texts.geometry_blocks(df("Geometry for A\nU 0 0 0\nO 0 0 1.8\n\nGeometry for B:\nF 1 2 3\n")).collect()
    assert {r.molecule: [a.element for a in r.atoms] for r in got} == {"A": ["U", "O"], "B": ["F"]}
    got = texts.multiplicities(df("A, charge=0, mult=3\nA, charge=0, mult=1\nB, charge=-1, mult=2")).collect()
    assert {r.molecule: (r.charge, r.mults) for r in got} == {"A": (0, [3, 1]), "B": (-1, [2])}
    got = texts.continued(df("A, 0.5, 1 or\n3\nB, 1.0, 2")).collect()
    assert {r.molecule: (r.zpve, r.multiplicity) for r in got} == {"A": (0.5, "1 or3"), "B": (1.0, "2")}
    got = texts.reset_list(df("# one (2 jobs)\njob_42, job_7,\n# two\njob_1")).collect()
    assert [(r.section, r.job) for r in got] == [("one", "job_42"), ("one", "job_7"), ("two", "job_1")]


def test_listing_and_inventory(spark, tmp_path):
    sizes = {"job_0/orca.out": 1000, "job_0/orca.inp": 200, "job_0/orca.tmp": 500, "job_0/orca_tmp_abc123/scratch.0": 4000, "job_0/orca_tmp_abc123/scratch.1": 1000, "job_1/orca.out": 800, "job_1/orca.bas1": 300, "job_1/data.weird": 50}
    for name, n in sizes.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * n)
    (tmp_path / "job_2").mkdir()
    (tmp_path / "job_1/link").symlink_to(tmp_path / "job_0/orca.out")
    listing = files.read_listing(spark, str(tmp_path))
    rows = [(os.path.basename(r.job_dir), r.n_files, r.bytes, r.essential_bytes, r.scratch_tmp_bytes, r.nested_bytes) for r in inventory.per_job(listing).collect()]
    assert rows == [("job_0", 5, 6700, 1200, 5500, 5000), ("job_1", 4, 1150, 800, 0, 0)]
    assert files.read_listing(spark, str(tmp_path), depth=1).count() == 7
    assert files.read_listing(spark, str(tmp_path), dirs=True).count() == 4
    plan = {r.path: (r.is_dir, r.bytes) for r in inventory.scratch_plan(listing).collect()}
    assert plan == {"orca.tmp": (False, 500), "orca_tmp_abc123": (True, 5000), "orca.bas1": (False, 300)}
    assert files.read_spark_listing(spark, str(tmp_path)).where("rel_path = 'orca.out'").count() == 2
    assert {r.rel_path for r in inventory.largest_files(listing, 2).collect()} == {"orca_tmp_abc123/scratch.0", "orca.out"}


def test_sqlite(spark, tmp_path):
    for k in (2, 1):
        with sqlite3.connect(tmp_path / f"c_{k}.db") as con:
            con.execute("CREATE TABLE structures (id INTEGER PRIMARY KEY, status TEXT, final_energy REAL)")
            con.executemany("INSERT INTO structures VALUES (?, ?, ?)", [(i, "failed" if i % 2 else "to_run", None if i == 3 else -i * 1.0) for i in range(1, 10 * k)])
    one = files.read_sqlite(spark, str(tmp_path / "c_1.db"), parts=3)
    assert one.count() == 9 and one.where("final_energy is null").count() == 1
    assert one.where("status = 'failed'").count() == 5
    more = files.read_sqlite(spark, str(tmp_path / "c_1.db"), schema="id long, worker_id string")
    assert more.where("worker_id is null").count() == 9
    assert {r.chunk: r["count"] for r in files.read_chunks(spark, str(tmp_path)).groupBy("chunk").count().collect()} == {0: 9, 1: 19}


def test_caches_and_markers(spark):
    rows = spark.createDataFrame([("a", '{"_source_mtime": 5.0, "scf_steps": 7}'), ("b", "{bad"), ("c", "")], "job_dir string, text string")
    cache = tables.read_cache(rows, "scf_steps int")
    assert [(r.job_dir, r.source_mtime, r.scf_steps) for r in cache.collect()] == [("a", 5.0, 7)]
    seen = joins.with_cache(spark.createDataFrame([("a", 5.0), ("a2", 1.0), ("b", 1.0)], "job_dir string, mtime double"), cache)
    assert {r.job_dir: (r.hit, r.scf_steps) for r in seen.collect()} == {"a": (True, 7), "a2": (False, None), "b": (False, None)}
    m = tables.marker_reasons(spark.createDataFrame([("a", '{"failure_reason": " x "}'), ("b", '{"failure_reason": " "}'), ("c", "no")], "job_dir string, text string"))
    assert {r.job_dir: r.reason for r in m.collect()} == {"a": "x", "b": None, "c": None}
    text = '{"UF4": {"row_ids": [1, 2], "n_rows": 2, "n_geometries": 1, "ligand_types": ["F"], "spin_states": [3], "charge": 0, "natoms": 5}}'
    got = tables.mapping(spark.createDataFrame([(text,)], "text string")).first()
    assert got.molecule == "UF4" and got.row_ids == [1, 2]
    assert [r.spin for r in tables.atom_spins(spark.createDataFrame([("U", 5), ("H", 2)], "element string, gs int")).collect()] == [5, 3, 1, 2]


def col(spark, column, **fields):
    return spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in fields.items())).select(column.alias("x")).first().x


@pytest.mark.parametrize(("name", "ext"), [("orca.tmp", ".tmp"), ("a.tmp.3", ".tmp"), ("x.bas12", ".bas"), ("core", "core"), ("core.9", "core"), ("orca.out.gz", ".out.gz"), (".hidden", "(no ext)"), ("README", "(no ext)"), ("A.TXT", ".txt"), ("x.gz", ".gz")])
def test_extension(spark, name, ext):
    assert col(spark, paths.extension(F.col("n")), n=name) == ext


def test_paths(spark):
    i = col(spark, paths.path_info(F.col("p")), p="/root/lotA/categoryX/Molecule123/spin_5")
    assert (i.lot, i.cat, i.name, i.spin) == ("lotA", "categoryX", "Molecule123", "spin_5")
    assert col(spark, paths.path_info(F.col("p")), p="x/y").spin == "x"
    assert col(spark, paths.path_info(F.col("p")), p="c/M_PBE0/spin_1/orca.out").name == "M"
    assert col(spark, paths.formula(F.col("e")), e="U; O;O;") == "UO2" and col(spark, paths.formula(F.col("e")), e=None) == "unknown"
    with pytest.raises(ValueError):
        paths.render("job_{oops}", orig_index=F.col("a"), job_id=F.col("a"))
    with pytest.raises(ValueError):
        paths.with_prefix("x", "a/b")
    assert col(spark, paths.contained(F.col("p"), "/data"), p="/data/x") and not col(spark, paths.contained(F.col("p"), "/data"), p="/data/../etc")
    assert [col(spark, values.size_text(F.col("n")), n=n) for n in (5, 2048, 3 << 20, 5 << 30)] == ["5 B", "2.0 KB", "3.0 MB", "5.0 GB"]


def test_numbers(spark):
    assert col(spark, values.number_list(F.col("t")), t="[1, 2.5]") == [1.0, 2.5] and col(spark, values.number_list(F.col("t")), t='["a"]') is None and col(spark, values.number_list(F.col("t")), t="") == []
    sym, pos = F.array(*map(F.lit, ("U", "O", "O", "C"))), F.array(*[F.array(F.lit(x), F.lit(0.0), F.lit(0.0)) for x in (0.0, 2.3, 2.4, 5.0)])
    n = col(spark, geometry.neighbours(sym, pos, ["U"], 3.0), a=1)[0]
    assert (n.centre, n.element, n.nearest, n["count"]) == ("U", "O", 2.3, 2)
    assert col(spark, chemistry.spin_states(F.lit(3), F.lit(5)), a=1) == [3, 5, 6] and col(spark, chemistry.leaving_ligand(F.array(*map(F.lit, ("U", "O", "Cl")))), a=1) == "Cl"
    assert col(spark, chemistry.lumo_index(F.array(F.lit(92), F.lit(8)), F.lit(0)), a=1) == 11
    assert [col(spark, chemistry.bags_match(F.split("a", ""), F.split("b", "")), a=x, b=y) for x, y in (("OHH", "HOH"), ("OHH", "OHU"), ("OH", "UHO"), ("OH", "OHH"))] == [True, False, True, False]
    v = col(spark, chemistry.spin_check(F.lit(2), F.lit(2)), a=1)
    assert not v.valid and v.note == "parity"


def test_curves(spark):
    rows = [(s, lot, -10.0 + d, f"3\nc\nU 0 0 0\nF 0 0 {2 + d}\nF 0 0 -2.0") for lot in "ab" for s in (1, 3) for d in (0.0, 0.5, 1.0)]
    df = spark.createDataFrame([*rows, (1, "a", 5.0, rows[0][3])], "spin int, lot string, final_energy double, geometry string")
    out = curves.dissociation(df, ["lot"]).collect()
    assert {round(r.distance, 3) for r in out} == {2.0, 2.5, 3.0} and len(out) == 12 and min(r.relative for r in out) == 0.0


def test_sinks(spark, tmp_path):
    jobs = spark.createDataFrame([(1, "to_run", "/r/a"), (2, "failed", " "), (3, "failed", "/r/a")], "id int, status string, job_dir string")
    back = sinks.write_snapshot(jobs, str(tmp_path / "snap"))
    assert back.where("status = 'failed'").count() == 2 and back.columns == jobs.columns
    assert [r.job_dir for r in sinks.transfer_list(jobs).collect()] == ["/r/a"]
    assert sinks.destinations(jobs.where("id = 1"), "/r", "/t").first().destination == "/t/a"
    with pytest.raises(Exception, match="outside root"):
        sinks.destinations(jobs, "/r", "/t").collect()
    assert [r.task_id for r in sinks.task_map(jobs).collect()] == [0, 1, 2]
    now = F.lit(dt.datetime(2024, 1, 2, 3))
    text = jobs.limit(1).select(sinks.marker_json("clean", now, {"why": F.lit("x")}).alias("m")).first().m
    assert text == '{"generated_by":"clean","date":"2024-01-02T03:00:00Z","why":"x"}'
    assert sinks.logged(jobs.limit(1).select("id"), now).first()[1:] == ("id", 1.0)
    rows = spark.createDataFrame([("a", None, ["U", "O"], [[0.0, 0.0, 0.0], [0.0, 0.0, 1.8]], [1.0] * 6, -1.5, 0, 1)], "job_dir string, failure string, symbols array<string>, positions array<array<double>>, forces array<double>, energy_ev double, charge int, mult int")
    assert sinks.extended_xyz(rows).first().value.split("\n")[3] == "O 0.0000000000 0.0000000000 1.8000000000 1.0000000000 1.0000000000 1.0000000000"
    sinks.write_report(jobs, str(tmp_path / "r"), "\t")
    assert spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "r")).count() == 3


def test_inserts_with_defaults(spark, tmp_path):
    now = F.lit(dt.datetime(2024, 1, 2))
    rows = spark.createDataFrame([(1, "U;O", None, "x"), (2, "H", "failed", None)], "orig_index long, elements string, status string, tag string")
    got = sinks.with_defaults(rows, now, {"tag": "text"}).orderBy("orig_index").collect()
    assert [(r.status, r.fail_count, r.created_at.day, r.tag, r.final_energy) for r in got] == [("to_run", 0, 2, "x", None), ("failed", 0, 2, None, None)]
    for bad in ({"no": "TEXT"}, {"t;g": "TEXT"}):
        with pytest.raises(ValueError):
            sinks.with_defaults(rows, now, bad)
    for _ in range(2):
        sinks.append_rows(str(tmp_path / "jobs"), rows, now)
    assert spark.read.parquet(str(tmp_path / "jobs")).where("status = 'to_run'").count() == 2


def test_files_are_written_whole_or_not(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/.do_not_rerun.json").write_text("old")
    rows = spark.createDataFrame([(str(tmp_path / "a/.do_not_rerun.json"), "{}é\n"), (str(tmp_path / "missing/x.json"), "t"), (str(tmp_path / "a/none"), None)], "path string, text string")
    got = {os.path.basename(r.path): r.error for r in sinks.write_files(rows).collect()}
    assert got[".do_not_rerun.json"] is None and got["none"] is None and got["x.json"].startswith("FileNotFoundError")
    assert (tmp_path / "a/.do_not_rerun.json").read_text() == "{}é\n" and (tmp_path / "a/none").read_text() == ""
    assert sorted(os.listdir(tmp_path / "a")) == [".do_not_rerun.json", "none"]


def test_npy_and_job_folders(spark, tmp_path):
    import numpy as np

    np.save(tmp_path / "a.npy", np.arange(6).reshape(2, 3))
    np.save(tmp_path / "b.npy", np.array([{"x": 1}], dtype=object), allow_pickle=True)
    (tmp_path / "c.npy").write_bytes(b"no")
    got = {os.path.basename(r.path): r for r in files.read_npy(spark, str(tmp_path)).collect()}
    assert (got["a.npy"].shape, got["a.npy"]["values"], got["a.npy"].error) == ([2, 3], [0.0, 1.0, 2.0, 3.0, 4.0, 5.0], None)
    assert got["b.npy"]["values"] is None and "ValueError" in got["b.npy"].error and got["c.npy"].error
    dirs = spark.createDataFrame([("/r/job_1",), ("/r/job_22/",), ("/r/my.job_3",), ("/job_4/x",)], "job_dir string")
    assert sorted(r.job_dir for r in files.matching_jobs(dirs).collect()) == ["/r/job_1", "/r/job_22/"]
    assert [r.job_dir for r in files.matching_jobs(dirs, "my.job_?").collect()] == ["/r/my.job_3"]


def test_one_call_and_input_decks(spark, tmp_path):
    (tmp_path / "s.csv").write_text(f"aligned_csd_core,charge,uhf\n{XYZ},0,1\n,1,1\n{XYZ},2,3\n")
    jobs = tables.create_jobs(spark, str(tmp_path / "s.csv"), str(tmp_path / "snap"))
    assert sorted((r.id, r.orig_index, r.status) for r in jobs.collect()) == [(1, 0, "to_run"), (2, 2, "to_run")]
    decks = spark.createDataFrame([("/r/B", "* xyz 1 2\nU 0 0 0\n*"), ("/r/A/", "* xyz 0 1\nO 0 0 0\nH 0 0 1\n*"), ("/r/C", "none")], "job_dir string, text string")
    got = tables.jobs_from_inputs(decks).orderBy("id").collect()
    assert [(r.id, r.orig_index, r.molecule_name, r.elements, r.charge, r.spin) for r in got] == [(1, 0, "A", "O;H", 0, 1), (2, 1, "B", "U", 1, 2)]
    assert got[0].geometry.split("\n")[:2] == ["2", "A"]


def test_transfer_summary(spark):
    paths = spark.createDataFrame([("/d/run/a1",), ("/d/run/ab",), ("/d/rux",)], "job_dir string")
    there = spark.createDataFrame([("/d/run/a1",), ("/d/run/a1",), ("/q",)], "job_dir string")
    assert tuple(sinks.transfer_summary(paths, there).first()) == (3, 1, 2, "/d/")
    assert tuple(sinks.transfer_summary(paths.limit(0), there).first()) == (0, 0, 0, None)


def test_buffered_outcomes(spark, tmp_path):
    """Flushed ten or more at a time, the rest at the end; a batch that is run again changes nothing."""
    source = spark.range(64).selectExpr("id", "'completed' AS status")
    source.repartition(16).write.parquet(str(tmp_path / "in"))
    buffered = events.Buffered(spark, str(tmp_path / "out"), lambda rows: rows.selectExpr("id", "concat('got ', status) AS status"), 10)
    stream = events.read_events(spark, str(tmp_path / "in"), "id long, status string", 1)
    buffered.start(stream, str(tmp_path / "cp")).awaitTermination(240)
    flushed = lambda: spark.read.parquet(str(tmp_path / "out/flushed"))
    sizes = [r["count"] for r in flushed().groupBy("upto").count().collect()]
    assert len(sizes) >= 3 and all(10 <= n < 20 for n in sizes)
    last = max(r.upto for r in flushed().select("upto").distinct().collect())
    again = spark.read.parquet(str(tmp_path / f"out/pending/batch={last}")).collect()
    buffered.write(spark.createDataFrame(again, "id long, status string"), last)
    assert sorted(r["count"] for r in flushed().groupBy("upto").count().collect()) == sorted(sizes)
    buffered.finish()
    assert not buffered.finish()
    got = flushed().collect()
    assert sorted(r.id for r in got) == list(range(64)) and {r.status for r in got} == {"got completed"}


def test_streaming(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.read_events(spark, str(tmp_path / "in"), source._jdf.schema().toDDL(), 1)
    q = events.each_batch(stream, lambda b: b.groupBy("event_type").count(), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("count")).first()[0] == source.count()
    w = events.tumbling(events.read_events(spark, str(tmp_path / "in"), source._jdf.schema().toDDL()), "1 day", late="0 seconds")
    q = w.writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select sum(n) from days").first()[0] == source.count()
    left = events.outdated(spark.createDataFrame([("a", 2), ("b", 2)], "path string, mtime int"), spark.createDataFrame([("a", 2), ("b", 1)], "path string, source_mtime int"))
    assert [r.path for r in left.collect()] == ["b"]
