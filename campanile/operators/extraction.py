"""From listings and texts to job facts: which file counts, how a job ended, what it measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.constants import ACTINIDES, ATOM_OUTPUT, HARTREE_EV
from campanile.functions import chemistry, geometry, logs, xyz


def primary_logs(files: DataFrame) -> DataFrame:
    """Of each job_dir the log that metrics come from (files: job_dir, name, mtime, ...): *logs, orca.out, *.out, *.out.gz, flux-*; newest first."""
    return _first(files, _priority(("logs$", None), ("^orca\\.out$", None), ("\\.out$", ATOM_OUTPUT), ("\\.out\\.gz$", None), ("^flux-", None)))


def termination_logs(files: DataFrame, flux: bool = False) -> DataFrame:
    """Of each job_dir the file that tells how it ended: names ending out, .out.gz, logs; or only flux*out."""
    rules = [("^flux.*out$", None)] if flux else [("out$", ATOM_OUTPUT), ("\\.out\\.gz$", None), ("logs$", None)]
    return _first(files, _priority(*rules))


def _priority(*rules: tuple[str, str | None]) -> Column:
    out = F.lit(None).cast("int")
    for i, (pattern, but) in reversed(list(enumerate(rules))):
        hit = F.col("name").rlike(pattern) if but is None else F.col("name").rlike(pattern) & ~F.col("name").rlike(but)
        out = F.when(hit, i).otherwise(out)
    return out


def _first(files: DataFrame, priority: Column) -> DataFrame:
    w = Window.partitionBy("job_dir").orderBy("_p", F.desc("mtime"), "name")
    return files.withColumn("_p", priority).where("_p is not null").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_p", "_r")


def terminations(texts: DataFrame, now: Column, hours: float = 6, lines: int = 10) -> DataFrame:
    """texts (job_dir, text, mtime) with code and failure reason."""
    t, m = F.col("text"), F.col("mtime")
    return texts.select("job_dir", logs.termination(t, m, now, hours, lines).alias("code"), logs.failure_reason(t, lines).alias("reason"))


def directory_terminations(dirs: DataFrame, texts: DataFrame, now: Column, hours: float = 6) -> DataFrame:
    """How each directory ended (dirs: job_dir, dir_mtime, sella_status, sella_log_mtime, is_sella): by the optimiser's status, else its output, else its age."""
    ended = texts.select("job_dir", logs.termination(F.col("text"), F.col("mtime"), now, hours).alias("_code"))
    aged = F.when(logs.stale(F.col("dir_mtime"), now, hours), -2).otherwise(0)
    sella = logs.sella_termination(F.col("sella_status"), F.col("sella_log_mtime"), F.col("dir_mtime"), now, hours)
    return dirs.join(ended, "job_dir", "left").select("job_dir", F.when(F.col("is_sella"), sella).otherwise(F.coalesce("_code", aged)).alias("code"))


def many_terminations(texts: DataFrame, now: Column, hours: float = 6) -> DataFrame:
    """One code for each directory from all of its outputs."""
    codes = texts.select("job_dir", logs.termination(F.col("text"), F.col("mtime"), now, hours).alias("c"))
    return codes.groupBy("job_dir").agg(F.collect_list("c").alias("c")).select("job_dir", logs.fold_statuses(F.col("c")).alias("code"))


def metrics(texts: DataFrame, now: Column, hours: float = 6) -> DataFrame:
    """texts (job_dir, text, mtime) with all facts of one pass, flattened."""
    return texts.select("job_dir", "mtime", logs.metrics(F.col("text"), F.col("mtime"), now, hours).alias("m")).select("job_dir", "mtime", "m.*")


def job_metrics(outputs: DataFrame, inputs: DataFrame, gradients: DataFrame, sella: DataFrame, now: Column, hours: float = 6) -> DataFrame:
    """Job facts from four texts by job_dir: the output, the input's charge and multiplicity, the gradient file where the output has no
    force, and the optimiser's status, which overrides. ``max_forces_source`` says where the force is from."""
    m = metrics(outputs, now, hours)
    i = inputs.select("job_dir", xyz.charge_and_multiplicity(F.col("text")).alias("cm"))
    g = gradients.select("job_dir", logs.gradient_file(F.col("text"))["max_force"].alias("_engrad"))
    s = sella.select("job_dir", logs.key_values(F.col("text")).alias("_kv"))
    kv = lambda k: F.try_element_at(F.col("_kv"), F.lit(k))
    out = m.join(i, "job_dir", "left").join(g, "job_dir", "left").join(s, "job_dir", "left")
    source = F.when(kv("final_fmax").try_cast("double").isNotNull(), "sella").when(F.col("max_forces").isNotNull(), "log").when(F.col("_engrad").isNotNull(), "engrad")
    out = out.withColumns(
        {
            "max_forces_source": source,
            "max_forces": F.coalesce(kv("final_fmax").try_cast("double"), "max_forces", "_engrad"),
            "success": F.when(F.col("_kv").isNotNull(), kv("status") == "CONVERGED").otherwise(F.col("success")),
            "sella_steps": kv("steps").try_cast("int"),
            "charge": F.col("cm.charge"),
            "mult": F.col("cm.mult"),
        }
    )
    checked = lambda p: chemistry.conservation(F.col(f"{p}.charges"), F.col(f"{p}.spins"), F.col("charge"), F.col("mult"))
    return out.withColumn("mulliken_check", checked("mulliken")).withColumn("loewdin_check", checked("loewdin")).drop("cm", "_engrad", "_kv")


def force_baselines(jobs: DataFrame, gradients: DataFrame, cutoff: float = 4.0) -> DataFrame:
    """Force statistics of each job (id, job_dir, dir_exists, natoms) from its gradient file's text, with a note where there are none."""
    g = gradients.select("job_dir", F.col("text").alias("_text"), logs.gradient_file(F.col("text")).alias("g"))
    rows = jobs.join(g, "job_dir", "left")
    n = F.size("g.elements")
    note = (
        F.when(F.col("job_dir").isNull(), "no_job_dir")
        .when(~F.coalesce("dir_exists", F.lit(False)), "dir_not_found")
        .when(F.col("_text").isNull(), "no_engrad")
        .when(F.trim("_text") == "", "empty_engrad")
        .when(F.col("g.total_energy").isNull() | (n < 1), "parse_failed")
        .when((F.size("g.gradient") != 3 * n) | F.exists("g.gradient", lambda x: x.isNull()), "bad_gradient")
        .when(n != F.col("natoms"), "atom_count_mismatch")
    )
    rows = rows.withColumn("parse_note", note)
    symbols = F.transform("g.elements", chemistry.symbol)
    rows = rows.withColumns({"symbols": symbols, "forces": F.when(F.col("parse_note").isNull(), geometry.norms(geometry.triples(F.col("g.gradient"))))})
    near = geometry.near_any(F.col("symbols"), F.col("g.coords"), ACTINIDES, cutoff)
    close = F.transform(F.filter(F.arrays_zip(F.col("forces").alias("f"), near.alias("near")), lambda p: p["near"]), lambda p: p["f"])
    parts = {"all": F.col("forces"), "actinide": geometry.pick(F.col("forces"), F.col("symbols"), ACTINIDES), "other": geometry.pick(F.col("forces"), F.col("symbols"), ACTINIDES, False), "neighbor": close}
    stats = {f"{k}_{s}": geometry.force_summary(v)[s] for k, v in parts.items() for s in ("max", "mean")}
    return rows.select("id", "job_dir", "parse_note", F.col("g.total_energy").alias("engrad_energy"), F.lit(cutoff).alias("neighbor_cutoff"), *[F.when(F.col("parse_note").isNull(), v).alias(k) for k, v in stats.items()])


def dataset_rows(jobs: DataFrame) -> DataFrame:
    """Rows fit for a dataset, or why not (jobs: job_dir, out_text, code, engrad_text, inp_text); forces are minus the gradient, in eV/Angstrom."""
    g = logs.gradient_file(F.col("engrad_text"))
    rows = jobs.withColumn("g", g).withColumn("cm", xyz.charge_and_multiplicity(F.col("inp_text")))
    n = F.size("g.elements")
    failure = (
        F.when(F.col("out_text").isNull(), "no_out")
        .when(F.col("code") != 1, "not_terminated")
        .when(F.col("engrad_text").isNull(), "no_engrad")
        .when(F.col("g.total_energy").isNull(), "parse_failed")
        .when(n < 1, "incomplete_engrad")
        .when((F.size("g.gradient") != 3 * n) | F.exists("g.gradient", lambda x: x.isNull()), "bad_gradient")
        .when(F.col("inp_text").isNull(), "no_inp")
        .when(F.col("cm.charge").isNull(), "inp_parse_failed")
    )
    k = -HARTREE_EV / 0.529177210903
    return rows.select(
        "job_dir", failure.alias("failure"), (F.col("g.total_energy") * HARTREE_EV).alias("energy_ev"), F.transform("g.elements", chemistry.symbol).alias("symbols"),
        F.transform("g.coords", lambda c: F.transform(c, lambda x: x * 0.529177210903)).alias("positions"),
        F.transform("g.gradient", lambda x: x * F.lit(k)).alias("forces"), "cm.charge", "cm.mult",
    )


def run_summary(runs: DataFrame) -> DataFrame:
    """runs (name, status, frames) with delta_energy (last less first); a delta that is missing, not finite or 0 makes status 0."""
    e = F.transform("frames", lambda f: f["energy"])
    delta = F.when(F.size(e) > 0, F.element_at(e, -1) - F.element_at(e, 1))
    out = runs.withColumn("delta_energy", delta)
    good = F.col("delta_energy").isNotNull() & ~F.isnan("delta_energy") & (F.abs("delta_energy") < float("inf")) & (F.col("delta_energy") != 0)
    return out.withColumn("status", F.when(good, F.col("status")).otherwise(0)).select("name", "status", "delta_energy")


def metrics_or_errors(dirs: DataFrame, texts: DataFrame, now: Column, hours: float = 6) -> DataFrame:
    """A row for each directory (job_dir): its facts, or in ``error`` why there are none; one directory's trouble is no other's."""
    m = metrics(texts, now, hours).withColumn("_there", F.lit(True))
    out = dirs.select("job_dir").join(m, "job_dir", "left")
    none = F.col("final_energy").isNull() & F.col("max_forces").isNull() & F.col("scf_steps").isNull()
    error = F.when(F.col("_there").isNull(), "no output file").when(none & (F.col("termination_status") != 1), "no metrics in output")
    return out.withColumn("error", error).drop("_there")


def start_to_final(starts: DataFrame, finals: DataFrame) -> DataFrame:
    """(job_dir, rmsd, n) between geometries (job_dir, text) at the start and at the end; NULL where they aren't the same atoms in the same order."""
    read = lambda df, name: df.select("job_dir", xyz.symbols_and_positions(xyz.atoms(F.col("text"))).alias(name))
    both = read(starts, "a").join(read(finals, "b"), "job_dir")
    value = geometry.rmsd(F.col("a.positions"), F.col("b.positions"), F.col("a.symbols"), F.col("b.symbols"))
    return both.select("job_dir", value.alias("rmsd"), F.size("b.symbols").alias("n"))
