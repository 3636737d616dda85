"""Whether the job table and the files on disk speak of the same structures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.functions import chemistry, logs, xyz
from campanile.operators.reports import gate
from campanile.operators.sampling import stratified


def alignment(jobs: DataFrame, inputs: DataFrame) -> DataFrame:
    """jobs (id, job_dir, elements) with a verdict against their input decks (job_dir, text): match, mismatch, or why it can't be told."""
    found = jobs.join(inputs.select("job_dir", F.col("text").alias("_text")), "job_dir", "left")
    row = F.filter(F.transform(F.split(F.coalesce("elements", F.lit("")), ";"), lambda s: F.trim(s)), lambda s: s != "")
    deck = F.transform(xyz.input_atoms(F.col("_text")), lambda a: a["element"])
    verdict = (
        F.when(F.col("job_dir").isNull(), "no_job_dir")
        .when(F.col("_text").isNull(), "no_input")
        .when(F.size(row) == 0, "no_elements")
        .when(F.size(deck) == 0, "unreadable_input")
        .when(chemistry.bags_match(row, deck), "match")
        .otherwise("mismatch")
    )
    return found.withColumn("verdict", verdict).drop("_text")


def validate(jobs: DataFrame, inputs: DataFrame, n: int = 100, incomplete: int = 50, least: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(gate, reasons) over a stratified sample: incomplete jobs first."""
    picked = stratified(jobs.where("job_dir is not null"), "status not in ('completed', 'failed')", n, incomplete, "id", seed)
    checked = alignment(picked, inputs)
    return gate(checked, least), checked.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def failure_facts(texts: DataFrame) -> DataFrame:
    """(job_dir, scf_steps, failure_reason) for a marker, from an output's text."""
    return texts.select("job_dir", logs.scf_steps(F.col("text")).alias("scf_steps"), logs.failure_reason(F.col("text")).alias("failure_reason"))


def geometry_or_file(rows: DataFrame, coords: str = "final_coords", elements: str = "final_elements", file_text: str = "xyz_text") -> DataFrame:
    """rows with ``atoms``: from JSON columns (symbols or atomic numbers), else from a counted file's text."""
    c = F.from_json(coords, "array<array<double>>")
    e = F.transform(F.from_json(elements, "array<string>"), lambda x: F.when(x.rlike(r"^\d+$"), chemistry.symbol(x.try_cast("int"))).otherwise(x))
    built = F.zip_with(e, c, lambda s, p: F.struct(s.alias("element"), F.get(p, 0).alias("x"), F.get(p, 1).alias("y"), F.get(p, 2).alias("z")))
    good = (F.size(c) > 0) & (F.size(c) == F.size(e))
    return rows.withColumn("atoms", F.coalesce(F.when(good, built), xyz.counted_atoms(F.col(file_text))))


def refined(texts: DataFrame) -> DataFrame:
    """(job_dir, moved): whether an output has more than one geometry cycle."""
    return texts.select("job_dir", F.coalesce(logs.last_cycle(F.col("text")) > 1, F.lit(False)).alias("moved"))


def multi_spin_rows(dirs: DataFrame, outputs: DataFrame, gradients: DataFrame, now, hours: float = 6) -> DataFrame:
    """A row of the multi-spin table for each directory (path): its name's parts, status, energy and forces, from the output, else the gradient file."""
    from campanile.functions.paths import path_info
    from campanile.operators.extraction import metrics

    m = metrics(outputs, now, hours).withColumnRenamed("job_dir", "path").drop("mtime")
    g = gradients.select(F.col("job_dir").alias("path"), logs.gradient_file(F.col("text")).alias("g"))
    rows = dirs.withColumn("i", path_info(F.col("path"))).join(m, "path", "left").join(g, "path", "left")
    return rows.select(
        "path", "i.lot", F.col("i.cat").alias("category"), "i.name", "i.spin", F.coalesce("termination_status", F.lit(0)).alias("status"),
        F.coalesce("final_energy", "g.total_energy").alias("final_energy"), F.coalesce("max_forces", "g.max_force").alias("max_force"), "mulliken.charges", "mulliken.spins",
    )
