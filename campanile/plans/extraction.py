"""Facts from outputs, gradient files, logs and geometries that documents stand for.

The texts are made by expressions that mean the same in both engines; the SQL takes them apart again by its own expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.functions import chemistry, geometry, logs, xyz
from campanile.operators import curves, extraction, validation
from campanile.plans.registry import query, table
from campanile.sources import tables, texts

S = SparkSession
NOW = "timestamp'2024-01-02 00:00:00'"


def text_of(*parts: str) -> str:
    """An expression for lines; a part is a quoted text or an expression."""
    return "concat(" + ", chr(10), ".join(parts) + ")"


def _n(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


#: Outputs: two cycles, populations in one of two spellings or none, one of several ends. The documents' own texts come first.
OUTPUT = text_of(
    "coalesce(text, '')",
    f"concat('%pal nprocs ', {_n('doc_id % 7 + 1')}, ' end nprocs ', {_n('doc_id % 16 + 1')})",
    f"concat('SCF CONVERGED AFTER  ', {_n('doc_id % 9 + 1')}, ' CYCLES')",
    "'MULLIKEN ATOMIC CHARGES AND SPIN POPULATIONS'",
    "'--------'",
    "'   0 U :    0.9    9.5'",
    "'Sum of atomic charges    :    0.9'",
    "'MAX gradient     0.5    0.0003  NO'",
    "CASE WHEN doc_id % 4 = 0 THEN 'MAX gradient   ...   none' ELSE 'MAX gradient   ...   0.75' END",
    f"concat('FINAL SINGLE POINT ENERGY    -', {_n('doc_id')}, '.5')",
    "CASE WHEN doc_id % 4 = 1 THEN '' ELSE 'SCF CONVERGED AFTER   30 CYCLES' END",
    "CASE WHEN doc_id % 6 = 0 THEN 'no populations' ELSE 'MULLIKEN ATOMIC CHARGES AND SPIN POPULATIONS' END",
    "'--------'",
    f"concat('   0 U', CASE WHEN doc_id % 2 = 0 THEN ' :' ELSE ':' END, '    0.', {_n('doc_id % 90 + 10')}, '    2.', {_n('doc_id % 9')})",
    f"concat('   1 O', CASE WHEN doc_id % 2 = 0 THEN ' :' ELSE ':' END, '   -0.', {_n('doc_id % 90 + 10')}, '   -0.', {_n('doc_id % 9')})",
    "'Sum of atomic charges    :    0.0'",
    f"concat(' GEOMETRY OPTIMIZATION CYCLE   ', {_n('doc_id % 12 + 1')}, '   *')",
    "'   |Geometry convergence|'",
    f"concat('RMS gradient    0.0', {_n('doc_id % 30 + 10')}, '   0.0001   NO')",
    f"concat('MAX gradient    0.', {_n('doc_id % 30 + 10')}, '   0.0003   ', CASE WHEN doc_id % 3 = 0 THEN 'YES' ELSE '0.25' END)",
    "''",
    f"concat('Total Energy       :   -', {_n('doc_id')}, '.25 Eh   -', {_n('doc_id')}, ' eV')",
    "'Total Energy       :   -1.125 Eh'",
    f"concat('FINAL SINGLE POINT ENERGY    -', {_n('doc_id')}, '.', {_n('doc_id % 90 + 10')})",
    f"concat('Sum of individual times          ...   ', {_n('doc_id % 1000')}, '.5 sec')",
    "'Startup calculation              ...        4.25 sec (=   0.07 min)'",
    "CASE WHEN doc_id % 2 = 0 THEN 'Property calculations            ...      odd sec' ELSE 'Property calculations            ...      0.5 sec' END",
    f"concat('SCF Gradient evaluation          ...   ', {_n('doc_id % 60')}, '.125 sec')",
    "CASE doc_id % 5 WHEN 0 THEN 'aborting the run' WHEN 1 THEN '  an Error here ' WHEN 2 THEN 'nothing' ELSE 'ORCA TERMINATED NORMALLY' END",
)
#: Gradient files: two atoms, the second one at one of nine distances; a few are broken.
GRADIENT = text_of(
    "'#'", "'# Number of atoms'", "CASE WHEN doc_id % 13 = 0 THEN ' none' ELSE ' 2' END", "'#'", f"concat(' -', {_n('doc_id')}, '.5')", "'# gradient'",
    f"concat(' 0.', {_n('doc_id % 9')})", "' 3.0'", "' 4.0'", f"concat(' -1.', {_n('doc_id % 7')})", "CASE WHEN doc_id % 17 = 0 THEN ' x' ELSE ' 0.0' END", "' 0.5'", "'# atoms'", "'  92 0.0 0.0 0.0'",
    f"concat('   8 0.0 0.0 ', {_n('doc_id % 9')}, '.5')",
)
INPUT = text_of("'! opt'", f"concat(CASE WHEN doc_id % 3 = 0 THEN '* xyz ' ELSE '*xyz ' END, {_n('doc_id % 3 - 1')}, ' ', {_n('doc_id % 4 + 1')})", "'U 0 0 0'", f"concat('O 0 0 1.', {_n('doc_id % 9')})", "'*'")
STATUS_FILE = text_of(
    "CASE doc_id % 3 WHEN 0 THEN 'status: CONVERGED' WHEN 1 THEN 'status: NOT_CONVERGED' ELSE 'status: unknown' END", f"concat('steps: ', {_n('doc_id % 40')})", f"concat('final_fmax: 0.0', {_n('doc_id % 40')})", "'note: a: b'", "'final'"
)
XYZ = text_of("'3'", "'a comment'", "'U 0.0 0.0 0.0'", "'short 1'", f"concat('  O  1.', {_n('doc_id % 9')}, ' 2.0 x')", "''", "'F -2.0 0.0 0.5'")
#: A fact file that is there for some of the documents.
_OLD = "CASE WHEN doc_id % 2 = 0 THEN timestamp'2024-01-01 00:00:00' ELSE timestamp'2024-01-01 23:00:00' END"


def made(spark: S, d: str, expression: str, where: str = "true") -> DataFrame:
    """(job_dir, text, mtime) of the documents' files of a kind."""
    return table(spark, d, "documents").where(where).selectExpr("doc_id AS job_dir", f"{expression} AS text", f"{_OLD} AS mtime")


def files(name: str, expression: str, where: str = "true") -> str:
    """The same as a CTE, with its lines."""
    return f"{name} AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM (SELECT doc_id, {expression} AS text FROM documents WHERE {where}))"


_O, _G = files("o", OUTPUT), files("g0", GRADIENT)
#: The last token, if it is a number, of the last line with a mark.
_LAST = lambda mark, source="lines": f"list_last(list_filter(list_transform(list_filter({source}, lambda x: contains(x, '{mark}')), lambda x: TRY_CAST(regexp_extract(x, '(\\S+)\\s*$', 1) AS DOUBLE)), lambda v: v IS NOT NULL))"
_LINES = "list_last(list_transform(list_filter(lines[-30:], lambda x: contains(x, '%s')), lambda x: TRY_CAST(string_split_regex(trim(x), '\\s+')[%d] AS DOUBLE)))"
_DONE = "len(list_filter(lines[-30:], lambda x: contains(x, 'ORCA TERMINATED NORMALLY'))) > 0"
_BAD = "len(list_filter(lines[-%d:], lambda x: contains(x, 'aborting the run') OR contains(x, 'Error'))) > 0"
_CODE = lambda n: f"CAST(CASE WHEN len(list_filter(lines[-{n}:], lambda x: contains(x, 'ORCA TERMINATED NORMALLY'))) > 0 THEN 1 WHEN {_BAD % n} THEN -1 WHEN doc_id % 2 = 0 THEN -2 ELSE 0 END AS INTEGER)"
_BLOCK = r"list_last(regexp_extract_all(text, 'MULLIKEN ATOMIC CHARGES AND SPIN POPULATIONS[^\n]*\n[^\n]*\n([\s\S]*?)\n\s*Sum of', 1))"
_CHARGES, _SPINS = (rf"list_transform(regexp_extract_all({_BLOCK}, '(\d+) +(\w+) ?: +(\S+) +(\S+)', {k}), lambda x: CAST(x AS DOUBLE))" for k in (3, 4))
#: Gradient files taken apart: lines that say something, then by place.
_GRADIENTS = f"""{_G}, g1 AS (SELECT doc_id, list_filter(lines, lambda x: trim(x) <> '' AND NOT starts_with(trim(x), '#')) AS data FROM g0),
g AS (SELECT doc_id, TRY_CAST(trim(data[1]) AS INTEGER) AS n, TRY_CAST(trim(data[2]) AS DOUBLE) AS energy, list_transform(data[3:8], lambda x: TRY_CAST(trim(x) AS DOUBLE)) AS v, list_transform(data[9:10], lambda x: string_split_regex(trim(x), '\\s+')) AS atoms FROM g1),
q AS (SELECT *, sqrt(v[1] ** 2 + v[2] ** 2 + v[3] ** 2) AS f1, sqrt(v[4] ** 2 + v[5] ** 2 + v[6] ** 2) AS f2 FROM g)"""


@query("output_forces", f"WITH {_O} SELECT doc_id, {_LAST('MAX gradient')} AS force FROM o")
def _(spark: S, d: str) -> DataFrame:
    return made(spark, d, OUTPUT).select(F.col("job_dir").alias("doc_id"), logs.max_forces(F.col("text")).alias("force"))


@query("output_total_energies", f"WITH {_O} SELECT doc_id, unnest(list_transform(list_filter(lines, lambda x: starts_with(x, 'Total Energy       :')), lambda x: CAST(string_split_regex(x, '\\s+')[4] AS DOUBLE))) AS energy FROM o")
def _(spark: S, d: str) -> DataFrame:
    return made(spark, d, OUTPUT).select(F.col("job_dir").alias("doc_id"), F.explode(logs.total_energies(F.col("text"))).alias("energy"))


@query("output_convergence", f"WITH {_O} SELECT doc_id, CAST(regexp_extract(text, 'RMS gradient +(\\S+)', 1) AS DOUBLE) AS rms, CAST(regexp_extract(text, 'RMS gradient[^\\n]*\\nMAX gradient +(\\S+)', 1) AS DOUBLE) AS most FROM o")
def _(spark: S, d: str) -> DataFrame:
    c = made(spark, d, OUTPUT).select("job_dir", F.explode(logs.convergence_forces(F.col("text"))).alias("c"))
    return c.select(F.col("job_dir").alias("doc_id"), "c.rms", F.col("c.max").alias("most"))


@query("output_last_cycle", f"WITH {_O} SELECT doc_id, CAST(list_last(regexp_extract_all(text, 'OPTIMIZATION CYCLE +([0-9]+)', 1)) AS INTEGER) AS cycle, CAST(list_last(regexp_extract_all(text, 'OPTIMIZATION CYCLE +([0-9]+)', 1)) AS INTEGER) > 1 AS moved FROM o")
def _(spark: S, d: str) -> DataFrame:
    outputs = made(spark, d, OUTPUT)
    cycles = outputs.select("job_dir", logs.last_cycle(F.col("text")).alias("cycle"))
    return cycles.join(validation.refined(outputs), "job_dir").select(F.col("job_dir").alias("doc_id"), "cycle", "moved")


@query("output_times", f"WITH {_O} SELECT doc_id, {_LINES % ('Sum of individual times', 6)} AS total, {_LINES % ('Startup', 4)} AS startup, {_LINES % ('Property', 4)} AS property, {_LINES % ('Gradient', 5)} AS gradient FROM o WHERE {_DONE}")
def _(spark: S, d: str) -> DataFrame:
    t = made(spark, d, OUTPUT).select("job_dir", logs.times(F.col("text")).alias("t")).where(F.size("t") > 0)
    at = lambda k: F.try_element_at("t", F.lit(k)).alias(k.lower())
    return t.select(F.col("job_dir").alias("doc_id"), at("Total"), at("Startup"), at("Property"), at("Gradient"))


@query(
    "output_populations",
    f"""WITH {_O}, x AS (SELECT doc_id, {_CHARGES} AS c, {_SPINS} AS s, regexp_extract_all({_BLOCK}, '(\\d+) +(\\w+) ?:', 2) AS e FROM o)
SELECT doc_id, array_to_string(e, ';') AS elements, round(list_sum(c), 6) AS charge, c[1] AS first_charge, s[-1] AS last_spin FROM x""",
)
def _(spark: S, d: str) -> DataFrame:
    p = made(spark, d, OUTPUT).select("job_dir", logs.population(F.col("text")).alias("p")).select("job_dir", "p.*")
    return p.select(F.col("job_dir").alias("doc_id"), F.array_join("elements", ";").alias("elements"), F.round(geometry.total(F.col("charges")), 6).alias("charge"), F.col("charges")[0].alias("first_charge"), F.element_at("spins", -1).alias("last_spin"))


_FACTS = f"""{_LAST('MAX gradient')} AS max_forces, {_LAST('FINAL SINGLE POINT ENERGY')} AS final_energy, CAST(list_sum(list_transform(regexp_extract_all(text, 'SCF CONVERGED AFTER +([0-9]+) +CYCLES', 1), lambda x: CAST(x AS INTEGER))) AS INTEGER) AS scf_steps,
CAST(list_filter(list_transform(list_filter(lines, lambda x: contains(x, 'nprocs')), lambda x: TRY_CAST(regexp_extract(x, '(\\S+)\\s*$', 1) AS INTEGER)), lambda v: v IS NOT NULL)[1] AS INTEGER) AS nprocs,
CASE WHEN {_DONE} THEN {_LINES % ('Sum of individual times', 6)} END AS wall_time, {_CODE(30)} AS termination_status, {_CHARGES}[1] AS first_charge"""


@query("output_metrics", f"WITH {_O} SELECT doc_id, {_FACTS} FROM o")
def _(spark: S, d: str) -> DataFrame:
    m = extraction.metrics(made(spark, d, OUTPUT), F.expr(NOW))
    return m.select(F.col("job_dir").alias("doc_id"), "max_forces", "final_energy", "scf_steps", "nprocs", "wall_time", "termination_status", F.col("mulliken.charges")[0].alias("first_charge"))


@query("failure_facts", f"WITH {_O} SELECT doc_id, CAST(list_sum(list_transform(regexp_extract_all(text, 'SCF CONVERGED AFTER +([0-9]+) +CYCLES', 1), lambda x: CAST(x AS INTEGER))) AS INTEGER) AS scf_steps, CASE WHEN len(list_filter(lines[-10:], lambda x: contains(x, 'ORCA TERMINATED NORMALLY'))) = 0 THEN trim(list_filter(lines[-10:], lambda x: contains(x, 'aborting the run') OR contains(x, 'Error'))[1]) END AS failure_reason FROM o")
def _(spark: S, d: str) -> DataFrame:
    return validation.failure_facts(made(spark, d, OUTPUT)).withColumnRenamed("job_dir", "doc_id")


@query("gradient_files", f"WITH {_GRADIENTS} SELECT doc_id, energy, v[1] AS first, v[6] AS last, greatest(f1, f2) AS max_force FROM q WHERE n = 2 AND doc_id % 17 > 0")
def _(spark: S, d: str) -> DataFrame:
    g = made(spark, d, GRADIENT, "doc_id % 17 > 0").select("job_dir", logs.gradient_file(F.col("text")).alias("g")).where(F.size("g.elements") > 0)
    return g.select(F.col("job_dir").alias("doc_id"), F.col("g.total_energy").alias("energy"), F.col("g.gradient")[0].alias("first"), F.element_at("g.gradient", -1).alias("last"), F.col("g.max_force").alias("max_force"))


@query(
    "status_files",
    f"WITH {files('s', STATUS_FILE)} SELECT doc_id, regexp_extract(text, '(^|\\n)status: ([^\\n]*)', 2) AS status, CAST(regexp_extract(text, '\\nsteps: ([^\\n]*)', 1) AS INTEGER) AS steps, regexp_extract(text, '\\nnote: ([^\\n]*)', 1) AS note, len(regexp_extract_all(text, '[^\\n]*:[^\\n]*')) AS n FROM s",
)
def _(spark: S, d: str) -> DataFrame:
    kv = made(spark, d, STATUS_FILE).select("job_dir", logs.key_values(F.col("text")).alias("kv"))
    return kv.select(F.col("job_dir").alias("doc_id"), F.col("kv")["status"].alias("status"), F.col("kv")["steps"].cast("int").alias("steps"), F.col("kv")["note"].alias("note"), F.size("kv").cast("long").alias("n"))


_AGE = "CASE WHEN doc_id % 2 = 0 THEN -2 ELSE 0 END"


@query(
    "optimiser_terminations",
    f"WITH {files('s', STATUS_FILE)} SELECT doc_id, CAST(CASE WHEN doc_id % 4 = 0 THEN {_AGE} WHEN contains(text, 'NOT_CONVERGED') THEN -1 WHEN contains(text, 'CONVERGED') THEN 1 WHEN doc_id % 8 = 1 THEN 0 ELSE {_AGE} END AS INTEGER) AS code FROM s",
)
def _(spark: S, d: str) -> DataFrame:
    k = F.col("job_dir")
    log = F.when(k % 8 == 1, F.expr("timestamp'2024-01-01 23:30:00'"))
    rows = made(spark, d, STATUS_FILE)
    return rows.select(k.alias("doc_id"), logs.sella_termination(F.when(k % 4 != 0, F.col("text")), log, F.col("mtime"), F.expr(NOW)).alias("code"))


@query(
    "directory_terminations",
    f"""WITH {_O}, {files('s', STATUS_FILE)}, c AS (SELECT o.doc_id, {_CODE(10).replace('lines', 'o.lines').replace('doc_id', 'o.doc_id')} AS out_code, s.text AS status FROM o JOIN s ON s.doc_id = o.doc_id)
SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN CASE WHEN contains(status, 'NOT_CONVERGED') THEN -1 WHEN contains(status, 'CONVERGED') THEN 1 ELSE {_AGE} END WHEN doc_id % 7 = 0 THEN {_AGE} ELSE out_code END AS INTEGER) AS code FROM c""",
)
def _(spark: S, d: str) -> DataFrame:
    dirs = made(spark, d, STATUS_FILE).select("job_dir", F.col("mtime").alias("dir_mtime"), F.col("text").alias("sella_status"), F.lit(None).cast("timestamp").alias("sella_log_mtime"), (F.col("job_dir") % 3 == 0).alias("is_sella"))
    return extraction.directory_terminations(dirs, made(spark, d, OUTPUT, "doc_id % 7 <> 0"), F.expr(NOW)).withColumnRenamed("job_dir", "doc_id")


@query(
    "many_terminations",
    f"WITH {_O}, c AS (SELECT doc_id // 3 AS dir, {_CODE(10)} AS code FROM o) SELECT dir, CAST(CASE WHEN bool_and(code = 1) THEN 1 WHEN bool_or(code = -2) THEN -2 WHEN bool_or(code = -1) THEN -1 ELSE 0 END AS INTEGER) AS code FROM c GROUP BY dir",
)
def _(spark: S, d: str) -> DataFrame:
    outputs = made(spark, d, OUTPUT).withColumn("job_dir", F.floor(F.col("job_dir") / 3))
    return extraction.many_terminations(outputs, F.expr(NOW)).withColumnRenamed("job_dir", "dir")


_STEPS = text_of("'     Step     Time          Energy         fmax'", f"concat('Sella:    1 10:00:00    -', {_n('doc_id')}, '.5    0.', {_n('doc_id % 80 + 10')})", "'Sella:  two 10:00:00    -1.0   0.5'", f"concat('Sella:    2 10:05:00    -', {_n('doc_id + 1')}, '.25   0.0', {_n('doc_id % 30')})")


@query("optimiser_steps", f"WITH {files('s', _STEPS)}, r AS (SELECT doc_id, string_split_regex(unnest(list_filter(lines, lambda x: starts_with(x, 'Sella:'))), ' +') AS t FROM s) SELECT doc_id, TRY_CAST(t[2] AS INTEGER) AS step, CAST(t[4] AS DOUBLE) AS energy, CAST(t[5] AS DOUBLE) AS force FROM r WHERE TRY_CAST(t[2] AS INTEGER) IS NOT NULL")
def _(spark: S, d: str) -> DataFrame:
    rows = made(spark, d, _STEPS).select("job_dir", F.explode(logs.sella_steps(F.col("text"))).alias("s"))
    return rows.select(F.col("job_dir").alias("doc_id"), "s.step", "s.energy", "s.force")


@query("optimiser_converged", f"WITH {files('s', _STEPS)} SELECT doc_id, CAST(regexp_extract(lines[-1], '(\\S+)$', 1) AS DOUBLE) < 0.01 AS converged FROM s")
def _(spark: S, d: str) -> DataFrame:
    # the optimiser's name is the first of five tokens, so the force's place is the fourth without it
    rows = made(spark, d, _STEPS).select("job_dir", F.regexp_replace("text", "Sella:", "").alias("text"))
    return rows.select(F.col("job_dir").alias("doc_id"), logs.ase_converged(F.col("text")).alias("converged"))


@query("run_summaries", f"WITH {files('s', _STEPS)}, e AS (SELECT doc_id, list_filter(list_transform(list_filter(lines, lambda x: starts_with(x, 'Sella:')), lambda x: string_split_regex(x, ' +')), lambda t: TRY_CAST(t[2] AS INTEGER) IS NOT NULL) AS t FROM s), x AS (SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN CAST(t[-1][4] AS DOUBLE) - CAST(t[1][4] AS DOUBLE) END AS delta FROM e) SELECT doc_id, CAST(CASE WHEN delta <> 0 THEN 1 ELSE 0 END AS INTEGER) AS status, delta AS delta_energy FROM x")
def _(spark: S, d: str) -> DataFrame:
    rows = made(spark, d, _STEPS).select(F.col("job_dir").alias("name"), F.lit(1).alias("status"), F.when(F.col("job_dir") % 5 > 0, logs.sella_steps(F.col("text"))).alias("frames"))
    return extraction.run_summary(rows).withColumnRenamed("name", "doc_id")


_FRAMES = text_of("'3'", f"concat('Coordinates from ORCA-job x E -', {_n('doc_id')}, '.125')", "'U 0 0 0'", "'3'", "'Coordinates from ORCA-job x E -0.5'", "'U 0 0 0'")


@query("trajectory_frames", f"WITH {files('s', _FRAMES)} SELECT doc_id, CAST(i AS INTEGER) AS step, CAST(regexp_extract(lines[3 * i - 1], 'E (\\S+)$', 1) AS DOUBLE) AS energy FROM s, (SELECT unnest([1, 2]) AS i)")
def _(spark: S, d: str) -> DataFrame:
    rows = made(spark, d, _FRAMES).select("job_dir", F.explode(logs.frames(F.col("text"))).alias("f"))
    return rows.select(F.col("job_dir").alias("doc_id"), "f.step", "f.energy")


@query("input_decks", f"WITH {files('i', INPUT)} SELECT doc_id, CAST(regexp_extract(text, 'xyz (-?[0-9]+) ([0-9]+)', 1) AS INTEGER) AS charge, CAST(regexp_extract(text, 'xyz (-?[0-9]+) ([0-9]+)', 2) AS INTEGER) AS mult, CAST(2 AS INTEGER) AS n, CAST(regexp_extract(text, '\\nO 0 0 (\\S+)', 1) AS DOUBLE) AS z FROM i")
def _(spark: S, d: str) -> DataFrame:
    t = F.col("text")
    rows = made(spark, d, INPUT).select("job_dir", xyz.charge_and_multiplicity(t).alias("cm"), xyz.input_atoms(t).alias("a"))
    return rows.select(F.col("job_dir").alias("doc_id"), "cm.charge", "cm.mult", F.size("a").alias("n"), F.col("a")[1]["z"].alias("z"))


@query(
    "geometry_atoms",
    f"""WITH {files('x', XYZ)}, a AS (SELECT doc_id, unnest(list_filter(list_transform(list_filter(lines[3:], lambda x: trim(x) <> ''), lambda x: string_split_regex(trim(x), ' +')), lambda t: len(t) >= 4)) AS t FROM x)
SELECT doc_id, t[1] AS element, TRY_CAST(t[2] AS DOUBLE) AS x, TRY_CAST(t[3] AS DOUBLE) AS y, TRY_CAST(t[4] AS DOUBLE) AS z FROM a""",
)
def _(spark: S, d: str) -> DataFrame:
    return made(spark, d, XYZ).select(F.col("job_dir").alias("doc_id"), F.explode(xyz.atoms(F.col("text"))).alias("a")).select("doc_id", "a.*")


@query("geometry_texts", f"WITH {files('i', INPUT)} SELECT doc_id, concat('2', chr(10), doc_id, chr(10), 'U 0.0000000000 0.0000000000 0.0000000000', chr(10), 'O 0.0000000000 0.0000000000 ', format('{{:.10f}}', CAST(regexp_extract(lines[4], '(\\S+)$', 1) AS DOUBLE))) AS written, concat('O ', repeat(' ', 4), '0.0000000000', repeat(' ', 4), '0.0000000000', repeat(' ', 4), format('{{:.10f}}', CAST(regexp_extract(lines[4], '(\\S+)$', 1) AS DOUBLE))) AS aligned FROM i")
def _(spark: S, d: str) -> DataFrame:
    a = xyz.input_atoms(F.col("text"))
    rows = made(spark, d, INPUT)
    return rows.select(F.col("job_dir").alias("doc_id"), xyz.to_text(a, F.col("job_dir").cast("string")).alias("written"), F.split(xyz.aligned_text(a), "\n")[1].alias("aligned"))


@query("counted_geometry", f"WITH {files('x', XYZ)} SELECT doc_id, CAST(2 AS INTEGER) AS n, CAST(string_split_regex(trim(lines[5]), ' +')[2] AS DOUBLE) AS x FROM x")
def _(spark: S, d: str) -> DataFrame:
    a = xyz.counted_atoms(F.concat(F.lit("\n \n"), F.col("text")))
    return made(spark, d, XYZ).select(F.col("job_dir").alias("doc_id"), F.size(a).alias("n"), F.element_at(a, -1)["x"].alias("x"))


@query("centre_distances", f"WITH {files('i', INPUT)} SELECT doc_id, CAST(regexp_extract(lines[4], '(\\S+)$', 1) AS DOUBLE) AS distance FROM i")
def _(spark: S, d: str) -> DataFrame:
    s = xyz.symbols_and_positions(xyz.input_atoms(F.col("text")))
    rows = made(spark, d, INPUT).select(F.col("job_dir").alias("doc_id"), s.alias("s"))
    return rows.select("doc_id", geometry.centre_distance(F.col("s.symbols"), F.col("s.positions"), ["U"], F.lit(1)).alias("distance"))


_NOTE = """CASE WHEN doc_id % 11 = 0 THEN 'no_job_dir' WHEN doc_id % 7 = 0 THEN 'dir_not_found' WHEN doc_id % 5 = 0 THEN 'no_engrad' WHEN energy IS NULL OR n IS NULL THEN 'parse_failed'
WHEN len(list_filter(v, lambda x: x IS NULL)) > 0 THEN 'bad_gradient' WHEN doc_id % 10 = 1 THEN 'atom_count_mismatch' END"""


@query(
    "force_baselines",
    f"""WITH {_GRADIENTS}, b AS (SELECT *, {_NOTE} AS note, CAST(atoms[2][4] AS DOUBLE) <= 4 AS near FROM q)
SELECT doc_id, note, CASE WHEN note IS NULL THEN greatest(f1, f2) END AS all_max, CASE WHEN note IS NULL THEN f1 END AS actinide_max, CASE WHEN note IS NULL THEN f2 END AS other_mean, CASE WHEN note IS NULL AND near THEN f2 END AS neighbor_max FROM b""",
)
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    jobs = table(spark, d, "documents").select(k.alias("id"), F.when(k % 11 != 0, k).alias("job_dir"), (k % 7 != 0).alias("dir_exists"), F.when(k % 10 == 1, 3).otherwise(2).alias("natoms"))
    got = extraction.force_baselines(jobs, made(spark, d, GRADIENT, "doc_id % 5 <> 0"))
    return got.select(F.col("id").alias("doc_id"), F.col("parse_note").alias("note"), "all_max", "actinide_max", "other_mean", "neighbor_max")


@query(
    "dataset_rows",
    f"""WITH {_GRADIENTS}, f AS (SELECT *, CASE WHEN doc_id % 19 = 0 THEN 'no_out' WHEN doc_id % 3 = 1 THEN 'not_terminated' WHEN doc_id % 5 = 0 THEN 'no_engrad' WHEN n IS NULL THEN 'incomplete_engrad' WHEN len(list_filter(v, lambda x: x IS NULL)) > 0 THEN 'bad_gradient' WHEN doc_id % 7 = 0 THEN 'no_inp' END AS failure FROM q)
SELECT doc_id, failure, CASE WHEN doc_id % 5 > 0 THEN round(energy * 27.211386245988, 6) END AS energy_ev, CASE WHEN failure IS NULL THEN round(-v[1] * 27.211386245988 / 0.529177210903, 6) END AS first_force FROM f""",
)
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    docs = table(spark, d, "documents")
    jobs = docs.select(k.alias("job_dir"), F.when(k % 19 != 0, "out").alias("out_text"), F.when(k % 3 == 1, 0).otherwise(1).alias("code"), F.when(k % 5 != 0, F.expr(GRADIENT)).alias("engrad_text"), F.when(k % 7 != 0, F.expr(INPUT)).alias("inp_text"))
    got = extraction.dataset_rows(jobs)
    return got.select(F.col("job_dir").alias("doc_id"), "failure", F.round("energy_ev", 6).alias("energy_ev"), F.when(F.col("failure").isNull(), F.round(F.col("forces")[0], 6)).alias("first_force"))


@query(
    "job_metrics",
    f"""WITH {_O}, {files('i', INPUT, 'doc_id % 6 <> 1')}, {_GRADIENTS}, {files('s', STATUS_FILE, 'doc_id % 9 = 0')}, m AS (SELECT doc_id, {_FACTS} FROM o WHERE doc_id % 2 = 0),
e AS (SELECT doc_id, CASE WHEN n = 2 THEN greatest(f1, f2) END AS most FROM q), p AS (SELECT doc_id, CAST(regexp_extract(text, 'final_fmax: (\\S+)', 1) AS DOUBLE) AS fmax, regexp_extract(text, 'status: (\\S+)', 1) = 'CONVERGED' AS ok, CAST(regexp_extract(text, 'steps: (\\S+)', 1) AS INTEGER) AS steps FROM s)
SELECT m.doc_id, coalesce(p.fmax, m.max_forces, e.most) AS max_forces, CASE WHEN p.doc_id IS NOT NULL THEN 'sella' WHEN m.max_forces IS NOT NULL THEN 'log' WHEN e.most IS NOT NULL THEN 'engrad' END AS source, CASE WHEN p.doc_id IS NOT NULL THEN p.ok ELSE m.termination_status = 1 END AS success,
       p.steps AS sella_steps, CAST(regexp_extract(i.text, 'xyz (-?[0-9]+) ([0-9]+)', 1) AS INTEGER) AS charge, CAST(regexp_extract(i.text, 'xyz (-?[0-9]+) ([0-9]+)', 2) AS INTEGER) AS mult
FROM m LEFT JOIN i USING (doc_id) LEFT JOIN p USING (doc_id) LEFT JOIN e USING (doc_id)""",
)
def _(spark: S, d: str) -> DataFrame:
    got = extraction.job_metrics(made(spark, d, OUTPUT, "doc_id % 2 = 0"), made(spark, d, INPUT, "doc_id % 6 <> 1"), made(spark, d, GRADIENT), made(spark, d, STATUS_FILE, "doc_id % 9 = 0"), F.expr(NOW))
    return got.select(F.col("job_dir").alias("doc_id"), "max_forces", F.col("max_forces_source").alias("source"), "success", "sella_steps", "charge", "mult")


@query(
    "multi_spin_rows",
    f"""WITH {_O}, {_GRADIENTS}, m AS (SELECT doc_id, {_FACTS} FROM o WHERE doc_id % 3 > 0)
SELECT d.doc_id, lang AS lot, source AS category, concat('M', d.doc_id) AS name, concat('spin_', d.doc_id % 5) AS spin, coalesce(m.termination_status, 0) AS status, coalesce(m.final_energy, q.energy) AS final_energy,
       CASE WHEN m.max_forces IS NOT NULL THEN m.max_forces ELSE greatest(q.f1, q.f2) END AS max_force FROM documents d LEFT JOIN m USING (doc_id) LEFT JOIN q ON q.doc_id = d.doc_id AND q.n = 2 AND d.doc_id % 17 > 0""",
)
def _(spark: S, d: str) -> DataFrame:
    path = "concat('/root/', lang, '/', source, '/M', CAST(doc_id AS STRING), '/spin_', CAST(doc_id % 5 AS STRING))"
    docs = table(spark, d, "documents").selectExpr("doc_id AS job_dir", f"{path} AS path")
    named = lambda df: df.join(docs, "job_dir").drop("job_dir").withColumnRenamed("path", "job_dir")
    rows = validation.multi_spin_rows(docs.select("path"), named(made(spark, d, OUTPUT, "doc_id % 3 > 0")), named(made(spark, d, GRADIENT, "doc_id % 17 > 0 AND doc_id % 13 > 0")), F.expr(NOW))
    return rows.select(F.regexp_extract("name", r"(\d+)", 1).cast("long").alias("doc_id"), "lot", "category", "name", "spin", "status", "final_energy", "max_force")


@query(
    "dissociation",
    """WITH e AS (SELECT doc_id, lang, doc_id % 2 AS spin, CAST(doc_id % 7 AS DOUBLE) / 2 - 10 AS energy, 2 + CAST(doc_id % 5 AS DOUBLE) / 10 AS z FROM documents),
m AS (SELECT lang, spin, median(energy) AS med FROM e GROUP BY lang, spin), k AS (SELECT e.* FROM e JOIN m USING (lang, spin) WHERE abs(energy - med) <= 1)
SELECT doc_id, round(z, 6) AS distance, round((energy - min(energy) OVER (PARTITION BY lang, spin)) * 627.5094740631, 6) AS relative FROM k""",
)
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.concat(F.lit("3\nc\nF 0 0 -2.0\nU 0 0 0\nF 0 0 "), (F.lit(2) + (k % 5).cast("double") / 10).cast("string"))
    rows = table(spark, d, "documents").select("doc_id", "lang", (k % 2).alias("spin"), ((k % 7).cast("double") / 2 - 10).alias("final_energy"), text.alias("geometry"))
    out = curves.relative_energy(curves.near_median(curves.with_distance(rows, ["lang"]), "final_energy", ["lang", "spin"]), "final_energy", ["lang", "spin"])
    return out.select("doc_id", F.round("distance", 6).alias("distance"), F.round("relative", 6).alias("relative"))


@query("cached_metrics", "WITH c AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '{bad' WHEN doc_id % 4 = 1 THEN '' ELSE concat('{\"_source_mtime\": ', doc_id, '.5, \"scf_steps\": ', doc_id % 50, '}') END AS t FROM documents) SELECT doc_id, CAST(json_extract(t, '$._source_mtime') AS DOUBLE) AS source_mtime, CAST(json_extract(t, '$.scf_steps') AS INTEGER) AS scf_steps FROM c WHERE json_valid(t) AND t <> ''")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.when(k % 4 == 0, "{bad").when(k % 4 == 1, "").otherwise(F.concat(F.lit('{"_source_mtime": '), k.cast("string"), F.lit('.5, "scf_steps": '), (k % 50).cast("string"), F.lit("}")))
    return tables.read_cache(table(spark, d, "documents").select(k.alias("job_dir"), text.alias("text")), "scf_steps int").withColumnRenamed("job_dir", "doc_id")


@query("marker_reasons", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN lang END AS reason FROM documents")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.when(k % 3 == 0, F.concat(F.lit('{"failure_reason": " '), "lang", F.lit(' "}'))).when(k % 3 == 1, '{"failure_reason": " "}').otherwise("no")
    return tables.marker_reasons(table(spark, d, "documents").select(k.alias("job_dir"), text.alias("text"))).withColumnRenamed("job_dir", "doc_id")


@query("molecule_mapping", "SELECT concat('M', doc_id) AS molecule, doc_id % 3 - 1 AS charge, list_sum([doc_id, doc_id + 1])::BIGINT AS ids FROM documents")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id").cast("string")
    text = F.concat(F.lit('{"M'), k, F.lit('": {"row_ids": ['), k, F.lit(", "), (F.col("doc_id") + 1).cast("string"), F.lit('], "charge": '), (F.col("doc_id") % 3 - 1).cast("string"), F.lit("}}"))
    m = tables.mapping(table(spark, d, "documents").select(text.alias("text")))
    return m.select("molecule", F.col("charge").cast("long").alias("charge"), F.aggregate("row_ids", F.lit(0).cast("long"), lambda s, x: s + x).alias("ids"))


@query("reset_lists", "SELECT lang AS section, concat('job_', doc_id) AS job FROM documents UNION ALL SELECT lang, concat('next_', doc_id) FROM documents")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id").cast("string")
    text = F.concat(F.lit("# "), "lang", F.lit(" (2 jobs)\njob_"), k, F.lit(", next_"), k, F.lit(",\n"))
    return texts.reset_list(table(spark, d, "documents").select(k.alias("path"), text.alias("text")))


@query("geometry_blocks", "SELECT doc_id, molecule, CASE molecule WHEN 'A' THEN 2 ELSE 1 END AS n, CASE molecule WHEN 'A' THEN 'U;O' ELSE 'F' END AS elements FROM documents, (SELECT unnest(['A', 'B']) AS molecule)")
def _(spark: S, d: str) -> DataFrame:
    text = F.concat(F.lit("title\nGeometry for A\nU 0 0 0\nO 0 0 1."), (F.col("doc_id") % 9).cast("string"), F.lit("\n\n  Geometry for B:\nF 1 2 3\nnot an atom at all\n"))
    got = texts.geometry_blocks(table(spark, d, "documents").select(F.col("doc_id").alias("path"), text.alias("text")))
    return got.select(F.col("path").alias("doc_id"), "molecule", F.size("atoms").alias("n"), F.array_join(F.transform("atoms", lambda a: a["element"]), ";").alias("elements"))


@query("multiplicity_lines", "SELECT concat('M', doc_id // 2) AS molecule, CAST(min_by(doc_id % 3 - 1, doc_id) AS INTEGER) AS charge, array_to_string(list(doc_id % 4 + 1 ORDER BY doc_id), ';') AS mults FROM documents GROUP BY doc_id // 2")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    line = F.concat(F.lit("M"), F.floor(k / 2).cast("string"), F.lit(", charge="), (k % 3 - 1).cast("string"), F.lit(", mult = "), (k % 4 + 1).cast("string"))
    pair = table(spark, d, "documents").groupBy(F.floor(k / 2).alias("path")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", line.alias("l")))), lambda s: s["l"]), "\n").alias("text"))
    return texts.multiplicities(pair).select("molecule", "charge", F.array_join(F.col("mults").cast("array<string>"), ";").alias("mults"))


@query("continued_lines", "SELECT concat('M', doc_id) AS molecule, CAST(doc_id % 100 AS DOUBLE) + 0.5 AS zpve, concat(doc_id % 4 + 1, ' or', doc_id % 4 + 3) AS multiplicity FROM documents")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.concat(F.lit("M"), k.cast("string"), F.lit(", "), (k % 100).cast("string"), F.lit(".5, "), (k % 4 + 1).cast("string"), F.lit(" or\n"), (k % 4 + 3).cast("string"), F.lit("\n"))
    return texts.continued(table(spark, d, "documents").select(k.alias("path"), text.alias("text"))).drop("path")


@query("final_geometries", "SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN 'U' ELSE 'O' END AS element, CASE WHEN doc_id % 3 < 2 THEN CAST(doc_id AS DOUBLE) ELSE 1.0 END AS x FROM documents")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    coords = F.when(k % 3 < 2, F.concat(F.lit("[["), k.cast("string"), F.lit(",0,0]]"))).otherwise("[]")
    rows = table(spark, d, "documents").select("doc_id", coords.alias("final_coords"), F.when(k % 3 == 0, "[92]").when(k % 3 == 1, '["U"]').otherwise("[]").alias("final_elements"), F.lit("1\nc\nO 1 2 3\n").alias("xyz_text"))
    return validation.geometry_or_file(rows).select("doc_id", F.col("atoms")[0]["element"].alias("element"), F.col("atoms")[0]["x"].alias("x"))


@query("atomic_numbers", "SELECT p_partkey, CASE p_size WHEN 1 THEN 'H' WHEN 8 THEN 'O' WHEN 26 THEN 'Fe' END AS e FROM part WHERE p_size IN (1, 8, 26)")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "part").where("p_size in (1, 8, 26)").select("p_partkey", chemistry.symbol(F.col("p_size")).alias("e"))


_START, _FINAL = (text_of("'2'", "'c'", "'U 0.0 0.0 0.0'", f"concat(CASE WHEN doc_id % 6 = 5 THEN '{last}' ELSE 'O' END, ' 0.0 0.0 ', {_n(z)}, '.5')") for last, z in (("O", "doc_id % 9"), ("F", "doc_id % 4")))


@query("start_to_final", "SELECT doc_id, CASE WHEN doc_id % 6 < 5 THEN round(abs(doc_id % 9 - doc_id % 4) / sqrt(2), 9) END AS rmsd, CAST(2 AS INTEGER) AS n FROM documents")
def _(spark: S, d: str) -> DataFrame:
    got = extraction.start_to_final(made(spark, d, _START), made(spark, d, _FINAL))
    return got.select(F.col("job_dir").alias("doc_id"), F.round("rmsd", 9).alias("rmsd"), "n")


@query("metrics_or_errors", f"WITH {_O}, m AS (SELECT doc_id, {_FACTS} FROM o WHERE doc_id % 3 > 0) SELECT d.doc_id, m.final_energy, CASE WHEN m.doc_id IS NULL THEN 'no output file' END AS error FROM documents d LEFT JOIN m USING (doc_id)")
def _(spark: S, d: str) -> DataFrame:
    got = extraction.metrics_or_errors(made(spark, d, OUTPUT), made(spark, d, OUTPUT, "doc_id % 3 > 0"), F.expr(NOW))
    return got.select(F.col("job_dir").alias("doc_id"), "final_energy", "error")


@query("ended_well", f"WITH {_O} SELECT doc_id, contains(lines[-1], 'ORCA TERMINATED NORMALLY') AS well FROM o")
def _(spark: S, d: str) -> DataFrame:
    rows = made(spark, d, OUTPUT).select("job_dir", F.concat("text", F.lit("\nTOTAL RUN TIME: 0 days\n")).alias("text"))
    return rows.select(F.col("job_dir").alias("doc_id"), logs.ended_well(F.col("text")).alias("well"))


@query(
    "jobs_from_inputs",
    f"""WITH {files('i', INPUT)}, j AS (SELECT doc_id, concat('/an/m', lpad(CAST(doc_id AS VARCHAR), 9, '0')) AS dir, text, lines FROM i)
SELECT row_number() OVER (ORDER BY dir) AS id, row_number() OVER (ORDER BY dir) - 1 AS orig_index, regexp_extract(dir, '([^/]*)$', 1) AS molecule_name, 'U;O' AS elements, CAST(2 AS INTEGER) AS natoms, CAST(regexp_extract(text, 'xyz (-?[0-9]+) ([0-9]+)', 1) AS INTEGER) AS charge,
       CAST(regexp_extract(text, 'xyz (-?[0-9]+) ([0-9]+)', 2) AS INTEGER) AS spin, 'to_run' AS status, CAST(0 AS INTEGER) AS fail_count, '2024-01-02' AS created FROM j""",
)
def _(spark: S, d: str) -> DataFrame:
    rows = made(spark, d, INPUT).select(F.concat(F.lit("/an/m"), F.lpad(F.col("job_dir").cast("string"), 9, "0")).alias("job_dir"), "text")
    got = tables.jobs_from_inputs(rows, F.expr(NOW))
    return got.select("id", "orig_index", "molecule_name", "elements", "natoms", "charge", "spin", "status", "fail_count", F.date_format("created_at", "yyyy-MM-dd").alias("created"))
