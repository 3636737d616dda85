"""Schemas of the engine's tables, and the checks and additive migrations that keep them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanile.constants import COLUMN_TYPES, LEGACY_READY, RESERVED_NAMES

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in spec])


#: The job table's columns in order, a row for each structure.
JOBS = _schema(
    [("id", _L), ("orig_index", _L), ("elements", _S), ("natoms", _I), ("status", _S), ("charge", _I), ("spin", _I), ("geometry", _S), ("job_dir", _S)]
    + [("max_forces", _D), ("scf_steps", _I), ("final_energy", _D), ("error_message", _S), ("fail_count", _I), ("wall_time", _D), ("n_cores", _I)]
    + [("created_at", T.TimestampType()), ("updated_at", T.TimestampType()), ("optimizer", _S), ("worker_id", _S), ("generator_data", _S)]
)
HEAVY_COLUMNS = ("geometry", "generator_data")
ATOMS = T.ArrayType(_schema([("element", _S), ("x", _D), ("y", _D), ("z", _D)]))
FRAMES = T.ArrayType(_schema([("step", _I), ("energy", _D), ("force", _D)]))
POPULATION = _schema([("elements", T.ArrayType(_S)), ("indices", T.ArrayType(_I)), ("charges", T.ArrayType(_D)), ("spins", T.ArrayType(_D))])
METRICS = _schema(
    [("max_forces", _D), ("scf_steps", _I), ("final_energy", _D), ("nprocs", _I), ("wall_time", _D), ("time_dict", T.MapType(_S, _D)), ("termination_status", _I)]
    + [("success", T.BooleanType()), ("is_timeout", T.BooleanType()), ("mulliken", POPULATION), ("loewdin", POPULATION)]
)
GRADIENT = _schema([("total_energy", _D), ("gradient", T.ArrayType(_D)), ("elements", T.ArrayType(_I)), ("coords", T.ArrayType(T.ArrayType(_D))), ("max_force", _D)])
LISTING = _schema([("job_dir", _S), ("rel_path", _S), ("size", _L), ("mtime", T.TimestampType()), ("is_symlink", T.BooleanType())])
#: The multi-spin table's columns in order.
MULTI_SPIN = _schema(
    [("path", _S), ("lot", _S), ("category", _S), ("name", _S), ("spin", _S), ("status", _I), ("note", _S), ("checked_at", _D), ("run_type", _S)]
    + [("final_energy", _D), ("max_force", _D), ("rmsd_start_final", _D), ("final_rms_force", _D), ("has_final_geometry", _I), ("n_opt_steps", _I)]
    + [("final_coords", T.ArrayType(T.ArrayType(_D))), ("final_elements", T.ArrayType(_S)), ("mulliken_charges", T.ArrayType(_D)), ("mulliken_spins", T.ArrayType(_D))]
    + [("loewdin_charges", T.ArrayType(_D)), ("loewdin_spins", T.ArrayType(_D))]
)
MULTI_SPIN_VERSION = 2


def validate_extra_columns(extra: dict[str, str] | None) -> dict[str, str]:
    """Names of letters, digits and underscores that are not reserved, types from the list (given back in upper case)."""
    out = {}
    for name, kind in (extra or {}).items():
        if not name.replace("_", "").isalnum():
            raise ValueError(f"invalid column name: {name!r}")
        if name.upper() in RESERVED_NAMES:
            raise ValueError(f"reserved column name: {name!r}")
        if kind.upper() not in COLUMN_TYPES:
            raise ValueError(f"invalid column type: {kind!r}")
        out[name] = kind.upper()
    return out


def with_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Additive migration: columns that the schema has and df lacks are added as NULL; df's own extra columns stay."""
    have = set(df.columns)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in have}) if set(schema.names) - have else df


def migrate_jobs(df: DataFrame) -> DataFrame:
    """The job table with all its columns, the legacy status renamed."""
    full = with_missing_columns(df, JOBS)
    return full.withColumn("status", F.when(F.col("status") == LEGACY_READY, "to_run").otherwise(F.col("status")))


def migrate_multi_spin(df: DataFrame, version: int) -> tuple[DataFrame, int]:
    """The multi-spin table at the newest version. A table newer than this code is an error."""
    if version > MULTI_SPIN_VERSION:
        raise ValueError(f"table version {version} is newer than {MULTI_SPIN_VERSION}")
    return with_missing_columns(df, MULTI_SPIN), MULTI_SPIN_VERSION
