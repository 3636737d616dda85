"""Where queries and their DuckDB equivalents are registered, and the views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: The job table that orders stand for; the same expressions in both engines.
JOB_COLUMNS = (
    "o_orderkey AS id",
    "o_orderkey AS orig_index",
    "o_custkey AS grp",
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'to_run' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'failed' ELSE 'timeout' END END AS status",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 31 END AS fail_count",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 1000000 END AS max_forces",
    "-o_totalprice AS final_energy",
    "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey % 120 END AS scf_steps",
    "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 3600 AS DOUBLE) END AS wall_time",
    "CAST(1 + o_orderkey % 16 AS INTEGER) AS n_cores",
    "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat('w', o_orderkey % 50) END AS worker_id",
    "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('/data/run/job_', o_orderkey) END AS job_dir",
    "CASE WHEN o_orderkey % 8 = 0 THEN 'old' END AS error_message",
    "CAST(NULL AS STRING) AS generator_data",
)
JOBS = "jobs AS (SELECT " + ", ".join(JOB_COLUMNS) + " FROM orders)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*JOB_COLUMNS)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; its SQL may use the view ``jobs``."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = f"WITH {JOBS} {sql}" if "jobs" in sql else sql
        return fn

    return register
