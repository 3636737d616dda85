"""Where callers plug in their own code: checks of a directory, set-up of a job, extractors of a text.

A hook is an importable function, run in batches on the executors; its result is a column. Lambdas and nested functions
are refused here, before any task starts, because they can't be named in a log or found again by a later run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def importable(fn: Callable) -> Callable:
    if not callable(fn) or "<" in getattr(fn, "__qualname__", "<"):
        raise ValueError(f"a hook must be a function at the top of a module: {fn!r}")
    return fn


def check_directories(dirs: DataFrame, check: Callable[[str], int], column: str = "job_dir") -> DataFrame:
    """dirs with ``code`` from the caller's check of each directory name; a check that raises gives 0 and an ``error``."""
    importable(check)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, errors = [], []
            for value in pdf[column]:
                try:
                    codes.append(int(check(value)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  the caller's code may raise anything
                    codes.append(0)
                    errors.append(f"{type(e).__name__}: {e}"[:200])
            yield pdf.assign(code=codes, error=errors)

    schema = T.StructType([*dirs.schema.fields, T.StructField("code", T.IntegerType()), T.StructField("error", T.StringType())])
    return dirs.mapInPandas(run, schema)


def set_up(jobs: DataFrame, setup: Callable[[str, dict], None], column: str = "job_dir") -> DataFrame:
    """(id, ok, error) after the caller's set-up of each job's directory, given its row as a dictionary."""
    importable(setup)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    setup(row[column], row)
                    out.append((row["id"], True, None))
                except Exception as e:  # noqa: BLE001
                    out.append((row["id"], False, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(out, columns=["id", "ok", "error"])

    return jobs.mapInPandas(run, "id long, ok boolean, error string")


class Extractors:
    """Named column expressions over a text; ``apply`` adds them all to one scan."""

    def __init__(self) -> None:
        self.known: dict[str, Callable] = {}

    def register(self, name: str, expression: Callable) -> None:
        if name in self.known:
            raise ValueError(f"extractor {name!r} is there already")
        self.known[name] = expression

    def apply(self, texts: DataFrame, column: str = "text") -> DataFrame:
        return texts.withColumns({name: e(F.col(column)) for name, e in self.known.items()})
