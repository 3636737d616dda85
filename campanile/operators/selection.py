"""Greedy selections that depend on the order of rows."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Kept:
    """Frames of one shape that stay, found by their norms: frames within r of each other differ by r at most in norm."""

    def __init__(self, size: int) -> None:
        self.rows, self.norms, self.used = np.zeros((16, size)), [], 0

    def add_if_new(self, frame: np.ndarray, reach: float) -> bool:
        norm = float(np.sqrt(frame @ frame))
        slack = 1e-9 * (1 + norm)
        near = [i for _, i in self.norms[bisect_left(self.norms, (norm - reach - slack, -1)) : bisect_right(self.norms, (norm + reach + slack, self.used))]]
        if near and float(((self.rows[near] - frame) ** 2).sum(axis=1).min()) < reach * reach:
            return False
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = frame
        insort(self.norms, (norm, self.used))
        self.used += 1
        return True


def first_distinct(df: DataFrame, by: str, order: str, frames: str, threshold: float = 0.02) -> DataFrame:
    """Rows that stay of each group: one goes if an earlier one that stays has as many points and lies within the threshold (RMSD).

    frames: arrays of points. What stays depends on every row before, so a group's frames of one number of points are one task's; it reads them in
    order and holds only those that stay. A NULL frame, one without points, or with a missing coordinate always stays.
    """
    columns = df.columns
    size = F.coalesce(F.size(frames), F.lit(0))
    flat = F.transform(F.flatten(frames), lambda x: x.cast("double"))
    rows = df.select(F.struct(*columns).alias("row"), F.xxhash64(by, size).alias("group"), flat.alias("flat"), F.col(by).alias("by"), F.col(order).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, {}
        for batch in batches:
            stay = []
            for key, points in zip(batch.column(3).to_pylist(), batch.column(2), strict=True):
                if (key,) != last:
                    last, kept = (key,), {}
                frame = points.values.to_numpy(zero_copy_only=False) if points.is_valid else np.zeros(0)
                n = len(frame) // 3
                if not n or np.isnan(frame.astype(float)).any():
                    stay.append(True)
                else:
                    stay.append(kept.setdefault(n, _Kept(len(frame))).add_if_new(frame, threshold * n**0.5))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(stay, pa.bool_()))], ["row"])

    dealt = rows.repartition("group").sortWithinPartitions("by", "at").drop("group")
    held = dealt.select("row", "at", "flat", "by").mapInArrow(run, f"row {df.select(F.struct(*columns).alias('row')).schema['row'].dataType.simpleString()}")
    return held.select("row.*")
