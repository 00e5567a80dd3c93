"""Counting points below and left of corners, for each group on its own, without pairs.

A point has two days and a weight, a corner two days; the answer of a corner is the
weight of the points of its group with both days at or before the corner's. Each
group is sorted by the second day and swept once: rows of a task arrive in that order as Arrow
batches, points of a batch are counted for its corners by halving, and points of earlier batches
by a running sum over distinct first days. A task holds one batch and the distinct
first days of the group it is in, whatever the number of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType


def count_dominated(points: DataFrame, corners: DataFrame, group: list[str], carried: list[str]) -> DataFrame:
    """`corners` as (group, carried, below).

    `points` has the columns `group`, x, y and n (n not null, 0 or more), at best one row for each
    x and y of a group; `corners` has `group`, x, y and what is `carried`. x and y are integers
    and not null. A null in a group equals nothing: such corners have nothing below.
    """
    line = points.select(*group, "x", "y", F.col("n").cast("long").alias("n"), F.lit(False).alias("_corner")).unionByName(
        corners.select(*group, "x", "y", F.lit(0).cast("long").alias("n"), F.lit(True).alias("_corner"), *carried), allowMissingColumns=True
    )
    found = StructType([line.schema[c] for c in (*group, *carried)]).add("below", LongType(), False)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        days, sums, last = np.empty(0, np.int64), np.empty(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            number = _group_numbers(batch, group, last)
            x = batch.column("x").to_numpy(zero_copy_only=False).astype(np.int64)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            corner = batch.column("_corner").to_numpy(zero_copy_only=False)
            below = _below_in_batch(number, x, n, corner)
            goes_on = number == 0
            if len(days):
                at = np.searchsorted(days, x[goes_on], side="right")
                below[goes_on] += np.concatenate(([0], sums))[at]
            mine = (number == number[-1]) & ~corner
            if number[-1]:
                days, sums = np.empty(0, np.int64), np.empty(0, np.int64)
            days, sums = _added(days, sums, x[mine], n[mine])
            last = batch.slice(batch.num_rows - 1).select(group)
            answered = batch.select([*group, *carried]).append_column(pa.field("below", pa.int64(), False), pa.array(below))
            yield answered.filter(pa.array(corner))

    ordered = line.repartition(*group).sortWithinPartitions(*group, "y", "_corner")
    return ordered.mapInArrow(sweep, found)


def _group_numbers(batch: pa.RecordBatch, group: list[str], last: pa.RecordBatch | None) -> np.ndarray:
    """The number of each row's group within its batch: 0 is the group that the batch before ended in."""
    fresh = np.zeros(batch.num_rows, bool)
    fresh[0] = last is None
    for name in group:
        column = batch.column(name)
        fresh[1:] |= _differs(column[1:], column[:-1])
        if last is not None:
            fresh[0] |= _differs(column[:1], last.column(name))[0]
    return np.cumsum(fresh)


def _differs(one: pa.Array, other: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.not_equal(one, other), True).to_numpy(zero_copy_only=False)


def _below_in_batch(number: np.ndarray, x: np.ndarray, n: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """For each row, the weight of earlier rows of its group whose x is not above its own.

    Rows are in order of groups, so among all earlier rows those of smaller groups are counted
    whole and taken off. Counting is by halving: at each size, left halves count for right ones.
    """
    size = len(x)
    by_value = np.lexsort((corner, x, number))
    whole = np.concatenate(([0], np.cumsum(n)))
    below = -whole[np.searchsorted(number, number, side="left")]
    place = np.arange(size)
    half = 1
    while half < size:
        order = by_value[np.argsort(by_value // (2 * half), kind="stable")]
        left = (order // half) % 2 == 0
        running = np.concatenate(([0], np.cumsum(np.where(left, n[order], 0))))
        start = order // (2 * half) * (2 * half)
        right = ~left
        below[order[right]] += (running[place] - running[start])[right]
        half *= 2
    return below


def _added(days: np.ndarray, sums: np.ndarray, x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct days and running sums with further points."""
    if not len(x):
        return days, sums
    every, at = np.unique(np.concatenate((days, x)), return_inverse=True)
    weights = np.zeros(len(every), np.int64)
    np.add.at(weights, at, np.concatenate((np.diff(sums, prepend=0), n)))
    return every, np.cumsum(weights)
