"""Suppression that holds against totals: no hidden count follows from the sums that are shown.

Counts stand in a table of times (months, their years, the whole time), sexes (each, and both) and ages
(each band, and all). A total is the sum of its parts along each side, so a small month hidden
alone is its year less the other months. Further cells are hidden until each hidden one lies in a
box of hidden cells: on each side of a box one can be added at the one place and taken away at another, or
added to a part and its totals, and all sums stay right. So other tables give the same
shown cells, with another value in that cell.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.operators.denominators import AGE_BANDS, SEXES

_ALL_AGES = (0, 150)


def protect_totals(monthly: DataFrame, keys: list[str], min_cell_count: int) -> DataFrame:
    """(keys, denom_id, cal_year, cal_month, outcome_count): months, years (cal_month null) and the whole time (both null).

    `monthly` has denom_id (strata as numbered by `denominators.strata`), cal_year, cal_month and
    outcome_count, at best one row for each. Counts above 0 and below `min_cell_count` are null, and so are the fewest
    further cells that protect each of them, of several such boxes that with the smallest counts. Rows with a null
    year, month, stratum or count are left out, other strata as well. A group is one table, at most strata x months
    of the calendar, however many people it counts.
    """
    strata = len(AGE_BANDS) * len(SEXES)
    known = monthly.filter(F.col("denom_id").between(1, strata)).dropna(subset=["cal_year", "cal_month", "outcome_count"])
    cells = known.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("denom_id").cast("int").alias("denom_id"),
        F.col("cal_year").cast("int").alias("cal_year"), F.col("cal_month").cast("int").alias("cal_month"),
        F.col("outcome_count").cast("long").alias("outcome_count"),
    )
    group = [f"_k{i}" for i in range(len(keys))]

    def protect(cells: pd.DataFrame) -> pd.DataFrame:
        months = sorted(set(zip(cells["cal_year"], cells["cal_month"], strict=True)))
        years = sorted({y for y, _ in months})
        times = [*months, *((y, 0) for y in years), (0, 0)]
        place = {t: i for i, t in enumerate(times)}
        table = np.full((len(times), len(AGE_BANDS), len(SEXES)), -1, np.int64)
        for y, m, d, n in zip(cells["cal_year"], cells["cal_month"], cells["denom_id"], cells["outcome_count"], strict=True):
            at = divmod(d - 1, len(SEXES))
            for t in ((y, m), (y, 0), (0, 0)):
                table[place[t]][at] = max(0, table[place[t]][at]) + n
        hidden = hidden_cells(table, time_lines(times), min_cell_count)
        t, a, s = np.nonzero(table >= 0)
        out = pd.DataFrame({g: [cells[g].iloc[0]] * len(t) for g in group})
        out["denom_id"] = a * len(SEXES) + s + 1
        for i, name in enumerate(("cal_year", "cal_month")):
            out[name] = pd.array([times[k][i] or None for k in t], "Int32")
        out["outcome_count"] = pd.array(np.where(hidden, -1, table)[t, a, s], "Int64")
        out.loc[out["outcome_count"] < 0, "outcome_count"] = pd.NA
        return out

    layout = cells.drop("denom_id", "outcome_count").schema.fields[: len(group)]
    ddl = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in layout), "denom_id int, cal_year int, cal_month int, outcome_count long"])
    found = cells.groupBy(*group).applyInPandas(protect, ddl)
    return found.withColumnsRenamed(dict(zip(group, keys, strict=True)))


def time_lines(times: list[tuple[int, int]]) -> list[list[dict[int, int]]]:
    """For each time the lines through it: places and signs of changes that leave all sums of times right."""
    place = {t: i for i, t in enumerate(times)}
    months: dict[int, list[int]] = {}
    for y, m in times:
        if m:
            months.setdefault(y, []).append(place[y, m])
    out = []
    for y, m in times:
        here, top = place[y, m], place[0, 0]
        if m:
            lines = [{here: 1, place[y, 0]: 1, top: 1}, *({here: 1, other: -1} for other in months[y] if other != here)]
        else:
            lines = [{part: 1, place[z, 0]: 1, top: 1} for z in ([y] if y else months) for part in months[z]]
        out.append(lines)
    return out


def _side_lines(parts: list[int], total: int) -> list[list[dict[int, int]]]:
    """The same for a side of parts and one total."""
    out: list[list[dict[int, int]]] = [[] for _ in range(len(parts) + 1)]
    for p in parts:
        out[p] = [{p: 1, total: 1}, *({p: 1, other: -1} for other in parts if other != p)]
    out[total] = [{p: 1, total: 1} for p in parts]
    return out


def hidden_cells(table: np.ndarray, lines: list[list[dict[int, int]]], at_least: int) -> np.ndarray:
    """Which cells of a table (time, age, sex; -1: no such cell) are hidden: small ones, and boxes around them.

    A box may only hold cells that exist, and a table with other counts, none below 0, must have the same sums:
    the box of a part and its totals on each side always does.
    """
    ages = _side_lines([b for b, band in enumerate(AGE_BANDS) if band != _ALL_AGES], AGE_BANDS.index(_ALL_AGES))
    widest = max(range(len(SEXES)), key=lambda s: len(SEXES[s]))
    sexes = _side_lines([s for s in range(len(SEXES)) if s != widest], widest)
    small = (table > 0) & (table < at_least)
    hidden = small.copy()
    for t, a, s in zip(*np.nonzero(small), strict=True):
        best, chosen = None, None
        for sides in product(lines[t], ages[a], sexes[s]):
            grid = np.ix_(*(list(side) for side in sides))
            counts = table[grid]
            if counts.min() < 0:
                continue
            signs = np.multiply.outer(np.multiply.outer(*(list(side.values()) for side in sides[:2])), list(sides[2].values()))
            if (signs < 0).any() and counts[signs > 0].min() < 1 and counts[signs < 0].min() < 1:
                continue
            further = ~hidden[grid]
            cost = int(further.sum()), int(counts[further].sum())
            if best is None or cost < best:
                best, chosen = cost, grid
            if cost[0] == 0:
                break
        if chosen is None:  # no totals are in the table that it could follow from
            continue
        hidden[chosen] = True
    return hidden
