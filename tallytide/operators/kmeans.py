"""K-means whose result depends on the data, the seed and nothing else.

Centres are drawn by hashes of the keys and moved by exact sums, so neither the layout of the rows
nor the order in which partial sums meet shows in the labels.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 20
#: Decimal digits that sums of coordinates keep, counted from the largest coordinate.
DIGITS = 15
#: Coordinates for which one task is enough.
TASK_VALUES = 1_000_000

_POINT = "__point"


class Fit(NamedTuple):
    """``centres`` in the order drawn, the ``cost`` (sum of squared distances to the nearest centre)
    before each round and at the end, and whether the last round moved no centre."""

    centres: list[list[float]]
    cost: list[float]
    settled: bool


def squared_distance(point: Column, centre: Sequence[float]) -> Column:
    gaps = F.zip_with(
        point, F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b)
    )
    return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)


def nearest(point: Column, centres: Sequence[Sequence[float]]) -> Column:
    """(gap, number) of the nearest centre; of equally near ones the first."""
    each = [F.struct(squared_distance(point, c).alias("gap"), F.lit(i).alias("number")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*each))


def draw(key: str, seed: int, turn: int) -> Column:
    """A number in (0, 1) that follows from the key, the seed and the turn."""
    name = F.concat_ws(":", F.col(key).cast("string"), F.lit(seed), F.lit(turn))
    digits = F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double")
    return (digits + 1) / float(2**48 + 1)


def _seeds(points: DataFrame, key: str, k: int, seed: int) -> list[list[float]]:
    """k-means++ as a race: each turn the row with the least ``-ln(u) / d`` wins, which picks a row
    with a chance in proportion to d, its squared distance to the nearest centre so far."""
    centres: list[list[float]] = []
    while len(centres) < k:
        far = nearest(F.col(_POINT), centres)["gap"] if centres else F.lit(1.0)
        runners = points.select(_POINT, key, far.alias("far")).filter("far > 0")
        won = runners.orderBy(-F.log(draw(key, seed, len(centres))) / F.col("far"), key).first()
        if won is None:
            break
        centres.append(list(won[_POINT]))
    return centres


def fit(points: DataFrame, key: str, k: int, seed: int, rows: int, rounds: int = MAX_ROUNDS) -> Fit:
    """Centres of ``points`` (key, ``__point`` as array<double>), ``rows`` many.

    Every round is one aggregate: rows take their nearest centre, and coordinates are summed as whole
    numbers of a fixed quantum per (centre, slot), combined inside the map tasks. k times the length
    of a point is what the driver sees of a round. A centre without rows stays where it is. Ends when
    no centre moves, or after ``rounds``. With fewer different points than k there are fewer centres.
    """
    widest = points.agg(
        F.max(F.size(_POINT)), F.max(F.array_max(F.transform(_POINT, lambda x: F.abs(x))))
    ).first()
    if widest[0] is None:
        return Fit([], [], True)
    tasks = max(1, rows * widest[0] // TASK_VALUES)
    points = points.coalesce(tasks)
    places = DIGITS - math.ceil(math.log10(widest[1])) if widest[1] else 0
    quantum = float(10**places) if places >= 0 else 1 / float(10**-places)
    centres, cost, settled = _seeds(points, key, k, seed), [], False
    for turn in range(rounds + 1):
        near = nearest(F.col(_POINT), centres)
        placed = points.select(near.alias("near"), _POINT)
        slots = placed.select("near.number", "near.gap", F.posexplode(_POINT).alias("slot", "value"))
        whole = F.round(F.col("value") * quantum).cast("decimal(20,0)")
        sums = slots.groupBy("number", "slot").agg(
            F.sum(whole).alias("total"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("slot") == 0, F.col("gap"))).alias("cost"),
        )
        found = sums.collect()
        cost.append(math.fsum(r["cost"] for r in found if r["cost"] is not None))
        moved = [list(c) for c in centres]
        for r in found:
            moved[r["number"]][r["slot"]] = float(r["total"] / r["n"]) / quantum
        settled = moved == centres
        if settled or turn == rounds:
            break
        centres = moved
    return Fit(centres, cost, settled)
