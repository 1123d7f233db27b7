"""Sampling a corpus to target shares by iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.llm.common import driver_table, unit_hash, written
from tallytide.operators.sizing import lookup_join

SMOOTHING = 0.5
KEEP_SHARE = 0.7
MAX_SWEEPS = 20
TOLERANCE = 1e-4
NULL_NAME = "\x00null"
#: How far above its tokens the weight of a cell may rise while weights are bounded.
HIGHEST = 1e6
#: Up to so many cells the bounded sweeps run on the driver, where a sweep costs no job.
CELLS_ON_DRIVER = 100_000


def word_count(text: Column) -> Column:
    """Words between white space, the weight of a document.

    Each word becomes one letter and the letters are counted: ``regexp_count`` would hold all words
    of a text in memory at once.
    """
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+", "")
    return F.length(F.regexp_replace(inner, r"\S+\s*", "x")).cast("bigint")


def layout_topic(text: Column) -> Column:
    """A coarse topic by form, for corpora without topic labels."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    marks = F.length(F.regexp_replace(text, r"[^%$#&*|<>{}\[\]=_~^]+", ""))
    return (
        F.when(F.length(F.trim(text)) == 0, "empty")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(marks * 50 > size, "markup")
        .when(F.length(text) < 500, "short")
        .otherwise("prose")
    )


def _targets(
    cells: DataFrame, dim: str, given: Mapping[str, float] | None, smoothing: float
) -> DataFrame:
    """(dim, target): given shares, or observed token shares raised to ``smoothing``; sum 1."""
    seen = cells.groupBy(dim).agg(F.sum("tokens").alias("tokens"))
    if given is None:
        power = F.pow(F.col("tokens").cast("double"), F.lit(smoothing))
        raw = seen.select(dim, F.when(F.col("tokens") > 0, power).otherwise(0.0).alias("target"))
    else:
        spark = cells.sparkSession
        stated = driver_table(
            spark,
            [(NULL_NAME if k is None else k, float(v)) for k, v in given.items()],
            f"{dim} string, target double",
        )
        raw = lookup_join(seen, stated, dim).select(dim, "target")
    raw = written(raw, "targets")
    total = raw.agg(F.sum("target")).first()[0] or 1.0
    return raw.withColumn("target", F.col("target") / F.lit(total))


def rake(
    cells: DataFrame,
    dims: Sequence[str],
    targets: Mapping[str, Mapping[str, float]] | None = None,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """Adds ``weight`` to cells (dims, tokens): token weights that meet each dimension's target.

    One sweep scales the weights to each dimension in turn; sweeps end when no cell moved by more
    than ``TOLERANCE`` of its weight, or after ``MAX_SWEEPS``, since targets that contradict the
    empty cells cannot all be met. Weights sum to 1. All of it runs on the table of cells, which may
    have any number of sources.
    """
    return _raked(cells, dims, _wanted(cells, dims, targets, smoothing))


def _wanted(
    cells: DataFrame,
    dims: Sequence[str],
    targets: Mapping[str, Mapping[str, float]] | None,
    smoothing: float,
) -> dict[str, DataFrame]:
    return {d: _targets(cells, d, (targets or {}).get(d), smoothing) for d in dims}


def _raked(cells: DataFrame, dims: Sequence[str], wanted: Mapping[str, DataFrame]) -> DataFrame:
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    fitted = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for _ in range(MAX_SWEEPS):
        moved = fitted.withColumn("before", F.col("weight"))
        for dim in dims:
            sums = moved.groupBy(dim).agg(F.sum("weight").alias("sum"))
            ratio = sums.join(wanted[dim], dim, "left").select(
                dim,
                F.when(F.col("sum") > 0, F.coalesce("target", F.lit(0.0)) / F.col("sum"))
                .otherwise(0.0)
                .alias("ratio"),
            )
            moved = moved.join(ratio, dim).withColumn("weight", F.col("weight") * F.col("ratio"))
            moved = moved.drop("ratio")
        moved = written(moved, "raked")
        step = F.abs(F.col("weight") - F.col("before")) > F.lit(TOLERANCE) * F.col("before")
        done = moved.filter(step).isEmpty()
        fitted = moved.drop("before")
        if done:
            break
    return fitted


def _rate(cells: DataFrame, budget: float) -> float:
    """The rate r for which the sum of tokens * min(1, r * factor) is the budget.

    Each step fixes the cells already at probability 1 and spreads what is left over the others.
    """
    rate = 0.0
    while True:
        full = F.col("factor") * F.lit(rate) >= 1
        sums = cells.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("factor"))).alias("open"),
        ).first()
        if not sums["open"] or sums["fixed"] >= budget:
            return rate
        found = (budget - sums["fixed"]) / sums["open"]
        if found <= rate * (1 + 1e-12):
            return rate
        rate = found


def _goals(
    cells: DataFrame, dims: Sequence[str], wanted: Mapping[str, DataFrame], budget: float
) -> tuple[dict[str, DataFrame], float]:
    """Per dimension (dim, goal): the tokens to sample of each value, and the budget they sum to.

    A value gives no more than all its tokens. What its target asks beyond goes to the other values
    in proportion to theirs. The budget falls to what the values with a target hold, if that is less.
    """
    sides = {}
    for dim in dims:
        seen = cells.groupBy(dim).agg(F.sum("tokens").alias("tokens")).join(wanted[dim], dim)
        factor = F.when(F.col("tokens") > 0, F.col("target") / F.col("tokens")).otherwise(0.0)
        sides[dim] = written(seen.withColumn("factor", factor), "sides")
        held = sides[dim].filter("factor > 0").agg(F.sum("tokens")).first()[0]
        budget = min(budget, float(held or 0))
    goals = {}
    for dim, side in sides.items():
        share = F.least(F.lit(1.0), F.col("factor") * F.lit(_rate(side, budget)))
        goals[dim] = side.select(dim, (F.col("tokens") * share).alias("goal"))
    return goals, budget


def _bounded(
    fitted: DataFrame, dims: Sequence[str], goals: Mapping[str, DataFrame], budget: float
) -> DataFrame:
    """Raked cells with ``probability``, at most 1, by which each dimension's goals are expected.

    Raking goes on with a bound: a cell counts with its weight but no more than its tokens. A sweep
    takes one step to each dimension's goals. Below a goal only the cells under the bound can give
    more, and the step, which spreads the rest over them, never goes too far; above a goal all cells
    of the value are scaled, which never goes too far either. Sweeps end when no probability moved by
    more than ``TOLERANCE``, or after ``MAX_SWEEPS``: goals of several dimensions that no sample has
    together cannot all be met, and the last dimension comes nearest. The rate then restores the
    budget. Sweeps are the same on the driver, for ``CELLS_ON_DRIVER`` cells at most, and as jobs.
    """
    few = fitted.limit(CELLS_ON_DRIVER + 1).count() <= CELLS_ON_DRIVER
    bounded = (_swept_here if few else _swept)(fitted, dims, goals, budget)
    lift = F.when(F.col("tokens") > 0, F.col("open") / F.col("tokens")).otherwise(0.0)
    lifted = bounded.withColumn("lift", lift).drop("open")
    rate = _rate(lifted.select("tokens", F.col("lift").alias("factor")), budget)
    return lifted.withColumn("probability", F.least(F.lit(1.0), F.col("lift") * F.lit(rate)))


def _swept_here(
    fitted: DataFrame, dims: Sequence[str], goals: Mapping[str, DataFrame], budget: float
) -> DataFrame:
    rows = fitted.collect()
    tokens = np.array([r["tokens"] for r in rows], dtype=float)
    weight = np.array([r["weight"] for r in rows], dtype=float) * budget
    sides = []
    for dim in dims:
        goal = {r[dim]: r["goal"] for r in goals[dim].collect()}
        place = {value: i for i, value in enumerate({r[dim] for r in rows})}
        at = np.array([place[r[dim]] for r in rows], dtype=int)
        sides.append((at, np.array([goal.get(value) or 0.0 for value in place])))
    for _ in range(MAX_SWEEPS):
        before = np.minimum(weight, tokens)
        for at, goal in sides:
            full = weight >= tokens
            fixed = np.bincount(at, np.where(full, tokens, 0.0), len(goal))
            rest = np.bincount(at, np.where(full, 0.0, weight), len(goal))
            given = fixed + rest
            ratio = np.ones(len(goal))
            np.divide(goal - fixed, rest, out=ratio, where=rest > 0)
            np.divide(goal, given, out=ratio, where=given > goal)
            weight = np.minimum(weight * ratio[at], tokens * HIGHEST)
        if (np.abs(np.minimum(weight, tokens) - before) <= TOLERANCE * tokens).all():
            break
    swept = [(*r, w) for r, w in zip(rows, weight.tolist(), strict=True)]
    schema = fitted.withColumn("open", F.lit(0.0)).schema
    return written(driver_table(fitted.sparkSession, swept, schema), "bounded")


def _swept(
    fitted: DataFrame, dims: Sequence[str], goals: Mapping[str, DataFrame], budget: float
) -> DataFrame:
    bounded = fitted.withColumn("open", F.col("weight") * F.lit(budget))
    for _ in range(MAX_SWEEPS):
        moved = bounded.withColumn("before", F.least("open", "tokens"))
        for dim in dims:
            full = F.col("open") >= F.col("tokens")
            sums = moved.groupBy(dim).agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("fixed"),
                F.sum(F.when(full, 0.0).otherwise(F.col("open"))).alias("rest"),
            )
            given = F.col("fixed") + F.col("rest")
            goal = F.coalesce("goal", F.lit(0.0))
            ratio = sums.join(goals[dim], dim, "left").select(
                dim,
                F.when(given > goal, goal / given)
                .when(F.col("rest") > 0, (goal - F.col("fixed")) / F.col("rest"))
                .otherwise(1.0)
                .alias("ratio"),
            )
            raised = F.least(F.col("open") * F.col("ratio"), F.col("tokens") * F.lit(HIGHEST))
            moved = moved.join(ratio, dim).withColumn("open", raised).drop("ratio")
        moved = written(moved, "bounded")
        step = F.abs(F.least("open", "tokens") - F.col("before"))
        done = moved.filter(step > F.lit(TOLERANCE) * F.col("tokens")).isEmpty()
        bounded = moved.drop("before")
        if done:
            break
    return bounded


def mix(
    docs: DataFrame,
    dims: Mapping[str, Column],
    tokens: Column,
    keep_share: float = KEEP_SHARE,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    smoothing: float = SMOOTHING,
    seed: int = 42,
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with the dimensions, n_tokens, factor, probability and sampled.

    ``dims`` names the marginals (source, language, topic) and how each row gets its value. Token
    weights are raked to ``targets`` per dimension; without any, to the observed shares raised to
    ``smoothing``, which lifts small sources. ``factor`` is a cell's raked over its observed weight.

    ``keep_share`` of all tokens is expected to be sampled. Since no document is taken twice, a value
    whose target is more than all its tokens gives these, and the rest of its target goes to the
    others of its dimension; cells are raked again to the shares that are left, with a probability
    of at most 1 (``_bounded``). ``shares`` has the target beside what is expected and sampled. A
    document is sampled when a hash of id and seed lies below its cell's probability.

    A null dimension value is a value of its own. Null and empty texts have no tokens and take their
    cell's probability, which is ``keep_share`` in a cell without any tokens. Rows that repeat an id are sampled together, null ids like one id. Columns
    of the same names as the added ones are replaced. An empty table gives an empty result.
    """
    filled = {d: F.coalesce(c.cast("string"), F.lit(NULL_NAME)) for d, c in dims.items()}
    marked = {f"__{d}": c for d, c in filled.items()} | {"__tokens": tokens}
    rows = docs.withColumns(marked)
    names = list(marked)[:-1]
    cells = written(
        rows.groupBy(*names).agg(F.sum("__tokens").alias("tokens"), F.count("*").alias("docs")),
        "cells",
    )
    stated = {f"__{d}": t for d, t in (targets or {}).items()}
    wanted = _wanted(cells, names, stated, smoothing)
    fitted = _raked(cells, names, wanted)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(total or 1))
    fitted = fitted.withColumn(
        "factor", F.when(F.col("tokens") > 0, F.col("weight") / share).otherwise(1.0)
    )
    goals, budget = _goals(cells, names, wanted, keep_share * total)
    fitted = _bounded(fitted, names, goals, budget)
    bare = F.lit(float(min(keep_share, 1.0)))
    side = fitted.select(
        *names,
        F.col("factor").alias("__factor"),
        F.when(F.col("tokens") > 0, F.col("probability")).otherwise(bare).alias("__probability"),
        F.col("docs").alias("__docs"),
    )
    joined = lookup_join(rows, side, names, rows="__docs")
    draw = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    added = {d: F.nullif(F.col(f"__{d}"), F.lit(NULL_NAME)) for d in dims} | {
        "n_tokens": F.col("__tokens"),
        "factor": F.col("__factor"),
        "probability": F.col("__probability"),
        "sampled": unit_hash(draw, seed=seed) < F.col("__probability"),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    return joined.select(*kept, *[c.alias(n) for n, c in added.items()])


def sample_mix(docs: DataFrame, dims: Mapping[str, Column], tokens: Column, **options) -> DataFrame:
    """The sampled rows of ``docs`` with their own columns."""
    wanted = {f"__mix_{d}": c for d, c in dims.items()}
    mixed = mix(docs, wanted, tokens, **options)
    return mixed.filter("sampled").select(*[F.col(f"`{c}`") for c in docs.columns])


def shares(
    mixed: DataFrame,
    dims: Sequence[str],
    targets: Mapping[str, Mapping[str, float]] | None = None,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """(dimension, value, observed, target, expected, sampled): token shares of a result of ``mix``.

    ``targets`` and ``smoothing`` are those it was mixed with. ``expected`` follows from the
    probabilities, ``sampled`` from the draw; all four sum to 1 over the values of a dimension.
    """
    parts = []
    for dim in dims:
        tokens = F.col("n_tokens")
        sums = written(
            mixed.groupBy(F.coalesce(F.col(dim).cast("string"), F.lit(NULL_NAME)).alias("value")).agg(
                F.sum(tokens).alias("tokens"),
                F.sum(tokens * F.col("probability")).alias("expected"),
                F.sum(F.when(F.col("sampled"), tokens).otherwise(0)).alias("sampled"),
            ),
            "shares",
        )
        wanted = _targets(sums, "value", (targets or {}).get(dim), smoothing)
        totals = sums.agg(*[F.sum(c).alias(c) for c in sums.columns[1:]]).first()
        share = {c: F.col(c) / F.lit(float(totals[c] or 1)) for c in sums.columns[1:]}
        parts.append(
            sums.join(wanted, "value", "left").select(
                F.lit(dim).alias("dimension"),
                F.nullif(F.col("value"), F.lit(NULL_NAME)).alias("value"),
                share["tokens"].alias("observed"),
                F.coalesce("target", F.lit(0.0)).alias("target"),
                share["expected"].alias("expected"),
                share["sampled"].alias("sampled"),
            )
        )
    return reduce(DataFrame.unionAll, parts)
