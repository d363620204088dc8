"""Metric registry and the layered scoreboard built on it.

A metric is a name and an aggregate: a Column expression or its SQL text over
the columns of the scored rows.  Whatever is registered can be asked for by name
in ``scoreboard``, on any grouping sets, without a change to this library:

    register_metric("mean_attempt", "round(avg(attempt), 6)")
    scoreboard(matched, ["hit_rate", "mean_attempt"], [("domain",), ()])

All metrics of a scoreboard are computed in one partially aggregated pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Metric = Callable[[], Column]
METRICS: dict[str, Metric] = {}


def register_metric(name: str, aggregate: Metric | str, replace: bool = False) -> None:
    """Register an aggregate under ``name``: SQL text, or a function without
    arguments that returns a Column (a Column needs a running session, so it is
    made when it is used)."""
    if name in METRICS and not replace:
        raise ValueError(f"metric {name} is registered already")
    METRICS[name] = aggregate if callable(aggregate) else (lambda: F.expr(aggregate))


def metric(name: str) -> Column:
    if name not in METRICS:
        raise KeyError(f"no metric {name}; registered are {', '.join(sorted(METRICS))}")
    return METRICS[name]().alias(name)


def scoreboard(scored: DataFrame, names: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """The named metrics for every group of every grouping set.  ``gid`` is the
    grouping id over the dimensions in the order of their first appearance (bit
    set: the dimension is summed over), so a null dimension value and a subtotal
    can be told apart."""
    dims = list(dict.fromkeys(d for s in sets for d in s))
    if not dims:
        return scored.agg(F.lit(0).cast("long").alias("gid"), *[metric(n) for n in names])
    return scored.groupingSets([[F.col(d) for d in s] for s in sets], *dims).agg(
        F.grouping_id().cast("long").alias("gid"), *[metric(n) for n in names])


for _name, _sql in {
    "n_candidates": "count(1)",
    "n_prompts": "count(DISTINCT prompt_id)",
    "n_hits": "CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT)",
    "hit_rate": "round(avg(CASE WHEN hit THEN 1 ELSE 0 END), 6)",
    "first_hit": "min(CASE WHEN hit THEN attempt END)",
    # accuracy and F1 over rows with sorted letter arrays pred and gold
    "accuracy": "round(avg(CASE WHEN array_join(pred, ',') = array_join(gold, ',') THEN 1 ELSE 0 END), 6)",
    "macro_f1": "round(avg(CASE WHEN size(pred) + size(gold) = 0 THEN 1.0D ELSE "
                "2.0D * size(array_intersect(pred, gold)) / (size(pred) + size(gold)) END), 6)",
}.items():
    register_metric(_name, _sql)
