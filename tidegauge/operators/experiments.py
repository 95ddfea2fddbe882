"""Experiment assignment and column mapping of data exports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.filters import conjunction
from tidegauge.schemas import Filter


def _criteria(raw: Any) -> list[Filter]:
    """Filter list, or a map of field to value(s) as user searches have it."""
    if isinstance(raw, Mapping):
        return [Filter(k, "IN" if isinstance(v, (list, tuple)) else "EQ", v) for k, v in raw.items()]
    return [f if isinstance(f, Filter) else Filter(f["name"], f["operator"], f.get("value")) for f in raw]


def assign_experiments(population: DataFrame, id_column: str, experiments: Iterable[Mapping[str, Any]]) -> DataFrame:
    """One row per member and experiment it qualifies for.

    An experiment has an id, criteria and, for split experiments, a modulus: members whose id hash (the
    first eight hex digits of its MD5) leaves remainder 0 take part. All experiments are decided in one pass over the population.
    """
    entries: list[Column] = []
    for experiment in experiments:
        criteria = experiment["criteria"]
        condition = conjunction(population, _criteria(criteria.get("filters", ())))
        condition = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
        if criteria.get("modulus"):
            number = F.conv(F.substring(F.md5(F.col(id_column).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
            condition = condition & (number % F.lit(int(criteria["modulus"])) == 0)
        entries.append(F.when(condition, F.lit(experiment["experiment_id"])))
    chosen = F.array_compact(F.array(*entries)) if entries else F.array().cast("array<string>")
    return population.select(F.col(id_column), F.explode(chosen).alias("experiment_id"))


def export_columns(
    df: DataFrame,
    mapping: Mapping[str, str],
    hidden: Iterable[str] = (),
    functions: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Rename, hide and convert columns; columns without an entry keep their name."""
    functions, hidden = functions or {}, set(hidden)
    chosen = []
    for name in df.columns:
        if name not in hidden:
            column = F.col(f"`{name}`")
            chosen.append(functions.get(name, lambda c: c)(column).alias(mapping.get(name, name)))
    return df.select(*chosen)

