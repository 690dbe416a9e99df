"""Compute once for each distinct text: parsers run on distinct values and are joined back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def distinct_apply(df: DataFrame, keys: list[str], parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` with the columns that ``parse`` adds to the distinct values of ``keys`` (nulls are values).

    The parsed side is left to the planner: AQE broadcasts it when it turns out small, and splits hot keys when not.
    """
    parsed = parse(df.select(*keys).distinct())
    renamed = parsed
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_k_{k}")
    on = [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    return df.join(renamed, on, "left").drop(*[f"_k_{k}" for k in keys])
