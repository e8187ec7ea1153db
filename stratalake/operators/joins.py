"""Equi joins in which NULL keys meet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join group results on their keys, NULL groups included; keeps the left copy of the keys."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    met = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(renamed, met, how).drop(*[f"_r_{c}" for c in on])
