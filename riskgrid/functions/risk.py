"""Risk levels and feature documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the two upper risk levels.
MEDIUM_RISK = 0.5
HIGH_RISK = 0.75


def risk_category(score: Column, medium: float = MEDIUM_RISK, high: float = HIGH_RISK) -> Column:
    return F.when(score >= high, "High").when(score >= medium, "Medium").otherwise("Low")


def as_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
