"""Plan objects shared by the queries of one session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.hierarchy import HierarchyPlan
from ..sources import tables as T

_plans: dict[tuple[str, str], HierarchyPlan] = {}


def plan(spark: SparkSession, folder: str) -> HierarchyPlan:
    """One plan per session and folder, so its written tables are built once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _plans:
        _plans[key] = HierarchyPlan(T.pages_meta(spark, folder))
    return _plans[key]


def forget() -> None:
    """Drop the shared plans, so that the next query builds everything itself."""
    _plans.clear()
