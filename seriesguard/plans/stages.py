"""Materialised stage tables shared by the queries of one session (a small feature store, A8).

A stage is written once per application, data folder, state of its files and stage name, under the shared checkpoint
folder, and read back by every query that needs it; its lineage is cut, so a lost executor re-reads it. A changed table
gives the folder another fingerprint, and so new stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seriesguard.session import drop_tables, fingerprint, materialize

_STAGES: dict[tuple[str, str, str, str], object] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]) -> object:
    key = (spark.sparkContext.applicationId, sf_dir, fingerprint(spark, sf_dir), name)
    if key not in _STAGES:
        value = build()
        if isinstance(value, DataFrame):
            value = materialize(value, name)
        _STAGES[key] = value
    return _STAGES[key]


def clear(spark: SparkSession | None = None) -> None:
    """Forget all stages; with a session, remove their tables as well."""
    _STAGES.clear()
    if spark is not None:
        drop_tables(spark)
