"""Column-expression helpers. All of them are built-in Spark expressions (codegen, no Python rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> str:
    """Back-tick quote a column name that may hold spaces, brackets or ``%``."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    return F.col(q(name))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp (``timestamp_ntz`` is read as UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """B1: numeric columns in schema order; booleans are not numeric."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """B2: categorical (string) columns in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]

