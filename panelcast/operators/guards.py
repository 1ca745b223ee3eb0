"""Input guards (schema-only or one tiny job)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise ValueError listing the missing names (schema check, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def require_non_empty(df: DataFrame) -> None:
    """Raise ValueError on an empty input (a limit-1 job)."""
    if df.isEmpty():
        raise ValueError("Input DataFrame is empty")


def require_periods(n_available: int, n_needed: int) -> None:
    if n_available < n_needed:
        raise ValueError(f"Insufficient data: need {n_needed} months, have {n_available}.")
