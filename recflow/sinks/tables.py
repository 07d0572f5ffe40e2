"""Stored tables. A write is complete or not seen; see ``recflow.manifest``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recflow.manifest import write_version


def write_snapshot(df: DataFrame, path: str, run_date: str) -> None:
    """Store one day. A second run replaces that day, also by no rows, and leaves the others."""
    write_version(df.drop("date"), f"{path.rstrip('/')}/date={run_date}")


def write_table(df: DataFrame, path: str) -> None:
    """Store a table without days, replacing what was there; ``sources.read_table`` reads it."""
    write_version(df, path.rstrip("/"))
