"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows out evenly to ``partitions`` tasks before CPU-heavy
    work per row (JSON parsing, replication for range joins), for a caller
    who knows that the input has too few splits (one file, one row group).
    Without a number the frame is returned as it is. Building the plan never
    runs a job."""
    return df.repartition(partitions) if partitions else df
