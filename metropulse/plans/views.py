"""Job results under names for SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def publish(tables: Mapping[str, DataFrame]) -> None:
    """Register each DataFrame as a temporary view; nothing is computed until a query reads it."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
