"""A one-row table as a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct scalar subquery; null when ``df`` is empty."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()
