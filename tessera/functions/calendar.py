"""Calendar labels (#44-45)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_of_year(ts) -> Column:
    """``Apr_2016``: English month abbreviation, underscore, four-digit year."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "MMM_yyyy")


def day_of_week(ts) -> Column:
    """Full English day name, e.g. ``Monday``."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "EEEE")


def calendar_labels(df: DataFrame, ts: str, drop: bool = False) -> DataFrame:
    """Add ``monthofyear`` and ``dayofweek`` from a timestamp column; optionally drop the timestamp."""
    out = df.withColumn("monthofyear", month_of_year(ts)).withColumn("dayofweek", day_of_week(ts))
    return out.drop(ts) if drop else out
