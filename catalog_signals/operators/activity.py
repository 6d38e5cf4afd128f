"""Is a type in use? Recent visits and active subscriptions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.config import DEFAULTS, Params
from catalog_signals.functions.casts import years_before

_TYPE = ["clientId", "TYPE_ID"]


def _flag_presence(types: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """``present`` holds unique keys, so the join neither multiplies rows nor skews."""
    marked = present.withColumn(name, F.lit(True))
    return types.join(marked, _TYPE, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def recent_activity(
    types: DataFrame, visits: DataFrame, as_of: dt.datetime | str, params: Params = DEFAULTS
) -> DataFrame:
    """Adds ``recent``: a visit on or after ``as_of`` minus the activity window, future ones
    included. The bound reaches the Parquet scan where dates are stored as zone-less timestamps; texts
    have to be parsed first."""
    cutoff = years_before(as_of, params.activity_years)
    present = visits.where(F.col("visitDate") >= cutoff).select(*_TYPE).distinct()
    return _flag_presence(types, present, "recent")


def active_subscription(types: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Adds ``active``: a subscription that is active and not cancelled."""
    present = subscriptions.where("isActive").select(*_TYPE).distinct()
    return _flag_presence(types, present, "active")


def expired_flag(df: DataFrame) -> DataFrame:
    """Adds ``expired``: no recent visit or no active subscription."""
    return df.withColumn("expired", ~F.col("recent") | ~F.col("active"))
