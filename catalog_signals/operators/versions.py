"""Latest version of a row, and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_signals.config import FLAGS
from catalog_signals.functions.casts import strict_bigint
from catalog_signals.sources.scans import flag_columns

SERVICE_TYPE_COLUMNS = ["clientId", "TYPE_ID", "DESCRIPTION", *[f"API_{f}" for f in FLAGS]]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``, which must be total for a reproducible result.

    ``row_number() = 1`` lets Spark keep one row per key and task *before* the shuffle
    (WindowGroupLimit), so a key with a third of all rows sends at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def version_order(client: str) -> list[Column]:
    """Newest first; ties by owning client, description and flags, so that no tie is left open."""
    return [
        F.desc_nulls_last("DATE_LOADED"),
        F.asc_nulls_last(client),
        F.asc_nulls_last("DESCRIPTION"),
        *[F.asc_nulls_last(f"API_{flag}") for flag in FLAGS],
    ]


def latest_version(raw: DataFrame, client: str = "CLIENT") -> DataFrame:
    """Latest version per (owning client, TYPE_ID as stored), flags cast tolerantly, the id strictly.

    Keeps ``sourceClient`` and ``DATE_LOADED`` for a later dedupe across the sources of one client.
    """
    rows = raw.select(
        F.col(client).alias("clientId"),
        F.col("CLIENT").alias("sourceClient"),
        F.col("TYPE_ID").alias("_raw_id"),
        "DESCRIPTION",
        *flag_columns(raw),
        "DATE_LOADED",
    )
    newest = latest_by(rows, ["clientId", "sourceClient", "_raw_id"], version_order("sourceClient"))
    return newest.withColumn("TYPE_ID", strict_bigint("_raw_id")).select(
        *SERVICE_TYPE_COLUMNS, "sourceClient", "DATE_LOADED"
    )


def dedupe_types(versions: DataFrame) -> DataFrame:
    """One row per (client, TYPE_ID): the newest, then by source client and description."""
    return latest_by(versions, ["clientId", "TYPE_ID"], version_order("sourceClient"))


def latest_types(raw: DataFrame, client: str = "CLIENT") -> DataFrame:
    """``dedupe_types(latest_version(raw))`` in one window and one shuffle.

    Both steps keep the first row of the same total order, and the first of the firsts is the first.
    """
    rows = raw.select(
        F.col(client).alias("clientId"),
        strict_bigint("TYPE_ID").alias("TYPE_ID"),
        "DESCRIPTION",
        *flag_columns(raw),
        F.col("CLIENT").alias("sourceClient"),
        "DATE_LOADED",
    )
    return latest_by(rows, ["clientId", "TYPE_ID"], version_order("sourceClient"))
