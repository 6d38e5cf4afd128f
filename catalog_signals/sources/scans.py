"""Normalising scans: column selection, tolerant casts, one spelling for keys.

Only the columns used further on are selected, so Parquet reads no others; a ``clients`` list of some
thousands becomes a pushed-down predicate, a longer one a semi-join.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.config import FLAGS
from catalog_signals.functions.casts import (
    is_true,
    parse_money,
    safe_bigint,
    safe_timestamp,
    strict_bigint,
)

#: Which clients a run is for: names, names in a text, a DataFrame with one column of names, or all.
Clients = str | Iterable[str] | DataFrame | None


#: Names that become literals of a predicate; the time to plan grows with them.
MOST_LISTED = 2000


def requested_clients(explicit: Clients = None, fallback: Clients = None) -> list[str] | DataFrame | None:
    """The explicit clients if there are any, else the fallback, else ``None`` for every client.

    Text is split at commas; entries are stripped and blank ones dropped. A DataFrame stays one.
    """
    for wanted in (explicit, fallback):
        if isinstance(wanted, DataFrame):
            return wanted
        if wanted:
            entries = wanted.split(",") if isinstance(wanted, str) else wanted
            return list(dict.fromkeys(c.strip() for c in entries if c.strip()))
    return None


def of_clients(df: DataFrame, clients: Clients, column: str) -> DataFrame:
    """Rows of the given clients; for ``None`` of every client. A row without a client is no one's.

    Up to ``MOST_LISTED`` names become a predicate that reaches the scan. More names, or a DataFrame of
    names, are semi-joined; of a list, its first and last name reach the scan as bounds. Spark knows the
    size of a list, a local table, and broadcasts it if that is under its threshold. Beyond that both
    sides are shuffled, and adaptive execution splits a client that holds very many rows.

    Saying so here, rather than leaving it to the joins that imply it, gives all branches of a plan
    the same scan, which Spark then reads and shuffles once (ReusedExchange).
    """
    wanted = requested_clients(clients)
    if wanted is None:
        return df.where(F.col(column).isNotNull())
    if isinstance(wanted, DataFrame):
        names = wanted.select(F.col(wanted.columns[0]).alias("_wanted"))
        return df.join(names, F.col(column) == F.col("_wanted"), "left_semi")
    if len(wanted) <= MOST_LISTED:
        return df.where(F.col(column).isin(wanted))
    names = df.sparkSession.createDataFrame(pa.table({"_wanted": pa.array(wanted, pa.string())}))
    # code point order, as Spark compares texts by their UTF-8 bytes
    within = df.where(F.col(column).between(min(wanted), max(wanted)))
    return within.join(names, F.col(column) == F.col("_wanted"), "left_semi")


def flag_columns(df: DataFrame) -> list[Column]:
    return [safe_bigint(df, flag).alias(f"API_{flag}") for flag in FLAGS]


def scan_merged_service_types(df: DataFrame, clients: Clients = None) -> DataFrame:
    return of_clients(df, clients, "clientID").select(
        F.col("clientID").alias("clientId"),
        strict_bigint("typeID").alias("TYPE_ID"),
        F.col("description").alias("DESCRIPTION"),
    )


def scan_visits(df: DataFrame, clients: Clients = None) -> DataFrame:
    return of_clients(df, clients, "clientID").select(
        F.col("clientID").alias("clientId"),
        safe_bigint(df, "type").alias("TYPE_ID"),
        F.col("individualAccountID").alias("accountId"),
        safe_timestamp(df, "appointmentDate").alias("visitDate"),
    )


def scan_subscriptions(df: DataFrame, clients: Clients = None) -> DataFrame:
    """Subscriptions with their amount as a number. Amounts are parsed only where they are used:
    Catalyst drops the column, and its parsing, from plans that need presence alone. Without the
    column there are no amounts, hence no revenue, and everything else goes on."""
    if "annualRecurringServices" not in df.columns:
        df = df.withColumn("annualRecurringServices", F.lit(None).cast("string"))
    return of_clients(df, clients, "clientID").select(
        F.col("clientID").alias("clientId"),
        F.col("subscriptionID").alias("subscriptionId"),
        safe_bigint(df, "serviceID").alias("TYPE_ID"),
        F.col("annualRecurringServices").cast("string").alias("amountText"),
        parse_money(df, "annualRecurringServices").alias("amount"),
        (is_true(df, "active") & F.col("dateCancelled").isNull()).alias("isActive"),
    )


def scan_lookup(df: DataFrame, clients: Clients = None) -> DataFrame:
    return of_clients(df, clients, "clientId").select(
        "clientId", "serviceType", F.col("isRecurring").cast("string").alias("isRecurring")
    )
