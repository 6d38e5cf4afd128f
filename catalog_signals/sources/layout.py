"""Reduced inputs laid out by key, as bucketed tables that several reports start from.

All rows of a (client, type) lie in one bucket, whose number is the partition that a join or a window on
these keys asks for; so reports at any time, and with any parameters of resolution, join them without an
exchange. Inside a bucket rows are sorted by client, so that a predicate on clients skips row groups.
Every side has few rows per key, so no bucket holds the rows of a hot one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from catalog_signals.config import DEFAULTS, Params
from catalog_signals.plans.report import Reductions, Store, reduced_inputs
from catalog_signals.sources.scans import Clients
from catalog_signals.sources.tables import CatalogTables

_TYPE = ("clientId", "TYPE_ID")
_KEYS = {"versions": _TYPE, "history": _TYPE, "usage": _TYPE, "validation": _TYPE, "names": ("clientId", "serviceType")}


def bucketed(spark: SparkSession, prefix: str, buckets: int) -> Store:
    """Writes tables ``<prefix>_<name>``, one file per bucket, and reads them back."""

    def store(name: str, df: DataFrame) -> DataFrame:
        keys, table = _KEYS[name], f"{prefix}_{name}"
        writer = df.repartition(buckets, *keys).write.mode("overwrite")
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
        return spark.table(table)

    return store


def lay_out(
    tables: CatalogTables,
    prefix: str,
    buckets: int,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    params: Params = DEFAULTS,
    days: DataFrame | None = None,
) -> Reductions:
    """Reduce the inputs once into bucketed tables. Cadence bands and thresholds of accounts are those of
    ``params``; all else is left to the reports. Choose ``buckets`` for about 100 MB in each of ``versions``."""
    store = bucketed(tables.lookup.sparkSession, prefix, buckets)
    return reduced_inputs(tables, store, clients, aliases, params, days)


def open_layout(spark: SparkSession, prefix: str) -> Reductions:
    """What ``lay_out`` wrote under that prefix."""
    return Reductions(**{f.name: spark.table(f"{prefix}_{f.name}") for f in fields(Reductions)})
