"""Where the five input tables come from."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class CatalogTables:
    """The raw inputs, as the warehouse holds them; ``sources.scans`` normalises them."""

    service_types: DataFrame
    merged_service_types: DataFrame
    visits: DataFrame
    subscriptions: DataFrame
    lookup: DataFrame


#: Default table names; pass another mapping to ``read_tables`` to override any of them.
TABLE_NAMES = {
    "service_types": "service_type_raw",
    "merged_service_types": "merged_service_type",
    "visits": "merged_appointment",
    "subscriptions": "merged_subscription",
    "lookup": "recurring_lookup",
}


def read_tables(
    spark: SparkSession,
    names: Mapping[str, str] | None = None,
    path: str | None = None,
    fmt: str = "parquet",
) -> CatalogTables:
    """Catalogue tables by name, or, with ``path``, files ``<path>/<name>`` of format ``fmt``."""
    chosen = {**TABLE_NAMES, **(names or {})}
    unknown = set(chosen) - {f.name for f in fields(CatalogTables)}
    if unknown:
        raise ValueError(f"unknown inputs: {sorted(unknown)}")
    if path is None:
        return CatalogTables(**{k: spark.table(n) for k, n in chosen.items()})
    reader = spark.read.format(fmt)
    return CatalogTables(**{k: reader.load(f"{path}/{n}") for k, n in chosen.items()})
