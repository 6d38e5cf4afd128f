"""Service-catalogue signals: batch analytics over all clients at once, as Spark DataFrames."""

from catalog_signals.config import DEFAULTS, Params
from catalog_signals.plans.report import build_report
from catalog_signals.sources.tables import CatalogTables, read_tables

__all__ = ["DEFAULTS", "CatalogTables", "Params", "build_report", "read_tables"]
