"""Visit share per client and service, visits without a usable type included."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.operators.ranking import share_of_client, visit_counts
from catalog_signals.operators.scope import distinct_clients, scoped_service_types
from catalog_signals.operators.spread import spread_join
from catalog_signals.operators.versions import latest_types
from catalog_signals.sources.scans import Clients, requested_clients, scan_visits
from catalog_signals.sources.tables import CatalogTables

UNKNOWN_SERVICE = "<unknown>"


def share_report(
    tables: CatalogTables,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Clients ascending, busiest services first. A service without a description shows its id.

    Without a client list, the clients are those of the catalogue.
    """
    clients = requested_clients(clients)
    raw = scoped_service_types(tables.service_types, clients, aliases)
    names = latest_types(raw, "clientId").select(
        F.col("clientId").alias("_client"), F.col("TYPE_ID").alias("_type"), "DESCRIPTION"
    )
    shares = share_of_client(visit_counts(scan_visits(tables.visits, clients)), "n", "share_pct")
    if clients is None:
        known = distinct_clients(tables.service_types)
        shares = spread_join(shares, known, ["clientId"], ["TYPE_ID"], "left_semi")
    same_type = (F.col("clientId") == F.col("_client")) & F.col("TYPE_ID").eqNullSafe(F.col("_type"))
    named = shares.join(names, same_type, "left")
    service = F.coalesce("DESCRIPTION", F.col("TYPE_ID").cast("string"), F.lit(UNKNOWN_SERVICE))
    return named.select(
        "clientId",
        "TYPE_ID",
        service.alias("service"),
        F.col("n").alias("appointmentCount"),
        F.col("share_pct").alias("appointmentSharePct"),
    ).orderBy("clientId", F.desc("appointmentCount"), F.asc_nulls_first("TYPE_ID"))
