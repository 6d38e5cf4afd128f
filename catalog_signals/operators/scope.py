"""Which clients take part, and which source offices make up a client."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_signals.operators.cadence import merged_days
from catalog_signals.sources.scans import Clients, of_clients, requested_clients
from catalog_signals.sources.tables import CatalogTables


def distinct_clients(raw: DataFrame) -> DataFrame:
    return of_clients(raw, None, "CLIENT").select(F.col("CLIENT").alias("clientId")).distinct()


def _pairs(aliases: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    return list(dict.fromkeys((s, name) for name, sources in aliases.items() for s in sources))


def _local(spark: SparkSession, pairs: list[tuple[str, str]], source: str, logical: str) -> DataFrame:
    """The pairs as a local table, whose size Spark knows; that of a list of rows, an RDD, it doesn't."""
    sources, names = ([pair[i] for pair in pairs] for i in range(2))
    return spark.createDataFrame(pa.table({source: pa.array(sources, pa.string()), logical: pa.array(names, pa.string())}))


def tenant_rollup(
    df: DataFrame,
    aliases: Mapping[str, Sequence[str]] | DataFrame,
    source: str = "CLIENT",
    logical: str = "clientId",
) -> DataFrame:
    """Rows of the aliased clients in column ``source``, each under its logical client in ``logical``.

    ``aliases`` maps a logical client to its sources, or is a DataFrame of distinct pairs ``_source``,
    ``_logical``. A source of several logical clients appears once under each, named twice or not. Spark
    knows the size of the pairs of a mapping, a local table, and broadcasts them if that is under its
    threshold; shuffled by source, the rows of few sources would be sorted in as few tasks.
    """
    if isinstance(aliases, DataFrame):
        table, rows = aliases, of_clients(df, None, source)
    else:
        pairs = _pairs(aliases)
        table = _local(df.sparkSession, pairs, "_source", "_logical")
        rows = of_clients(df, list(dict.fromkeys(s for s, _ in pairs)), source)
    joined = rows.join(table, F.col(source) == F.col("_source")).drop("_source")
    return joined.withColumn(logical, F.col("_logical")).drop("_logical")


def _asked_aliases(
    clients: Clients, aliases: Mapping[str, Sequence[str]] | None
) -> Mapping[str, Sequence[str]] | DataFrame | None:
    """Sources of every asked-for client, if any of them is a logical one; else nothing. For a DataFrame of
    clients, whose names aren't known here, a DataFrame of pairs, in which a client that is no logical
    one is its own source."""
    known, clients = aliases or {}, requested_clients(clients)
    if isinstance(clients, DataFrame):
        if not known:
            return None
        asked = clients.select(F.col(clients.columns[0]).cast("string").alias("_logical")).dropna().distinct()
        table = _local(clients.sparkSession, _pairs(known), "_of", "_name")
        named = asked.join(table, F.col("_logical") == F.col("_name"), "left")
        return named.select(F.coalesce("_of", "_logical").alias("_source"), "_logical")
    if not any(c in known for c in clients or ()):
        return None
    return {c: known.get(c, [c]) for c in clients}


def scoped_service_types(
    raw: DataFrame,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Raw service types with the client they are analysed under in ``clientId``.

    An aliased logical client takes part only if it is asked for, by a name in a list or a DataFrame;
    otherwise its sources are clients of their own.
    """
    asked = _asked_aliases(clients, aliases)
    if asked is not None:
        return tenant_rollup(raw, asked)
    return of_clients(raw, clients, "CLIENT").withColumn("clientId", F.col("CLIENT"))


def roll_up_facts(
    tables: CatalogTables,
    clients: Clients,
    aliases: Mapping[str, Sequence[str]] | None,
) -> CatalogTables:
    """The tables with visits, subscriptions, lookup and validation rows of the sources moved to the
    asked-for logical clients, too. Without this, those four are read under the logical name only."""
    asked = _asked_aliases(clients, aliases)
    if asked is None:
        return tables
    columns = {
        "merged_service_types": "clientID", "visits": "clientID", "subscriptions": "clientID",
        "lookup": "clientId",
    }
    moved = {n: tenant_rollup(getattr(tables, n), asked, c, c) for n, c in columns.items()}
    return CatalogTables(service_types=tables.service_types, **moved)


def roll_up_days(
    days: DataFrame, clients: Clients, aliases: Mapping[str, Sequence[str]] | None, roll_up: bool = False
) -> DataFrame:
    """Account-days of the asked-for clients; with ``roll_up``, those of their sources under the logical ones,
    where days of one account that several sources have are merged."""
    asked = _asked_aliases(clients, aliases) if roll_up else None
    if asked is None:
        return of_clients(days, clients, "clientId")
    return merged_days(tenant_rollup(days, asked, "clientId", "clientId"))
