"""The full report: one row per client and service type, 37 columns.

Shape of the plan. Visits are scanned once for history (reduced to account-days inside the tasks) and,
if ranks are wanted, once more for bare counts, of which totals and top-k share one shuffle.
Subscriptions are reduced to one row per (client, type) that shares, ranks and presence all read. The
catalogue is hashed by (client, TYPE_ID) for its dedupe and stays so for the joins with those reduced
frames, all unique per key. Joins on a client or a description alone can meet a hot key and are spread.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_signals.config import DEFAULTS, HAS_RESERVICE, RECURRING, RESERVICE, ZERO_TIME, Params
from catalog_signals.functions.casts import years_before
from catalog_signals.functions.text import share_pct
from catalog_signals.operators.activity import active_subscription, expired_flag
from catalog_signals.operators.cadence import (
    explain_visitless_clients,
    history_of_days,
    recurrence_score,
    score_accounts,
    type_history,
)
from catalog_signals.operators.lookup import (
    expand_copies,
    name_facts,
    name_types,
    name_types_fanout,
    validation_counts,
)
from catalog_signals.operators.ranking import (
    active_revenue,
    revenue_of_facts,
    subscription_facts,
    top_k,
    visit_counts,
    with_client_total,
)
from catalog_signals.operators.resolution import (
    conflict_reasons,
    constraint_correction,
    final_signals,
)
from catalog_signals.operators.scope import scoped_service_types
from catalog_signals.operators.signals import (
    api_signals,
    keyword_signals,
    mapping_signal,
)
from catalog_signals.operators.versions import dedupe_types, latest_types, latest_version, version_order
from catalog_signals.sources.scans import (
    Clients,
    requested_clients,
    scan_lookup,
    scan_merged_service_types,
    scan_subscriptions,
    scan_visits,
)
from catalog_signals.sources.tables import CatalogTables

_TYPE = ["clientId", "TYPE_ID"]

#: Writes a frame under a name and reads it back.
Store = Callable[[str, DataFrame], DataFrame]

# The report's columns, in order.
REPORT_SCHEMA = T.StructType()
for _name, _type in {
    "TYPE_ID": T.LongType(),
    "DESCRIPTION": T.StringType(),
    "API RESERVICE FLAG": T.LongType(),
    "API REGULAR_SERVICE FLAG": T.LongType(),
    "API FREQUENCY FLAG": T.LongType(),
    "API DEFAULT_LENGTH FLAG": T.LongType(),
    "API INITIAL ID FLAG": T.LongType(),
    "API INITIAL FLAG": T.LongType(),
    "hasVisitsInPast2Years": T.BooleanType(),
    "hasActiveSubscription": T.BooleanType(),
    "Repeated Name": T.BooleanType(),
    "API Reservice": T.BooleanType(),
    "API Recurring": T.BooleanType(),
    "API Zero Time": T.BooleanType(),
    "API Has Reservice": T.BooleanType(),
    "Word Signal Reservice": T.BooleanType(),
    "Word Signal Recurring": T.BooleanType(),
    "Word Signal Zero Time": T.BooleanType(),
    "Word Signal Has Reservice": T.BooleanType(),
    "Appt Recurring": T.BooleanType(),
    "Appt Recurring Score": T.DoubleType(),
    "Appt Recurring - Reason": T.StringType(),
    "Final Reservice": T.BooleanType(),
    "Final Recurring": T.BooleanType(),
    "Final Zero Time": T.BooleanType(),
    "Final Has Reservice": T.BooleanType(),
    "Expired Code": T.BooleanType(),
    "AskClient Reservice - Reason": T.StringType(),
    "AskClient Recurring - Reason": T.StringType(),
    "AskClient Zero Time - Reason": T.StringType(),
    "AskClient Has Reservice - Reason": T.StringType(),
    "AskClient": T.BooleanType(),
    "Appointment Share Pct": T.DoubleType(),
    "Revenue Share Pct": T.DoubleType(),
    "AskClient High Priority - Reason": T.StringType(),
    "AskClient High Revenue - Reason": T.StringType(),
    "Client": T.StringType(),
}.items():
    REPORT_SCHEMA.add(_name, _type)


def client_visit_totals(counts: DataFrame) -> DataFrame:
    """Per client: all visits, and visits with a type (NULL if there are none)."""
    typed = F.when(F.col("TYPE_ID").isNotNull(), F.col("n"))
    return counts.groupBy("clientId").agg(
        F.sum("n").alias("client_visits"), F.sum(typed).alias("client_typed_visits")
    )


def client_totals(counts: DataFrame, revenue: DataFrame) -> DataFrame:
    """Visit totals and revenue per client. Both are reduced to one row per client, stacked and summed
    again, so that the report joins per-client figures once."""
    money = revenue.groupBy("clientId").agg(F.sum("revenue").alias("client_revenue"))
    stacked = client_visit_totals(counts).unionByName(money, allowMissingColumns=True)
    figures = ("client_visits", "client_typed_visits", "client_revenue")
    return stacked.groupBy("clientId").agg(*[F.max(c).alias(c) for c in figures])


def important_types(counts: DataFrame, revenue: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The top types by volume and by revenue of every client, with a flag for either."""
    by_volume = top_k(counts, "n", params.top_volume)
    by_revenue = top_k(revenue, "revenue", params.top_revenue)
    marked = by_volume.selectExpr(*_TYPE, "TRUE AS top_volume", "FALSE AS top_revenue").unionByName(
        by_revenue.selectExpr(*_TYPE, "FALSE AS top_volume", "TRUE AS top_revenue")
    )
    flags = [F.max(f).alias(f) for f in ("top_volume", "top_revenue")]
    return marked.groupBy(*_TYPE).agg(*flags)


def recurrence_frame(
    types: DataFrame, visits: DataFrame, subscriptions: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """The recurrence score of every type, on its own."""
    rows = active_subscription(types, subscriptions).join(type_history(visits, params), _TYPE, "left")
    rows = with_client_total(rows, client_visit_totals(visit_counts(visits)))
    return recurrence_score(rows, params)


def _named_versions(types: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of one type id (from several sources) all go by the first row's ``repeated_name``."""
    versions = Window.partitionBy(*_TYPE).orderBy(*version_order("sourceClient"))
    named = name_types_fanout(types, names)
    return named.withColumn("repeated_name", F.first("repeated_name").over(versions))


@dataclass(frozen=True)
class Reductions:
    """What a report reads of its inputs: the latest ``versions`` of service types, the facts of their
    ``names``, the ``history`` of visits and the ``usage`` by subscriptions of every type, and the rows of
    the ``validation`` table, counted."""

    versions: DataFrame
    names: DataFrame
    history: DataFrame
    usage: DataFrame
    validation: DataFrame


def reduced_inputs(
    tables: CatalogTables,
    store: Store,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    params: Params = DEFAULTS,
    days: DataFrame | None = None,
) -> Reductions:
    """The inputs, each read once, reduced and stored; report, checks and audit start from there.

    ``days`` are account-days that stand for the visits (``sources.visit_state``), which are not read then.
    """
    clients = requested_clients(clients)
    raw = scoped_service_types(tables.service_types, clients, aliases)
    versions = store("versions", latest_version(raw, "clientId"))
    names = name_facts(dedupe_types(versions), scan_lookup(tables.lookup, clients))
    if days is None:
        history = type_history(scan_visits(tables.visits, clients), params, untyped=True)
    else:
        history = history_of_days(days, params)
    merged = scan_merged_service_types(tables.merged_service_types, clients)
    return Reductions(
        versions,
        store("names", names),
        store("history", history),
        store("usage", subscription_facts(scan_subscriptions(tables.subscriptions, clients))),
        store("validation", validation_counts(merged)),
    )


def evidence_frame(
    tables: CatalogTables | Reductions,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    dedupe: bool = True,
    ranks: bool = True,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Catalogue rows with every signal, the usage figures and, with ``ranks``, the top-k marks.
    ``copies`` is the number of report rows a row stands for (1 with ``dedupe``).

    Out of ``Reductions``, which go with ``dedupe`` and have their clients chosen already, nothing is read
    twice; out of raw tables, a second scan of two columns counts the visits.
    """
    if isinstance(tables, Reductions):
        if not dedupe:
            raise ValueError("reductions are those of deduped types")
        types, names = dedupe_types(tables.versions), tables.names
        revenue = revenue_of_facts(tables.usage)
        counts = tables.history.select(*_TYPE, F.col("type_visits").alias("n"))
        history = tables.history.where("TYPE_ID is not null")
    else:
        clients = requested_clients(clients)
        raw = scoped_service_types(tables.service_types, clients, aliases)
        types = latest_types(raw, "clientId") if dedupe else latest_version(raw, "clientId")
        names = name_facts(types, scan_lookup(tables.lookup, clients))
        visits = scan_visits(tables.visits, clients)
        revenue = active_revenue(scan_subscriptions(tables.subscriptions, clients))
        history, counts = type_history(visits, params), visit_counts(visits)

    # Every signal is computed as soon as its inputs are there: the code of the last stage, which would
    # otherwise hold every expression, stays small enough for the JVM to compile.
    rows = keyword_signals(api_signals(types, params), "DESCRIPTION", params)
    if not dedupe:
        rows = _named_versions(rows, names)
    rows = rows.join(history, _TYPE, "left")
    rows = rows.join(revenue.withColumn("active", F.lit(True)), _TYPE, "left")
    rows = score_accounts(rows.withColumn("active", F.coalesce("active", F.lit(False))), params)
    if ranks:
        rows = rows.join(important_types(counts, revenue, params), _TYPE, "left")
    if dedupe:
        rows = name_types(rows, names).withColumn("copies", F.lit(1))
    totals = client_totals(counts, revenue) if ranks else client_visit_totals(counts)
    return explain_visitless_clients(with_client_total(mapping_signal(rows), totals))


def analysed(
    tables: CatalogTables | Reductions,
    as_of: dt.datetime | str,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    dedupe: bool = True,
    ranks: bool = True,
    params: Params = DEFAULTS,
) -> DataFrame:
    """The report's rows under internal names, with conflict and violation counts."""
    rows = evidence_frame(tables, clients, aliases, dedupe, ranks, params)
    rows = constraint_correction(final_signals(conflict_reasons(rows, params), params), params)
    cutoff = years_before(as_of, params.activity_years)
    rows = expired_flag(rows.withColumn("recent", F.coalesce(F.col("latest") >= cutoff, F.lit(False))))
    if ranks:
        rows = rows.withColumns({
            "volume_share": share_pct(F.col("type_visits"), F.col("client_typed_visits")),
            "revenue_share": share_pct(F.col("revenue"), F.col("client_revenue")),
            "volume_reason": F.expr("if(top_volume, 'high priority service', '')"),
            "revenue_reason": F.expr(
                "if(top_revenue AND client_revenue > 0, 'high revenue service', '')"
            ),
        })
    else:
        rows = rows.selectExpr(
            "*", "CAST(NULL AS DOUBLE) AS volume_share", "CAST(NULL AS DOUBLE) AS revenue_share",
            "'' AS volume_reason", "'' AS revenue_reason",
        )
    asked = "conflicts > 0 OR volume_reason <> '' OR revenue_reason <> ''"
    return rows.withColumn("ask_client", F.expr(asked))


def to_report(rows: DataFrame) -> DataFrame:
    """Public names and order, and ``copies``."""
    signals = (RESERVICE, RECURRING, ZERO_TIME, HAS_RESERVICE)
    sources = [
        "TYPE_ID", "coalesce(DESCRIPTION, '')",
        "API_RESERVICE", "API_REGULAR_SERVICE", "API_FREQUENCY", "API_DEFAULT_LENGTH",
        "API_INITIAL_ID", "API_INITIAL",
        "recent", "active", "repeated_name",
        *[f"flagged_{s}" for s in signals], *[f"word_{s}" for s in signals],
        "appt_bool", "appt_score", "appt_reason",
        *[f"final_{s}" for s in signals],
        "expired",
        *[f"conflict_{s}" for s in (RESERVICE, RECURRING, ZERO_TIME)],
        "''", "ask_client", "volume_share", "revenue_share", "volume_reason", "revenue_reason",
        "clientId",
    ]
    columns = [
        f"CAST({sql} AS {field.dataType.simpleString()}) AS `{field.name}`"
        for sql, field in zip(sources, REPORT_SCHEMA.fields, strict=True)
    ]
    return rows.selectExpr(*columns, "copies")


def build_report(
    tables: CatalogTables,
    as_of: dt.datetime | str,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    dedupe: bool = True,
    ranks: bool = True,
    params: Params = DEFAULTS,
) -> DataFrame:
    """The full report over all (or the given) clients, as of a fixed time.

    ``dedupe=False, ranks=False`` gives the unfiltered report: a type is repeated for every lookup row
    it matches, and there are no shares and no importance reasons.
    """
    report = to_report(analysed(tables, as_of, clients, aliases, dedupe, ranks, params))
    return report.drop("copies") if dedupe else expand_copies(report)
