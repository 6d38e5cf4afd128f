"""The registered queries: every operator over the whole stand-in tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_signals.config import FLAGS, HAS_RESERVICE, RECURRING, RESERVICE, SIGNALS, ZERO_TIME
from catalog_signals.operators import activity, cadence, lookup, ranking, resolution, scope, signals
from catalog_signals.operators.audit import audit_of_reductions, source_row_audit, table_profile
from catalog_signals.operators.versions import (
    SERVICE_TYPE_COLUMNS,
    dedupe_types,
    latest_types,
    latest_version,
)
from catalog_signals.plans import outputs
from catalog_signals.plans.jobs import run_report
from catalog_signals.plans.report import analysed, build_report, evidence_frame, recurrence_frame, reduced_inputs
from catalog_signals.plans.share_report import share_report
from catalog_signals.sources import scans
from catalog_signals.sources.sinks import read_delivery
from catalog_signals.sources.tables import CatalogTables
from verification.standin import ALIASES, AS_OF, PARAMS, StandInTables, open_table

KEYS = ["clientId", "TYPE_ID"]
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(build: Callable[[CatalogTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(StandInTables(spark, sf_dir))


def _types(t: CatalogTables) -> DataFrame:
    return latest_types(scope.scoped_service_types(t.service_types), "clientId").select(
        SERVICE_TYPE_COLUMNS
    )


def _visits(t: CatalogTables) -> DataFrame:
    return scans.scan_visits(t.visits)


def _subs(t: CatalogTables) -> DataFrame:
    return scans.scan_subscriptions(t.subscriptions)


def _lookup(t: CatalogTables) -> DataFrame:
    return scans.scan_lookup(t.lookup)


def _evidence(t: CatalogTables) -> DataFrame:
    return evidence_frame(t, ranks=False, params=PARAMS)


def _report(t: CatalogTables) -> DataFrame:
    return build_report(t, AS_OF, params=PARAMS)


def _unfiltered(t: CatalogTables) -> DataFrame:
    return build_report(t, AS_OF, dedupe=False, ranks=False, params=PARAMS)


def _in_use(t: CatalogTables) -> DataFrame:
    return outputs.activity_filter(_report(t))


def _selected(t: CatalogTables) -> DataFrame:
    clients = scope.requested_clients(" ECONOMY,SMALL ,, LARGE ", fallback="PROMO")
    raw = scope.scoped_service_types(t.service_types, clients)
    return latest_version(raw, "clientId").select(SERVICE_TYPE_COLUMNS)


def _rolled_up(t: CatalogTables) -> DataFrame:
    """Every client, two of them under their logical client too."""
    rolled = scope.tenant_rollup(t.service_types, ALIASES)
    raw = rolled.unionByName(scope.scoped_service_types(t.service_types))
    return latest_version(raw, "clientId")


def _rolled_up_facts(t: CatalogTables) -> DataFrame:
    """Rows of every fact table of the sources of a logical client, under that client."""
    moved = scope.roll_up_facts(t, "COMPACT", ALIASES)
    columns = {
        "merged_service_types": "clientID", "visits": "clientID", "subscriptions": "clientID", "lookup": "clientId",
    }
    counts = [
        getattr(moved, name).groupBy(F.col(c).alias("clientId")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("table_name"), "clientId", "n")
        for name, c in columns.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _api_signals(t: CatalogTables) -> DataFrame:
    flags = [f"API_{f}" for f in FLAGS]
    found = [f"flagged_{s}" for s in SIGNALS]
    return signals.api_signals(_types(t), PARAMS).select(*KEYS, *flags, *found)


def _word_columns() -> list[str]:
    return [f"word_{s}" for s in SIGNALS]


def _document_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = open_table(spark, sf_dir, "documents")
    return signals.keyword_signals(documents, "text").select("doc_id", *_word_columns())


def _constraint_correction(t: CatalogTables) -> DataFrame:
    rows = resolution.constraint_correction(resolution.final_signals(_evidence(t), PARAMS), PARAMS)
    return rows.select(*KEYS, *[f"final_{s}" for s in SIGNALS], "corrections", "violations")


def _review_reasons(t: CatalogTables) -> DataFrame:
    return analysed(t, AS_OF, params=PARAMS).select(
        *KEYS,
        "ask_client",
        *[f"conflict_{s}" for s in (RECURRING, RESERVICE, ZERO_TIME)],
        F.lit("").alias(f"conflict_{HAS_RESERVICE}"),
        "volume_reason",
        "revenue_reason",
    )


def _recurrence(t: CatalogTables) -> DataFrame:
    return recurrence_frame(_types(t).select(*KEYS), _visits(t), _subs(t), PARAMS).select(
        *KEYS, "strong_accounts", "total_accounts", "strong_ratio", "appt_score", "appt_bool",
        "appt_reason",
    )


def _expired(t: CatalogTables) -> DataFrame:
    recent = activity.recent_activity(_types(t).select(*KEYS), _visits(t), AS_OF, PARAMS)
    return activity.expired_flag(activity.active_subscription(recent, _subs(t)))


def _cadence_band(t: CatalogTables) -> DataFrame:
    accounts = cadence.account_cadence(_visits(t), PARAMS)
    return accounts.select(
        *KEYS, "accountId", "median_days", F.expr(cadence.band_name("median_days", PARAMS)).alias("band")
    )


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return table_profile(spark, {name: opener(name) for name in DRIVER_TABLES})


def _rolled_up_by_frame(t: CatalogTables) -> DataFrame:
    """Every client and a logical one, asked for by a DataFrame of names."""
    names = scope.distinct_clients(t.service_types)
    asked = names.union(names.sparkSession.createDataFrame([(name,) for name in ALIASES], "clientId string"))
    return latest_version(scope.scoped_service_types(t.service_types, asked, ALIASES), "clientId")


def _cadence_of_parts(t: CatalogTables) -> DataFrame:
    """Visits that come in two loads, which divide the days of accounts, reduced apart and merged."""
    load = F.pmod(F.xxhash64(*t.visits.columns), F.lit(2))
    parts = [cadence.visits_per_day(scans.scan_visits(t.visits.where(load == n))) for n in range(2)]
    return cadence.cadence_of_days(cadence.merged_days(parts[0].unionByName(parts[1])), PARAMS)


def _audit_of_reductions(t: CatalogTables) -> DataFrame:
    reduced = reduced_inputs(t, lambda _, df: df, params=PARAMS)
    return audit_of_reductions(reduced.versions, reduced.names, reduced.history, reduced.usage, reduced.validation)


def _delivered(t: CatalogTables) -> DataFrame:
    """A whole batch run into a new folder of the shared checkpoint folder, and the rows that it delivers."""
    spark = t.visits.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        shared = tempfile.gettempdir()
    folder = f"{shared}/runs-{uuid.uuid4().hex}"
    run_report(t, AS_OF, folder, params=PARAMS)
    return read_delivery(spark, folder)


QUERIES: dict[str, Query] = {
    "clients_distinct": _on_tables(lambda t: scope.distinct_clients(t.service_types)),
    "latest_version": _on_tables(
        lambda t: latest_version(scans.of_clients(t.service_types, None, "CLIENT")).select(SERVICE_TYPE_COLUMNS)
    ),
    "client_selection": _on_tables(_selected),
    "tenant_rollup": _on_tables(
        lambda t: _rolled_up(t).select(*SERVICE_TYPE_COLUMNS, "sourceClient")
    ),
    "tenant_rollup_facts": _on_tables(_rolled_up_facts),
    "tenant_rollup_by_frame": _on_tables(
        lambda t: _rolled_up_by_frame(t).select(*SERVICE_TYPE_COLUMNS, "sourceClient")
    ),
    "dedupe_by_key": _on_tables(lambda t: dedupe_types(_rolled_up(t)).select(SERVICE_TYPE_COLUMNS)),
    "lookup_attach": _on_tables(
        lambda t: lookup.lookup_attach(_types(t).select(*KEYS, "DESCRIPTION"), _lookup(t))
    ),
    "lookup_attach_fanout": _on_tables(
        lambda t: lookup.lookup_attach_fanout(_types(t).select(*KEYS, "DESCRIPTION"), _lookup(t))
    ),
    "reference_mismatch": _on_tables(
        lambda t: lookup.reference_mismatch(
            _types(t), scans.scan_merged_service_types(t.merged_service_types)
        )
    ),
    "api_signals": _on_tables(_api_signals),
    "keyword_signals": _on_tables(
        lambda t: signals.keyword_signals(_types(t), params=PARAMS).select(*KEYS, *_word_columns())
    ),
    "keyword_signals_documents": _document_keywords,
    "mapping_signal": _on_tables(
        lambda t: signals.mapping_signal(lookup.lookup_attach(_types(t), _lookup(t))).select(
            *KEYS, "mapping_value", "mapping_reason"
        )
    ),
    "priority_resolve": _on_tables(
        lambda t: resolution.priority_resolve(_evidence(t), KEYS, PARAMS)
    ),
    "dissent_reasons": _on_tables(lambda t: resolution.dissent_reasons(_evidence(t), KEYS, PARAMS)),
    "constraint_correction": _on_tables(_constraint_correction),
    "top_two_conflict": _on_tables(
        lambda t: resolution.top_two_conflicts(_evidence(t), KEYS, PARAMS)
    ),
    "top_vs_rest_conflict": _on_tables(
        lambda t: resolution.top_vs_rest_conflicts(_evidence(t), KEYS, PARAMS)
    ),
    "review_reasons": _on_tables(_review_reasons),
    "duplicate_name": _on_tables(
        lambda t: lookup.repeated_names(_types(t).select(*KEYS, "DESCRIPTION"))
    ),
    "recent_activity": _on_tables(
        lambda t: activity.recent_activity(_types(t).select(*KEYS), _visits(t), AS_OF, PARAMS)
    ),
    "active_subscription": _on_tables(
        lambda t: activity.active_subscription(_types(t).select(*KEYS), _subs(t))
    ),
    "expired_flag": _on_tables(_expired),
    "account_cadence": _on_tables(lambda t: cadence.account_cadence(_visits(t), PARAMS)),
    "account_cadence_of_parts": _on_tables(_cadence_of_parts),
    "cadence_band": _on_tables(_cadence_band),
    "recurrence_score": _on_tables(_recurrence),
    "volume_share": _on_tables(lambda t: ranking.volume_share(_visits(t))),
    "volume_topk": _on_tables(lambda t: ranking.volume_topk(_visits(t), PARAMS)),
    "money_parse": _on_tables(
        lambda t: _subs(t).select("clientId", "subscriptionId", "amountText", "amount")
    ),
    "revenue_share": _on_tables(
        lambda t: ranking.revenue_share(_subs(t)).withColumn("revenue", F.col("revenue").cast("double"))
    ),
    "revenue_topk": _on_tables(
        lambda t: ranking.revenue_topk(_subs(t), PARAMS).withColumn("revenue", F.col("revenue").cast("double"))
    ),
    "share_report": _on_tables(share_report),
    "final_report": _on_tables(_report),
    "final_report_unfiltered": _on_tables(_unfiltered),
    "activity_filter": _on_tables(_in_use),
    "review_queue": _on_tables(lambda t: outputs.review_queue(_in_use(t))),
    "review_queue_unfiltered": _on_tables(lambda t: outputs.review_queue_unfiltered(_unfiltered(t))),
    "review_split_true": _on_tables(lambda t: outputs.review_split(_in_use(t))[0]),
    "settled_summary": _on_tables(lambda t: outputs.settled_summary(_in_use(t))),
    "source_row_audit": _on_tables(source_row_audit),
    "audit_of_reductions": _on_tables(_audit_of_reductions),
    "delivered_report": _on_tables(_delivered),
    "review_metrics": _on_tables(
        lambda t: outputs.review_metrics(analysed(t, AS_OF, params=PARAMS))
    ),
    "table_profile": _profile,
}
