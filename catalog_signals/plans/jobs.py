"""The three batch runs: from input tables to written reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from catalog_signals.config import DEFAULTS, Params
from catalog_signals.operators.audit import audit_of_reductions
from catalog_signals.operators.lookup import mismatch_of_counts
from catalog_signals.operators.scope import roll_up_days, roll_up_facts
from catalog_signals.operators.versions import dedupe_types
from catalog_signals.plans.outputs import activity_filter, review_metrics, review_queue_unfiltered
from catalog_signals.plans.report import analysed, build_report, reduced_inputs, to_report
from catalog_signals.plans.share_report import share_report
from catalog_signals.sources.scans import Clients, requested_clients
from catalog_signals.sources.sinks import deliver, report_outputs, write_report
from catalog_signals.sources.snapshots import Snapshot
from catalog_signals.sources.tables import CatalogTables
from catalog_signals.sources.visit_state import read_days


def run_report(
    tables: CatalogTables,
    as_of: dt.datetime | str,
    folder: str,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    params: Params = DEFAULTS,
    roll_up: bool = False,
    visit_state: str | None = None,
) -> dict[str, DataFrame]:
    """The types in use: full report, review queue, splits, and the delivery per client; and what the inputs
    and the evidence are worth: ``mismatches``, ``audit`` and ``metrics``.

    Every input is read once, for its reduction; ``analysis`` is computed once from the reductions, and the
    rest is cut from these. All outputs appear in ``folder`` at one moment, at the end
    (``sources.snapshots``), to be read with ``read_outputs`` and ``read_client_report``. ``visit_state``
    is a folder of ``sources.visit_state``, which is read instead of the visits.
    """
    clients, days = requested_clients(clients), None
    if visit_state is not None:
        days = roll_up_days(read_days(tables.lookup.sparkSession, visit_state), clients, aliases, roll_up)
    if roll_up:
        tables = roll_up_facts(tables, clients, aliases)
    with Snapshot(tables.lookup.sparkSession, folder) as run:
        inputs = reduced_inputs(tables, run.write, clients, aliases, params, days)
        rows = run.write("analysis", analysed(inputs, as_of, params=params))
        written = report_outputs(run, activity_filter(to_report(rows).drop("copies")))
        deliver(run, written["report"], covered=() if clients is None else clients, everyone=clients is None)
        checks = {
            "mismatches": mismatch_of_counts(dedupe_types(inputs.versions), inputs.validation),
            "audit": audit_of_reductions(
                inputs.versions, inputs.names, inputs.history, inputs.usage, inputs.validation
            ),
            "metrics": review_metrics(rows),
        }
        return written | {name: run.write(name, df) for name, df in checks.items()}


def run_unfiltered_report(
    tables: CatalogTables,
    as_of: dt.datetime | str,
    folder: str,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    params: Params = DEFAULTS,
    roll_up: bool = False,
) -> dict[str, DataFrame]:
    """Every catalogue row, once per lookup match, with expired types in the review queue too."""
    if roll_up:
        tables = roll_up_facts(tables, clients, aliases)
    report = build_report(tables, as_of, clients, aliases, dedupe=False, ranks=False, params=params)
    return write_report(report, folder, review_queue_unfiltered)


def run_share_report(
    tables: CatalogTables,
    folder: str,
    clients: Clients = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    roll_up: bool = False,
) -> DataFrame:
    """Visit shares per client and service. ``roll_up``, in all three runs, moves the facts of aliased
    sources to the logical clients that are asked for."""
    if roll_up:
        tables = roll_up_facts(tables, clients, aliases)
    with Snapshot(tables.visits.sparkSession, folder) as run:
        return run.write("appointment_share", share_report(tables, clients, aliases))
