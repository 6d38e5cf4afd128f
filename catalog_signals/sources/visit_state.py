"""Visit history as a state that grows by load date.

The state holds, for every load date, the account-days of the visits that came with it, and not the
visits. Adding a date reads and reduces that date's visits only; loading a date again replaces it, so a
repeated load counts once. Reports merge the parts (``operators.cadence.merged_days``), in whatever
order they came, and never read the visits. The state changes at one moment (``sources.snapshots``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from catalog_signals.operators.cadence import merged_days, visits_per_day
from catalog_signals.sources.scans import Clients, of_clients
from catalog_signals.sources.snapshots import Snapshot, latest, open_entry

_DAYS = "clientId string, TYPE_ID bigint, accountId bigint, day date, n bigint, first timestamp_ntz, last timestamp_ntz"
#: A part that holds every load date up to one begins its name so.
_UPTO = "upto "


def _closed(names: list[str]) -> str:
    """The load date up to which all are one part, or an empty text."""
    return max((n.removeprefix(_UPTO) for n in names if n.startswith(_UPTO)), default="")


def load_visits(visits: DataFrame, load_date: dt.date | str, folder: str) -> None:
    """Add the scanned visits of one load date, or replace them if the date has been loaded before. A date
    that ``close_dates`` has merged with others can't be replaced."""
    name = dt.date.fromisoformat(str(load_date)).isoformat()
    with Snapshot(visits.sparkSession, folder) as run:
        if name <= _closed(list(run.layers)):
            raise ValueError(f"{name} is closed")
        run.layers[name] = run.save("days", visits_per_day(visits))


def read_days(spark: SparkSession, folder: str, clients: Clients = None) -> DataFrame:
    """The account-days of all load dates, merged; without any, an empty frame."""
    parts = [open_entry(spark, folder, entry) for entry in latest(spark, folder).layers.values()]
    if not parts:
        return spark.createDataFrame([], _DAYS)
    days = parts[0]
    for part in parts[1:]:
        days = days.unionByName(part)
    return merged_days(of_clients(days, clients, "clientId"))


def close_dates(spark: SparkSession, folder: str, last: dt.date | str) -> None:
    """Merge all load dates up to ``last`` into one part, so that the state is read as few parts."""
    name = dt.date.fromisoformat(str(last)).isoformat()
    with Snapshot(spark, folder) as run:
        old = {n: e for n, e in run.layers.items() if n.removeprefix(_UPTO) <= name}
        if not old:
            return
        days = None
        for entry in old.values():
            part = open_entry(spark, folder, entry)
            days = part if days is None else days.unionByName(part)
        run.layers = {n: e for n, e in run.layers.items() if n not in old}
        run.layers[_UPTO + name] = run.save("days", merged_days(days))
