"""Small hand-made inputs in the raw shape of the five tables."""

from __future__ import annotations

import datetime as dt

from catalog_signals import CatalogTables

SERVICE_TYPES = (
    "CLIENT string, TYPE_ID string, DESCRIPTION string, RESERVICE string, REGULAR_SERVICE string, "
    "FREQUENCY string, DEFAULT_LENGTH string, INITIAL_ID string, INITIAL string, DATE_LOADED date"
)
MERGED = "typeID string, clientID string, description string"
VISITS = (
    "individualAccountID bigint, type string, appointmentDate timestamp_ntz, clientID string, "
    "productionValue double"
)
SUBSCRIPTIONS = (
    "subscriptionID string, serviceID string, serviceType string, annualRecurringServices string, "
    "active boolean, dateCancelled timestamp_ntz, clientID string, dateAdded timestamp_ntz"
)
LOOKUP = "clientId string, serviceType string, isRecurring string"

DAY = dt.datetime(2020, 1, 1)
AS_OF = "2021-06-01 12:00:00"


def type_row(client="A", type_id="1", description="plain", loaded=dt.date(2020, 1, 1), **flags):
    names = ("RESERVICE", "REGULAR_SERVICE", "FREQUENCY", "DEFAULT_LENGTH", "INITIAL_ID", "INITIAL")
    defaults = dict.fromkeys(names, "0") | {"DEFAULT_LENGTH": "30"} | flags
    return (client, type_id, description, *[defaults[n] for n in names], loaded)


def visit_row(day=0, account=1, type_id="1", client="A"):
    """``day`` is a number of days (fractions allowed) after 2020-01-01, or None for no date."""
    when = None if day is None else DAY + dt.timedelta(days=day)
    return (account, type_id, when, client, 1.0)


def sub_row(amount="$100.00", type_id="1", client="A", active=True, cancelled=None):
    return ("s", type_id, "x", amount, active, cancelled, client, DAY)


def tables(spark, types=(), merged=(), visits=(), subs=(), lookup=()) -> CatalogTables:
    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return CatalogTables(
        service_types=frame(types, SERVICE_TYPES),
        merged_service_types=frame(merged, MERGED),
        visits=frame(visits, VISITS),
        subscriptions=frame(subs, SUBSCRIPTIONS),
        lookup=frame(lookup, LOOKUP),
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
