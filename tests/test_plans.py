"""What the physical plans must and must not contain."""

import re
import time

import pytest
from frames import AS_OF, sub_row, tables, type_row, visit_row

from catalog_signals import build_report, read_tables
from catalog_signals.operators import activity, audit, cadence, lookup, ranking
from catalog_signals.operators.versions import latest_types
from catalog_signals.sources import scans
from catalog_signals.sources.tables import TABLE_NAMES


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """The five inputs as Parquet, so that plans show real scans."""
    folder = str(tmp_path_factory.mktemp("inputs"))
    inputs = tables(
        spark,
        types=[type_row(type_id=str(t), description="x") for t in range(5)],
        merged=[("1", "A", "x")],
        visits=[visit_row(day=30 * i, type_id=str(i % 5)) for i in range(40)],
        subs=[sub_row(type_id=str(i)) for i in range(5)],
        lookup=[("A", "x", "TRUE")],
    )
    for attribute, name in TABLE_NAMES.items():
        getattr(inputs, attribute).write.parquet(f"{folder}/{name}")
    return read_tables(spark, path=folder)


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Plan as for inputs that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans_of(plan):
    return re.findall(r"FileScan parquet.*", plan)


def scanned_columns(scan):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)", scan)[1]))


def test_report_reads_every_input_once_and_visits_twice(files):
    plan = executed(build_report(files, AS_OF))
    names = sorted(re.search(r"/(\w+)\]", s)[1] for s in scans_of(plan))
    assert names == ["merged_appointment"] * 2 + ["merged_subscription", "recurring_lookup", "service_type_raw"]
    assert "ReusedExchange" in plan
    for forbidden in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                      "BroadcastNestedLoopJoin", "BroadcastHashJoin"):
        assert forbidden not in plan


def test_report_drops_unused_columns(files):
    plan = executed(build_report(files, AS_OF))
    visits = [scanned_columns(s) for s in scans_of(plan) if "merged_appointment" in s]
    assert {frozenset(v) for v in visits} == {
        frozenset({"individualAccountID", "type", "appointmentDate", "clientID"}), frozenset({"type", "clientID"}),
    }


def test_client_list_and_cutoff_reach_the_scan(files):
    visits = scans.scan_visits(files.visits, ["A", "B"])
    assert re.search(r"PushedFilters: \[.*In\(clientID, \[A,B\]\)", executed(visits))
    types = latest_types(files.service_types).select("clientId", "TYPE_ID")
    plan = executed(activity.recent_activity(types, scans.scan_visits(files.visits), AS_OF))
    assert re.search(r"PushedFilters: \[.*Equal\(appointmentDate,2019-06-01", plan)


@pytest.mark.parametrize("build", [
    lambda t: latest_types(t.service_types),
    lambda t: ranking.volume_topk(scans.scan_visits(t.visits)),
    lambda t: ranking.revenue_topk(scans.scan_subscriptions(t.subscriptions)),
])
def test_ranks_are_limited_before_the_shuffle(files, build):
    plan = executed(build(files))
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    limits = [i for i, line in enumerate(lines) if line.startswith("WindowGroupLimit")]
    assert len(limits) == 2
    between = lines[limits[0]:limits[1]]
    assert any(line.startswith("Exchange hashpartitioning") for line in between)


@pytest.mark.parametrize("build", [
    lambda t: ranking.volume_topk(scans.scan_visits(t.visits)),
    lambda t: ranking.volume_share(scans.scan_visits(t.visits)),
    lambda t: ranking.revenue_share(scans.scan_subscriptions(t.subscriptions)),
    lambda t: ranking.revenue_topk(scans.scan_subscriptions(t.subscriptions)),
])
def test_shares_shuffle_their_input_once(files, build):
    plan = executed(build(files))
    assert len(scans_of(plan)) == 1
    assert "ReusedExchange" in plan


def test_cadence_reduces_to_days_before_it_orders(files):
    plan = executed(cadence.account_cadence(scans.scan_visits(files.visits)))
    assert plan.count("Exchange hashpartitioning") == 2
    window = plan.index("Window [")
    assert plan.index("Exchange hashpartitioning", window) > window
    assert re.search(r"partial_count\(1\)", plan)


@pytest.mark.parametrize("build", [
    lambda t: lookup.lookup_attach(latest_types(t.service_types), scans.scan_lookup(t.lookup)),
    lambda t: lookup.repeated_names(latest_types(t.service_types)),
])
def test_joins_by_name_replicate_nothing_and_can_be_split(files, build):
    plan = executed(build(files))
    assert "Generate explode" not in plan and "_salt" not in plan
    join = plan[plan.index("SortMergeJoin"):]
    assert re.search(r"Exchange hashpartitioning\(_key_clientId#[^\n]*ENSURE_REQUIREMENTS", join)
    assert re.search(r"Exchange hashpartitioning\(clientId#[^\n]*ENSURE_REQUIREMENTS", join)


def test_short_client_lists_reach_the_scan_and_long_ones_are_joined(spark, files):
    def plan(n):
        chosen = scans.of_clients(files.visits, [f"c{i}" for i in range(n)], "clientID")
        return chosen._jdf.queryExecution().executedPlan().toString()

    assert "Join" not in plan(scans.MOST_LISTED) and "In(clientID" in plan(5)
    long = plan(scans.MOST_LISTED + 1)
    assert "SortMergeJoin" in long and "GreaterThanOrEqual(clientID,c0)" in long
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "BroadcastHashJoin" in plan(scans.MOST_LISTED + 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2KB")
    assert "BroadcastHashJoin" not in plan(scans.MOST_LISTED + 1)


def test_a_hundred_thousand_names_are_planned_quickly(spark, files):
    names = [f"client {i}" for i in range(100_000)]
    scans.of_clients(files.visits, names[:5000], "clientID").count()
    start = time.perf_counter()
    scans.of_clients(files.visits, names, "clientID")._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 1


@pytest.mark.parametrize("build", [
    lambda t: ranking.volume_share(scans.scan_visits(t.visits)),
])
def test_joins_that_can_meet_a_hot_key_are_salted(files, build):
    plan = executed(build(files))
    assert re.search(r"SortMergeJoin \[_salt#", plan)


def test_audit_never_joins_sources(files):
    plan = executed(audit.source_row_audit(files))
    assert plan.count("SortMergeJoin") == 1  # the lookup fan-out it counts
    assert "Cartesian" not in plan
