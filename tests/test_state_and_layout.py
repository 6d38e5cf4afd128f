"""Visit history that grows by load date, and reduced inputs laid out by key."""

import random
import re

import pytest
from frames import AS_OF, VISITS, rows, sub_row, tables, type_row, visit_row

from catalog_signals import build_report
from catalog_signals.operators import cadence
from catalog_signals.plans import jobs
from catalog_signals.plans.report import analysed, evidence_frame, reduced_inputs, to_report
from catalog_signals.sources import layout, scans, snapshots, visit_state
from catalog_signals.sources.sinks import read_delivery


def _visits(seed, n):
    rng = random.Random(seed)
    return [
        visit_row(
            rng.choice([None, rng.randint(0, 900), rng.randint(0, 40) * 30, rng.randint(0, 9) + 0.5]),
            rng.choice([None, 1, 2, 3]), rng.choice(["1", "2", "x", None]), rng.choice("AABC"),
        )
        for _ in range(n)
    ]


def _loads(spark, seed):
    """Visits dealt to load dates: parts of one account's day come with different dates."""
    rng = random.Random(seed)
    dates = [f"2024-01-0{d}" for d in range(1, 6)]
    dealt = {d: [] for d in dates}
    for row in _visits(seed, 400):
        dealt[rng.choice(dates)].append(row)
    return {d: spark.createDataFrame(r, VISITS) for d, r in dealt.items()}, [v for r in dealt.values() for v in r]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_loads_gives_the_full_computation(spark, tmp_path, seed):
    loads, everything = _loads(spark, seed)
    full = scans.scan_visits(spark.createDataFrame(everything, VISITS))
    history = rows(cadence.type_history(full, untyped=True), "*")
    accounts = rows(cadence.account_cadence(full), "*")
    folder, dates = str(tmp_path), list(loads)
    random.Random(seed).shuffle(dates)
    first = dates[0]
    # a load that went wrong, and is repeated at the end
    visit_state.load_visits(scans.scan_visits(loads[first].limit(3)), first, folder)
    for date in dates[1:]:
        visit_state.load_visits(scans.scan_visits(loads[date]), date, folder)
    visit_state.load_visits(scans.scan_visits(loads[first]), first, folder)
    days = visit_state.read_days(spark, folder)
    assert rows(cadence.history_of_days(days), "*") == history
    assert rows(cadence.cadence_of_days(days), "*") == accounts
    assert rows(days, "*") == rows(cadence.visits_per_day(full), "*")
    visit_state.close_dates(spark, folder, "2024-01-03")
    assert sorted(snapshots.latest(spark, folder).layers) == ["2024-01-04", "2024-01-05", "upto 2024-01-03"]
    assert rows(cadence.history_of_days(visit_state.read_days(spark, folder)), "*") == history
    with pytest.raises(ValueError):
        visit_state.load_visits(full, "2024-01-02", folder)
    visit_state.load_visits(scans.scan_visits(loads["2024-01-04"]), "2024-01-04", folder)
    visit_state.close_dates(spark, folder, "2024-01-05")
    assert sorted(snapshots.latest(spark, folder).layers) == ["upto 2024-01-05"]
    assert rows(visit_state.read_days(spark, folder), "*") == rows(cadence.visits_per_day(full), "*")
    only = rows(cadence.visits_per_day(scans.scan_visits(spark.createDataFrame(everything, VISITS), ["B"])), "*")
    assert rows(visit_state.read_days(spark, folder, ["B"]), "*") == only
    assert visit_state.read_days(spark, f"{folder}/none").count() == 0


def test_a_load_reads_its_own_visits_only(spark, tmp_path, monkeypatch):
    folder, plans, save = str(tmp_path / "state"), [], snapshots.Snapshot.save
    for date in ("2024-01-01", "2024-01-02"):
        spark.createDataFrame(_visits(3, 50), VISITS).write.parquet(f"{tmp_path}/{date}")

    def noted(self, name, df, *more):
        plans.append({file.rsplit("/", 2)[1] for file in df.inputFiles()})
        return save(self, name, df, *more)

    monkeypatch.setattr(snapshots.Snapshot, "save", noted)
    for date in ("2024-01-01", "2024-01-02"):
        visit_state.load_visits(scans.scan_visits(spark.read.parquet(f"{tmp_path}/{date}")), date, folder)
    assert plans == [{"2024-01-01"}, {"2024-01-02"}]


def _example(spark):
    return tables(
        spark,
        types=[type_row(c, str(t), "x" if t % 2 else f"Monthly {t}", FREQUENCY=str(t % 3)) for c in "ABC" for t in range(6)],
        merged=[(str(t), c, "x") for c in "AB" for t in range(4)],
        visits=_visits(7, 300),
        subs=[sub_row(f"${t}0", str(t), c) for c in "AB" for t in range(4)],
        lookup=[("A", "x", "TRUE"), ("A", "x", "FALSE"), ("B", "Monthly 2", "true")],
    )


def test_a_run_from_the_state_equals_one_from_the_visits(spark, tmp_path):
    inputs, state = _example(spark), str(tmp_path / "state")
    for number, part in enumerate(inputs.visits.randomSplit([0.5, 0.3, 0.2], 1)):
        visit_state.load_visits(scans.scan_visits(part), f"2024-02-0{number + 1}", state)
    # the visits themselves are not read
    unread = tables(spark, visits=[])
    inputs_of_run = type(inputs)(inputs.service_types, inputs.merged_service_types, unread.visits, inputs.subscriptions, inputs.lookup)
    aliases = {"AB": ["A", "B"]}
    for clients, roll_up in ((None, False), (["AB", "C"], True)):
        one = jobs.run_report(inputs_of_run, AS_OF, f"{tmp_path}/a{roll_up}", clients, aliases, roll_up=roll_up, visit_state=state)
        two = jobs.run_report(inputs, AS_OF, f"{tmp_path}/b{roll_up}", clients, aliases, roll_up=roll_up)
        for name in ("report", "audit", "metrics", "mismatches"):
            assert rows(one[name], "*") == rows(two[name], "*"), name
        assert read_delivery(spark, f"{tmp_path}/a{roll_up}").count() == two["report"].count() > 0


def test_laid_out_inputs_join_by_key_without_an_exchange(spark):
    inputs = _example(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        laid = layout.lay_out(inputs, "laid", 3)
        opened = layout.open_layout(spark, "laid")
        expected = rows(build_report(inputs, AS_OF), "*")
        for reductions in (laid, opened):
            assert rows(to_report(analysed(reductions, AS_OF)).drop("copies"), "*") == expected
        plan = evidence_frame(opened, ranks=False)._jdf.queryExecution().executedPlan().toString()
        plain = evidence_frame(reduced_inputs(inputs, lambda _, df: df), ranks=False)._jdf.queryExecution().executedPlan().toString()
        by_type = r"Exchange hashpartitioning\(clientId#\d+, TYPE_ID#\d+L"
        joins = r"SortMergeJoin \[clientId#\d+, TYPE_ID#\d+L\], \[clientId#\d+, TYPE_ID#\d+L\], LeftOuter"
        assert len(re.findall(joins, plan)) == 2 and "Bucketed: true" in plan
        assert re.findall(by_type, plain) and not re.findall(by_type, plan)
        assert "SelectedBucketsCount" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("versions", "names", "history", "usage", "validation"):
            spark.sql(f"DROP TABLE IF EXISTS laid_{name}")
