"""Visit histories against a plain per-row model."""

import datetime as dt
import math
import random
import statistics

import pytest
from frames import VISITS, rows, visit_row
from pyspark.sql import functions as F

from catalog_signals.config import CADENCE_BANDS, DEFAULTS
from catalog_signals.operators import cadence
from catalog_signals.sources.scans import scan_visits

COLUMNS = ["visits", "years", "consecutive", "median_days", "in_band", "strong"]


def visits_frame(spark, data):
    return scan_visits(spark.createDataFrame(list(data), VISITS))


def model(dates):
    dates = sorted(dates)
    gaps = [(b - a) // dt.timedelta(days=1) for a, b in zip(dates, dates[1:])]
    years = {d.year for d in dates}
    consecutive = any(y + 1 in years for y in years)
    median = float(statistics.median(gaps)) if gaps else None
    in_band = median is not None and any(lo <= median < hi for lo, hi in CADENCE_BANDS.values())
    return (len(dates), len(years), consecutive, median, in_band, consecutive or (len(dates) >= 3 and in_band))


def one_account(spark, days):
    return tuple(cadence.account_cadence(visits_frame(spark, [visit_row(d) for d in days])).select(COLUMNS).first())


@pytest.mark.parametrize(
    ("gap", "in_band"),
    [(19, False), (20, True), (49, True), (50, True), (149, True), (150, False), (299, False), (300, True),
     (419, True), (420, False)],
)
def test_band_edges(spark, gap, in_band):
    got = one_account(spark, [0, gap, 2 * gap])
    assert got[3:5] == (float(gap), in_band)


def test_band_names(spark):
    days = [19.5, 20, 50, 89.5, 90, 150, 299, 300, 420, None]
    names = [None, "weekly_biweekly", "monthly", "monthly", "bimonthly_quarterly", None, None, "yearly", None, None]
    df = spark.createDataFrame([(float(d) if d is not None else None,) for d in days], "d double")
    assert [r[0] for r in df.select(F.expr(cadence.band_name("d"))).collect()] == names


def test_two_visits_are_too_few_for_a_cadence(spark):
    assert one_account(spark, [0, 30]) == (2, 1, False, 30.0, True, False)
    assert one_account(spark, [0, 30, 60]) == (3, 1, False, 30.0, True, True)
    assert one_account(spark, [5]) == (1, 1, False, None, False, False)


def test_consecutive_years_need_no_cadence(spark):
    assert one_account(spark, [364, 366])[2] is True  # 30 December and 1 January: both in 2020
    assert one_account(spark, [365, 366]) == (2, 2, True, 1.0, False, True)
    assert one_account(spark, [0, 800])[1:3] == (2, False)  # 2020 and 2022


def test_gaps_are_elapsed_days(spark):
    assert one_account(spark, [23 / 24, 25 / 24])[3] == 0.0
    assert one_account(spark, [0.5, 30.25, 60.75])[3] == 29.5  # 29 and 30


def test_same_day_visits_count_as_gaps_of_zero(spark):
    assert one_account(spark, [0, 0, 30, 60]) == (4, 1, False, 30.0, True, True)
    assert one_account(spark, [0, 0.1, 0.2, 0.3, 30, 60])[3] == 0.0
    assert one_account(spark, [0, 0])[3] == 0.0


def random_visits(seed, clients="AB", types=("1", "2", "x", None), accounts=(1, 2, 3, None), n=900):
    rng = random.Random(seed)
    spread = rng.choice([20, 200, 1500])
    steps = rng.choice([1, 24, 240])
    return [
        visit_row(
            day=None if rng.random() < 0.05 else rng.randrange(spread * steps) / steps,
            account=rng.choice(accounts), type_id=rng.choice(types), client=rng.choice(clients),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(6))
def test_random_histories_equal_the_model(spark, seed):
    data = random_visits(seed)
    groups = {}
    for account, type_id, when, client, _ in data:
        if type_id in ("1", "2") and account is not None and when is not None:
            groups.setdefault((client, int(type_id), account), []).append(when)
    expected = {key: model(dates) for key, dates in groups.items()}
    got = cadence.account_cadence(visits_frame(spark, data)).collect()
    assert {(r.clientId, r.TYPE_ID, r.accountId): tuple(r[c] for c in COLUMNS) for r in got} == expected


@pytest.mark.parametrize("seed", range(3))
def test_type_history_counts_everything_and_scores_accounts(spark, seed):
    data = random_visits(seed)
    got = {(r.clientId, r.TYPE_ID): r for r in cadence.type_history(visits_frame(spark, data)).collect()}
    keys = {(v[3], int(v[1])) for v in data if v[1] in ("1", "2")}
    assert set(got) == keys
    for client, type_id in keys:
        mine = [v for v in data if v[3] == client and v[1] == str(type_id)]
        dated = [v for v in mine if v[2] is not None]
        accounts = {v[0] for v in dated if v[0] is not None}
        strong = [a for a in accounts if model([v[2] for v in dated if v[0] == a])[5]]
        row = got[client, type_id]
        assert (row.type_visits, row.dated_visits, row.latest) == (len(mine), len(dated), max(v[2] for v in dated))
        assert (row.total_accounts, row.strong_accounts) == (len(accounts), len(strong))


def test_a_hot_account_is_reduced_before_it_is_ordered(spark):
    """One account with most of the visits: what is ordered is days, not visits."""
    data = [visit_row(day=i % 90 + i / 100_000, account=1) for i in range(20_000)]
    data += [visit_row(day=i, account=i) for i in range(50)]
    visits = visits_frame(spark, data)
    assert cadence.visits_per_day(visits).where("accountId = 1").count() <= 91
    got = cadence.account_cadence(visits).where("accountId = 1").select(COLUMNS).first()
    assert tuple(got) == model([v[2] for v in data if v[0] == 1])


SCORES = "client_visits bigint, type_visits bigint, dated_visits bigint, total_accounts bigint, strong_accounts bigint, active boolean"
LADDER = [
    ((None, None, None, None, None, True), None, 0.0, "No appointments for client"),
    ((5, None, None, None, None, True), None, 0.0, "No appointments for this service type"),
    ((5, 3, 0, 0, 0, True), None, 0.0, "No valid appointment dates"),
    ((5, 3, 3, 5, 3, True), True, 1.0,
     "3/5 accounts strong (60%); active subscription present; meets strong ratio threshold with active subscription"),
    ((5, 3, 3, 5, 3, False), True, 0.7, "3/5 accounts strong (60%); meets strong ratio threshold"),
    ((5, 3, 3, 8, 1, False), None, 0.5, "1/8 accounts strong (12%); some accounts show recurring, below threshold"),
    ((5, 3, 3, 8, 3, True), None, 0.5,
     "3/8 accounts strong (38%); active subscription present; some accounts show recurring, below threshold"),
    ((5, 3, 3, 4, 0, True), None, 0.0, "0/4 accounts strong (0%); active subscription present; no recurring evidence"),
    ((5, 3, 3, 0, 0, False), None, 0.0, "0/0 accounts strong (0%); no recurring evidence"),
]


@pytest.mark.parametrize(("stats", "verdict", "score", "reason"), LADDER)
def test_score_ladder(spark, stats, verdict, score, reason):
    row = cadence.recurrence_score(spark.createDataFrame([stats], SCORES)).first()
    assert (row.appt_bool, row.appt_score, row.appt_reason) == (verdict, score, reason)


def test_threshold_agrees_with_division(spark):
    pairs = [(s, t) for t in range(1, 41) for s in range(t + 1)]
    df = spark.createDataFrame([(9, 9, 9, t, s, False) for s, t in pairs], SCORES)
    for row in cadence.recurrence_score(df).collect():
        ratio = row.strong_accounts / row.total_accounts
        assert math.isclose(row.strong_ratio, ratio, abs_tol=0)
        assert (row.appt_bool is True) == (ratio >= DEFAULTS.strong_ratio)
        assert f"({ratio:.0%})" in row.appt_reason


def test_input_order_is_irrelevant(spark):
    data = random_visits(11, n=300)
    expected = rows(cadence.account_cadence(visits_frame(spark, data)), "clientId", "TYPE_ID", "accountId", *COLUMNS)
    random.Random(1).shuffle(data)
    again = cadence.account_cadence(visits_frame(spark, data).repartition(5))
    assert rows(again, "clientId", "TYPE_ID", "accountId", *COLUMNS) == expected


def test_days_are_merged_in_tasks_of_their_own(spark):
    """Memory: the tasks that reduce the parts don't merge them too, and rows that compress well stay spread."""
    data = [visit_row(day=i % 40, account=i % 7) for i in range(300)]
    visits = visits_frame(spark, data)
    parts = [cadence.visits_per_day(visits.where(F.col("visitDate") < "2020-01-15")), cadence.visits_per_day(visits)]
    merged = cadence.merged_days(parts[0].unionByName(parts[1]))
    assert merged.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["clientId", "TYPE_ID", "accountId", "day"]
    found = {tuple(r)[:4]: tuple(r)[4:] for r in merged.select(*keys, "n", "first", "last").collect()}
    whole = {tuple(r)[:4]: tuple(r)[4:] for r in parts[1].select(*keys, "n", "first", "last").collect()}
    twice = {tuple(r)[:4] for r in parts[0].select(*keys).collect()}
    assert found == {k: (v[0] * (1 + (k in twice)), *v[1:]) for k, v in whole.items()}
    executed = cadence.cadence_of_days(merged)
    executed.collect()
    plan = executed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 3


def test_stand_in_visits_are_joined_in_many_tasks(spark, tmp_path):
    """Memory: the two large tables are dealt by key into a given number of tasks, and no row is lost by that."""
    from verification.standin import stand_in

    spark.sql("SELECT id AS l_orderkey, 1 AS l_linenumber, DATE'2020-01-01' AS l_shipdate, 2.0 AS l_extendedprice FROM range(9)").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, 3 AS o_custkey FROM range(8)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS p_partkey, 'SMALL' AS p_type FROM range(9)").write.parquet(f"{tmp_path}/part.parquet")
    visits = stand_in(spark, str(tmp_path), "appointments")
    assert visits.count() == 8
    assert visits.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
