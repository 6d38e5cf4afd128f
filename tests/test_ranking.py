import random

from frames import SUBSCRIPTIONS, VISITS, rows, sub_row, visit_row

from catalog_signals.config import Params
from catalog_signals.operators import ranking
from catalog_signals.operators.spread import SALTS, spread_join
from catalog_signals.sources.scans import scan_subscriptions, scan_visits


def visits(spark, data):
    return scan_visits(spark.createDataFrame(list(data), VISITS))


def subs(spark, data):
    return scan_subscriptions(spark.createDataFrame(list(data), SUBSCRIPTIONS))


def test_volume_share_leaves_out_visits_without_a_type(spark):
    df = visits(spark, [visit_row(type_id=t) for t in ["1"] * 3 + ["2", "bad", None]])
    assert rows(ranking.volume_share(df), "clientId", "TYPE_ID", "n", "share_pct") == [
        ("A", 1, 3, 75.0), ("A", 2, 1, 25.0),
    ]


def test_shares_are_rounded_half_to_even(spark):
    data = [visit_row(type_id="1")] + [visit_row(type_id="2")] * 799
    assert rows(ranking.volume_share(visits(spark, data)), "TYPE_ID", "share_pct") == [(1, 0.12), (2, 99.88)]


def test_ties_at_the_cut_go_to_the_lowest_ids(spark):
    data = [visit_row(type_id=str(t)) for t in range(25)] + [visit_row(type_id=None)] * 5
    top = ranking.volume_topk(visits(spark, data))
    assert rows(top, "rank", "TYPE_ID") == sorted(((t + 1, t) for t in range(20)), key=repr)


def test_top_k_is_per_client_and_shares_are_of_all_visits(spark):
    data = [visit_row(client=c, type_id=str(t)) for c in "AB" for t in range(4) for _ in range(t + 1)]
    top = ranking.volume_topk(visits(spark, data), Params(top_volume=2))
    assert rows(top, "clientId", "rank", "TYPE_ID", "n", "share_pct") == [
        ("A", 1, 3, 4, 40.0), ("A", 2, 2, 3, 30.0), ("B", 1, 3, 4, 40.0), ("B", 2, 2, 3, 30.0),
    ]


def test_revenue_counts_active_readable_amounts(spark):
    data = [
        sub_row("$100.00", "1"), sub_row("(20)", "1"), sub_row("$20", "2"),
        sub_row("$999", "2", active=False), sub_row("$999", "2", cancelled=visit_row(1)[2]),
        sub_row("$999", "x"), sub_row("n/a", "3"), sub_row("$999", "1", client="B"),
    ]
    got = ranking.revenue_share(subs(spark, data))
    assert [(c, t, float(r), s) for c, t, r, s in rows(got, "clientId", "TYPE_ID", "revenue", "share_pct")] == [
        ("A", 1, 80.0, 80.0), ("A", 2, 20.0, 20.0), ("B", 1, 999.0, 100.0),
    ]


def test_no_shares_without_a_positive_total(spark):
    data = [sub_row("n/a"), sub_row("(50)", client="B"), sub_row("$20", "2", client="B"),
            sub_row("5", client="C"), sub_row("(5)", "2", client="C")]
    assert rows(ranking.revenue_share(subs(spark, data)), "clientId") == []
    assert rows(ranking.revenue_topk(subs(spark, data)), "clientId") == []
    assert rows(ranking.active_revenue(subs(spark, data)), "clientId", "TYPE_ID")[0] == ("A", 1)


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    data = [sub_row(a, str(i % 3)) for i, a in enumerate(["0.1", "0.2", "0.3", "1e6", "(0.7)"] * 40)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        got = ranking.revenue_topk(subs(spark, sorted(data, key=lambda r: r[1])).repartition(7))
        results.add(tuple(rows(got, "rank", "TYPE_ID", "revenue", "share_pct")))
    assert len(results) == 1


def test_shares_of_a_client_add_up(spark):
    rng = random.Random(5)
    data = [visit_row(client=rng.choice("ABC"), type_id=str(rng.randrange(30))) for _ in range(3000)]
    for _, shares in visits(spark, data).sparkSession.createDataFrame(
        rows(ranking.volume_share(visits(spark, data)), "clientId", "share_pct"), "c string, s double"
    ).groupBy("c").agg({"s": "sum"}).collect():
        assert abs(shares - 100) <= 0.01 * 30


def test_spread_join_equals_a_plain_join_and_spreads_a_hot_key(spark):
    rng = random.Random(2)
    left = spark.createDataFrame(
        [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), i) for i in range(2000)], "k string, id bigint"
    )
    right = spark.createDataFrame([("hot", 1), ("a", 2), (None, 3), ("unused", 4)], "k string, v bigint")
    plain = left.join(right, "k", "left").select("k", "id", "v")
    assert rows(spread_join(left, right, ["k"], ["id"]), "k", "id", "v") == rows(plain, "k", "id", "v")
    renamed = right.withColumnRenamed("k", "k2")
    safe = left.join(renamed, left.k.eqNullSafe(renamed.k2), "left").select("k", "id", "v")
    got = spread_join(left, right, ["k"], ["id"], null_safe=["k"])
    assert rows(got, "k", "id", "v") == rows(safe, "k", "id", "v")
    inner = left.join(right, "k").select("k", "id", "v")
    assert rows(spread_join(left, right, ["k"], ["id"], "inner"), "k", "id", "v") == rows(inner, "k", "id", "v")

    from pyspark.sql import functions as F

    salts = left.where("k = 'hot'").select(F.xxhash64("id").bitwiseAND(SALTS - 1).alias("s"))
    per_salt = [r["count"] for r in salts.groupBy("s").count().collect()]
    assert len(per_salt) == SALTS and max(per_salt) < 3 * sum(per_salt) / SALTS
