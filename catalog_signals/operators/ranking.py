"""Volume and revenue per type: counts, shares of the client's total, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_signals.config import DEFAULTS, Params
from catalog_signals.functions.casts import EXACT_MONEY
from catalog_signals.functions.text import share_pct
from catalog_signals.operators.spread import spread_join

_TYPE = ["clientId", "TYPE_ID"]


def visit_counts(visits: DataFrame) -> DataFrame:
    """Visits per (client, type); visits without a usable type form the NULL type."""
    return visits.groupBy(*_TYPE).agg(F.count(F.lit(1)).alias("n"))


def active_revenue(subscriptions: DataFrame) -> DataFrame:
    """Revenue per (client, type) over active subscriptions. A row exists wherever there is an active
    subscription; its revenue is NULL if no amount is readable, or none fits the money type."""
    return (
        subscriptions.where("isActive and TYPE_ID is not null")
        .groupBy(*_TYPE)
        .agg(F.try_sum(F.col("amount").try_cast(EXACT_MONEY)).alias("revenue"))
    )


def unread_amount() -> Column:
    """Is an amount given that can't be summed?"""
    return F.col("amountText").isNotNull() & F.col("amount").try_cast(EXACT_MONEY).isNull()


def subscription_facts(subscriptions: DataFrame) -> DataFrame:
    """Per (client, type), the NULL type included: subscriptions, unread amounts, active subscriptions and
    their revenue. One pass serves the report and the audit."""
    money = F.when(F.col("isActive"), F.col("amount").try_cast(EXACT_MONEY))
    return subscriptions.groupBy(*_TYPE).agg(
        F.count(F.lit(1)).alias("subscriptions"),
        F.count_if(unread_amount()).alias("unread"),
        F.count_if("isActive").alias("active_subscriptions"),
        F.try_sum(money).alias("revenue"),
    )


def revenue_of_facts(facts: DataFrame) -> DataFrame:
    """``active_revenue`` out of ``subscription_facts``."""
    return facts.where("active_subscriptions > 0 and TYPE_ID is not null").select(*_TYPE, "revenue")


def with_client_total(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds per-client totals to per-type rows; the types of a huge client are spread."""
    return spread_join(df, totals, ["clientId"], ["TYPE_ID"])


def share_of_client(df: DataFrame, value: str, share: str) -> DataFrame:
    """Adds ``share``, the row's percentage of its client's total ``value``.

    The total is aggregated and joined back. A window over the client would gather all of a client's
    rows in one task; this way each task reduces its rows to one per client first.
    """
    totals = df.groupBy("clientId").agg(F.try_sum(value).alias("_total"))
    joined = with_client_total(df, totals)
    return joined.withColumn(share, share_pct(F.col(value), F.col("_total")))


def top_k(df: DataFrame, value: str, k: int, rank: str = "rank") -> DataFrame:
    """The ``k`` types of each client with the greatest ``value``, ties by type id.

    Spark applies the limit in every task before the shuffle (WindowGroupLimit). Rows without a type
    or a value sort last and are dropped after ranking: dropping them first would send a predicate of
    its own down to the scan and keep Spark from reusing the shuffle that the totals read.
    """
    unranked = F.col("TYPE_ID").isNull() | F.col(value).isNull()
    window = Window.partitionBy("clientId").orderBy(unranked, F.desc(value), F.asc("TYPE_ID"))
    ranked = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    return ranked.where(~unranked)


def volume_share(visits: DataFrame) -> DataFrame:
    """Visits and their share per type, over the visits that have a type."""
    counts = visit_counts(visits.where("TYPE_ID is not null"))
    return share_of_client(counts, "n", "share_pct").drop("_total")


def volume_topk(visits: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    counts = visit_counts(visits.where("TYPE_ID is not null"))
    ranked = top_k(counts, "n", params.top_volume)
    totals = counts.groupBy("clientId").agg(F.sum("n").alias("_total"))
    joined = with_client_total(ranked, totals)
    return joined.withColumn("share_pct", share_pct(F.col("n"), F.col("_total"))).drop("_total")


def revenue_with_total(subscriptions: DataFrame) -> DataFrame:
    """Revenue per type with the client's total in ``_total``; clients without a positive total drop
    out, as they have neither shares nor ranks."""
    shares = share_of_client(active_revenue(subscriptions), "revenue", "share_pct")
    return shares.where("_total > 0 and revenue is not null")


def revenue_share(subscriptions: DataFrame) -> DataFrame:
    return revenue_with_total(subscriptions).drop("_total")


def revenue_topk(subscriptions: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    ranked = top_k(revenue_with_total(subscriptions), "revenue", params.top_revenue)
    return ranked.drop("_total")
