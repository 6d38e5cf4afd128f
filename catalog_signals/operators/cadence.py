"""Recurrence mined from visit histories.

The raw visits are reduced, before any ordering, to one row per (client, type, account, calendar
day). That is exact for everything asked here: visits of one day are less than 24 hours apart, so the
gaps between them are 0 days, and the gap to the next visiting day runs from the day's last visit to
that day's first. The reduction starts inside each task, and an account never has more rows than there
are days, so an account with a third of all visits is ordered as quickly as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_signals.config import DEFAULTS, Params
from catalog_signals.functions.casts import elapsed_days
from catalog_signals.functions.text import percent_text, quoted

_ACCOUNT = ["clientId", "TYPE_ID", "accountId"]

#: Tasks that merge account-days, for every shuffle partition of the session.
SPREAD = 4


def visits_per_day(visits: DataFrame) -> DataFrame:
    """Visits, first and last visit per account and day; undated visits form a NULL day."""
    return visits.groupBy(*_ACCOUNT, F.to_date("visitDate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("visitDate").alias("first"),
        F.max("visitDate").alias("last"),
    )


def merged_days(days: DataFrame) -> DataFrame:
    """One row per account and day out of rows of ``visits_per_day`` of any parts of the visits: a day's
    visits may come in several parts, in any order.

    Dealt by account, which has a row per day and part at most, the rows are merged where they are put in
    order afterwards, in tasks of their own and not in those that reduce the parts. Their number is given,
    so that adaptive execution doesn't gather rows that compress well into few tasks.
    """
    n = SPREAD * int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return days.repartition(n, *_ACCOUNT).groupBy(*_ACCOUNT, "day").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def _in_band(days: str, low: float, high: float) -> str:
    return f"({days} >= {low} AND {days} < {high})"


def in_any_band(days: str, params: Params = DEFAULTS) -> str:
    """SQL: is the median gap ``days`` within a band? False without a gap."""
    hits = [_in_band(days, *band) for band in params.cadence_bands.values()]
    return f"coalesce({' OR '.join(hits or ['FALSE'])}, FALSE)"


def band_name(days: str, params: Params = DEFAULTS) -> str:
    """SQL: name of the band the median gap ``days`` falls into, NULL outside all of them."""
    cases = [
        f"WHEN {_in_band(days, *band)} THEN {quoted(name)}"
        for name, band in params.cadence_bands.items()
    ]
    return f"CASE {' '.join(cases)} END" if cases else "CAST(NULL AS STRING)"


def account_history(daily: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Per account: dated and all visits, latest visit, distinct years, consecutive years, median
    gap in days, band test, strong flag. Consumes ``visits_per_day``."""
    # Rows are sorted by these keys in this order; the most selective one first compares fastest.
    by_day = Window.partitionBy("accountId", "TYPE_ID", "clientId").orderBy("day")
    # The whole account, in the order that lag needs anyway: one pass serves both.
    account = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dated = F.col("day").isNotNull()
    is_first = dated & F.col("previous").isNull()
    year_step = F.year("day") - F.year(F.to_date("previous"))
    spaced = daily.select(
        "*",
        F.lag("last").over(by_day).alias("previous"),
        F.sum(F.when(dated, F.col("n") - 1)).over(account).alias("same_day_gaps"),
    ).select(
        "*",
        is_first.alias("is_first"),
        year_step.alias("year_step"),
        # The first day has no gap of its own and carries all same-day gaps of 0 days instead.
        F.when(is_first, 0).otherwise(elapsed_days(F.col("previous"), F.col("first"))).alias("gap"),
        F.when(is_first, F.col("same_day_gaps")).otherwise(1).alias("gap_weight"),
    )
    median = F.percentile("gap", F.lit(0.5), F.when(dated, F.col("gap_weight")).otherwise(0))
    stats = spaced.groupBy(*_ACCOUNT).agg(
        F.sum(F.when(dated, F.col("n")).otherwise(0)).alias("visits"),
        F.sum("n").alias("all_visits"),
        F.max("last").alias("latest"),
        F.count_if(F.col("is_first") | (F.col("year_step") > 0)).alias("years"),
        F.coalesce(F.bool_or(F.col("year_step") == 1), F.lit(False)).alias("consecutive"),
        median.alias("median_days"),
    )
    in_band = in_any_band("median_days", params)
    steady = f"visits >= {params.min_visits} AND {in_band}"
    return stats.selectExpr("*", f"{in_band} AS in_band", f"consecutive OR ({steady}) AS strong")


def account_cadence(visits: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Cadence per (client, type, account); undated and account-less visits and visits without a
    type drop out before anything is shuffled."""
    usable = visits.dropna(subset=["TYPE_ID", "accountId", "visitDate"])
    return cadence_of_days(visits_per_day(usable), params)


def cadence_of_days(days: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """``account_cadence`` out of account-days, those without a date, an account or a type among them."""
    usable = days.dropna(subset=["TYPE_ID", "accountId", "day"])
    return account_history(usable, params).drop("all_visits", "latest")


def type_history(visits: DataFrame, params: Params = DEFAULTS, untyped: bool = False) -> DataFrame:
    """Per (client, type): all visits, dated visits, latest visit, accounts and strong accounts.

    One pass over the visits serves the volume, the recency and the cadence of a type: visits without
    an account or a date are carried along and left out of the account counts only; with ``untyped``,
    so are those without a type, as the NULL type.
    """
    return history_of_days(visits_per_day(visits if untyped else visits.where("TYPE_ID is not null")), params)


def history_of_days(days: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """``type_history`` out of account-days."""
    accounts = account_history(days, params)
    counted = F.col("accountId").isNotNull() & (F.col("visits") > 0)
    return accounts.groupBy("clientId", "TYPE_ID").agg(
        F.sum("all_visits").alias("type_visits"),
        F.sum("visits").alias("dated_visits"),
        F.max("latest").alias("latest"),
        F.count_if(counted).alias("total_accounts"),
        F.count_if(counted & F.col("strong")).alias("strong_accounts"),
    )


def recurrence_score(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds ``strong_ratio``, ``appt_bool``, ``appt_score``, ``appt_reason``.

    Expects the columns of ``type_history`` (NULL where a type has no visits), ``client_visits``
    (NULL where the client has none) and the boolean ``active``.
    """
    return explain_visitless_clients(score_accounts(df, params))


def explain_visitless_clients(df: DataFrame) -> DataFrame:
    """The reason of a type without visits, where its client has none at all. The other columns of
    the score are the same either way."""
    reason = "if(client_visits IS NULL, 'No appointments for client', appt_reason)"
    return df.withColumn("appt_reason", F.expr(reason))


def score_accounts(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """``recurrence_score`` without regard to the client's other visits."""
    scored = df.withColumns({
        "strong_accounts": F.expr("coalesce(strong_accounts, 0L)"),
        "total_accounts": F.expr("coalesce(total_accounts, 0L)"),
        "strong_ratio": F.expr(
            "CASE WHEN total_accounts > 0 THEN strong_accounts / total_accounts ELSE 0D END"
        ),
        "_missing": F.expr(
            """CASE WHEN type_visits IS NULL THEN 'No appointments for this service type'
                    WHEN dated_visits = 0 THEN 'No valid appointment dates' END"""
        ),
    })
    enough = f"_missing IS NULL AND strong_ratio >= {float(params.strong_ratio)}D"
    some = "_missing IS NULL AND strong_accounts > 0"
    return scored.selectExpr(
        *[f"`{c}`" for c in scored.columns if c != "_missing"],
        f"CASE WHEN {enough} THEN TRUE END AS appt_bool",
        f"CASE WHEN {enough} AND active THEN 1D WHEN {enough} THEN 0.7D WHEN {some} THEN 0.5D "
        "ELSE 0D END AS appt_score",
        f"""coalesce(_missing, concat_ws('; ',
            strong_accounts || '/' || total_accounts || ' accounts strong ('
                || {percent_text('strong_ratio')} || ')',
            CASE WHEN active THEN 'active subscription present' END,
            CASE WHEN {enough} AND active THEN 'meets strong ratio threshold with active subscription'
                 WHEN {enough} THEN 'meets strong ratio threshold'
                 WHEN {some} THEN 'some accounts show recurring, below threshold'
                 ELSE 'no recurring evidence' END)) AS appt_reason""",
    )
