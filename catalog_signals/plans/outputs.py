"""Views of the finished report: filters, review queues, splits, summaries, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column of the report, name in the review queue.
REVIEW_COLUMNS = {
    "TYPE_ID": "TYPE_ID",
    "DESCRIPTION": "DESCRIPTION",
    "API FREQUENCY FLAG": "Recurrence",
    "Final Has Reservice": "hasReservice",
    "Final Reservice": "isRervice",
    "Final Zero Time": "zeroVisitTime",
    "Appointment Share Pct": "Appointment Share Pct",
    "Client": "clientId",
}

# Column of the report, name in the settled summary.
SUMMARY_COLUMNS = {
    "TYPE_ID": "TYPE_ID",
    "DESCRIPTION": "DESCRIPTION",
    "Final Reservice": "Reservice",
    "Final Recurring": "Recurring",
    "Final Zero Time": "Zero Time",
    "Final Has Reservice": "Has Reservice",
    "API FREQUENCY FLAG": "API FREQUENCY FLAG",
    "API RESERVICE FLAG": "API RESERVICE FLAG",
    "API REGULAR_SERVICE FLAG": "API REGULAR_SERVICE FLAG",
    "API DEFAULT_LENGTH FLAG": "API DEFAULT_LENGTH FLAG",
    "hasVisitsInPast2Years": "hasVisitsInPast2Years",
    "hasActiveSubscription": "hasActiveSubscription",
    "Expired Code": "Expired Code",
    "Client": "Client",
}


def _renamed(report: DataFrame, columns: dict[str, str]) -> DataFrame:
    return report.select(*[F.col(f"`{c}`").alias(name) for c, name in columns.items()])


def activity_filter(report: DataFrame) -> DataFrame:
    """Rows in use; a frame without the two activity columns passes through."""
    needed = {"hasActiveSubscription", "hasVisitsInPast2Years"}
    if not needed <= set(report.columns):
        return report
    return report.where(F.col("hasActiveSubscription") | F.col("hasVisitsInPast2Years"))


def review_queue(report: DataFrame) -> DataFrame:
    """Rows for human review, without expired ones."""
    return _renamed(report.where(F.col("AskClient") & ~F.col("`Expired Code`")), REVIEW_COLUMNS)


def review_queue_unfiltered(report: DataFrame) -> DataFrame:
    """Rows for human review, expired ones included; no share column."""
    columns = {c: n for c, n in REVIEW_COLUMNS.items() if c != "Appointment Share Pct"}
    return _renamed(report.where("AskClient"), columns)


def review_split(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows to ask about, and the settled rows."""
    return report.where("AskClient"), report.where("not AskClient")


def settled_summary(report: DataFrame) -> DataFrame:
    return _renamed(review_split(report)[1], SUMMARY_COLUMNS)


def review_metrics(rows: DataFrame) -> DataFrame:
    """Per client: report rows, conflicts, corrected violations, important rows. Takes the rows of
    ``plans.report.analysed``."""
    def total(column):
        return F.sum(column.cast("bigint") * F.col("copies"))

    return rows.groupBy("clientId").agg(
        F.sum("copies").cast("bigint").alias("report_rows"),
        total(F.col("ask_client")).alias("to_ask"),
        total(F.col("conflicts")).alias("conflicts"),
        total(F.col("violation_count")).alias("violations"),
        total(F.col("volume_reason") != "").alias("high_priority"),
        total(F.col("revenue_reason") != "").alias("high_revenue"),
    )
