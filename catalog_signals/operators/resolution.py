"""From evidence to final signals: priorities, dissent, conflicts, constraints.

All functions expect the evidence columns that ``plans.report.evidence_frame`` produces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.config import (
    DEFAULTS,
    HAS_RESERVICE,
    METRIC_NAMES,
    RECURRING,
    RESERVICE,
    ZERO_TIME,
    ConstraintRule,
    Params,
)
from catalog_signals.functions import evidence as ev
from catalog_signals.functions.evidence import Evidence
from catalog_signals.functions.text import quoted

METRICS = (RECURRING, RESERVICE, ZERO_TIME)


# The reasons that flag and keyword evidence give.
_API_REASONS = {
    RECURRING: "'API derived from flags: freq=' || API_FREQUENCY || ', reservice=' || API_RESERVICE"
    " || ', initial=' || API_INITIAL",
    RESERVICE: "'API RESERVICE rule'",
    ZERO_TIME: "'API DEFAULT_LENGTH rule'",
}
_WORD_REASON = "'Word keywords'"


def evidence_of(metric: str, params: Params = DEFAULTS) -> list[Evidence]:
    """The metric's sources, strongest first."""
    available = {
        "API": (f"flagged_{metric}", _API_REASONS[metric]),
        "Word": (f"word_{metric}", _WORD_REASON),
    }
    if metric == RECURRING:
        available["SalesMapping"] = ("mapping_value", "mapping_reason")
        available["Appointments"] = ("appt_bool", "appt_reason")
    return [Evidence(s, *available[s]) for s in params.priorities[metric] if s in available]


def per_metric(
    df: DataFrame,
    keys: list[str],
    columns: dict[str, Callable[[str, list[Evidence]], str]],
    params: Params = DEFAULTS,
) -> DataFrame:
    """One row per input row and metric, with the given columns: functions from the metric's name and
    evidence to SQL."""
    rows = []
    for metric in METRICS:
        name, sources = METRIC_NAMES[metric], evidence_of(metric, params)
        values = [f"{build(name, sources)} AS {column}" for column, build in columns.items()]
        rows.append(f"struct({quoted(name)} AS metric, {', '.join(values)})")
    return df.selectExpr(*keys, f"inline(array({', '.join(rows)}))")


def priority_resolve(df: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    """Per row and metric the value of the strongest source that has one, its name and reason."""
    columns = {
        "value": lambda _, sources: ev.chosen_value(sources),
        "source": lambda _, sources: ev.chosen_source(sources),
        "reason": lambda _, sources: ev.chosen_reason(sources),
    }
    return per_metric(df, keys, columns, params)


def dissent_reasons(df: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    """Per row and metric with any: the weaker sources that contradict the chosen value."""
    columns = {"dissent": lambda _, sources: ev.dissent(sources)}
    return per_metric(df, keys, columns, params).where("dissent IS NOT NULL")


def top_two_conflicts(df: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    found = per_metric(df, keys, {"reason": ev.top_two_conflict}, params)
    return found.where("reason IS NOT NULL")


def top_vs_rest_conflicts(df: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    found = per_metric(df, keys, {"reason": ev.top_vs_rest_conflict}, params)
    return found.where("reason IS NOT NULL")


def conflict_count(params: Params = DEFAULTS) -> str:
    """Number of conflicts over all metrics. Does not build the texts, so that a filter on it stays
    small when Spark moves it below them."""
    return " + ".join(
        f"int({differ(evidence_of(metric, params))})"
        for metric in METRICS
        for differ in (ev.top_two_differ, ev.top_vs_rest_differ)
    )


def conflict_reason(metric: str, params: Params = DEFAULTS) -> str:
    """Both conflict texts of a metric, joined by ``"; "``; empty if there is no conflict."""
    sources, name = evidence_of(metric, params), METRIC_NAMES[metric]
    texts = [build(name, sources) for build in (ev.top_two_conflict, ev.top_vs_rest_conflict)]
    return f"concat_ws('; ', {', '.join(texts)})"


def conflict_reasons(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds ``conflict_<metric>`` and ``conflicts``, how many there are in all."""
    texts = [f"{conflict_reason(m, params)} AS conflict_{m}" for m in METRICS]
    return df.selectExpr("*", *texts, f"{conflict_count(params)} AS conflicts")


def final_signals(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds the resolved ``final_<signal>`` before any constraint; has_reservice is left to the
    constraints and only falls back to its flag signal where recurring is unknown."""
    resolved = {m: ev.chosen_value(evidence_of(m, params)) for m in METRICS}
    resolved[HAS_RESERVICE] = (
        f"CASE WHEN {resolved[RECURRING]} IS NULL THEN flagged_{HAS_RESERVICE} END"
    )
    return df.selectExpr("*", *[f"{sql} AS final_{signal}" for signal, sql in resolved.items()])


def _broken(rule: ConstraintRule) -> str:
    """Does the row need this correction? A missing target breaks only a rule that wants True."""
    target = f"final_{rule.target} <=> TRUE"
    return f"(final_{rule.given} <=> TRUE AND {f'NOT ({target})' if rule.value else target})"


def constraint_correction(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Applies the constraints to ``final_<signal>`` one after the other; adds ``corrections`` and
    ``violations`` (texts joined by ``"; "``) and ``violation_count``. A has_reservice still unknown
    at the end is False."""
    rules = params.constraints
    for i, rule in enumerate(rules):
        broken, target = _broken(rule), f"final_{rule.target}"
        df = df.withColumns({
            f"_broken_{i}": F.expr(broken),
            target: F.expr(f"CASE WHEN {broken} THEN {rule.value} ELSE {target} END"),
        })
    corrections = [f"CASE WHEN _broken_{i} THEN {quoted(r.correction)} END" for i, r in enumerate(rules)]
    violations = {i: r.violation for i, r in enumerate(rules) if r.violation}
    texts = [f"CASE WHEN _broken_{i} THEN {quoted(v)} END" for i, v in violations.items()]
    count = " + ".join(["0", *[f"int(_broken_{i})" for i in violations]])
    return df.withColumns({
        f"final_{HAS_RESERVICE}": F.expr(f"coalesce(final_{HAS_RESERVICE}, FALSE)"),
        "corrections": F.expr(f"concat_ws({', '.join([quoted('; '), *corrections])})"),
        "violations": F.expr(f"concat_ws({', '.join([quoted('; '), *texts])})"),
        "violation_count": F.expr(count),
    }).drop(*[f"_broken_{i}" for i in range(len(rules))])
