"""Resolving one boolean from ordered, partly missing evidence.

A NULL value means "no evidence" and never counts as False. The list of sources is short and fixed,
so each result is one flat SQL expression over the sources' columns, which stays inside generated
code; higher-order array functions would leave it. The functions return SQL text for ``F.expr`` or
``selectExpr``: built from ``Column`` objects, one report would take thousands of calls into the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from catalog_signals.functions.text import quoted


@dataclass(frozen=True)
class Evidence:
    """A source's name, and SQL for its value (NULL if it has none) and the reason it gives."""

    source: str
    value: str
    reason: str


def _case(branches: Sequence[tuple[str, str]], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {condition} THEN {result}" for condition, result in branches)
    return f"CASE {whens} ELSE {otherwise} END"


def chosen_value(evidence: Sequence[Evidence]) -> str:
    """Value of the strongest source that has one."""
    return f"coalesce({', '.join(e.value for e in evidence)})"


def chosen_source(evidence: Sequence[Evidence]) -> str:
    return _case([(f"{e.value} IS NOT NULL", quoted(e.source)) for e in evidence])


def chosen_reason(evidence: Sequence[Evidence]) -> str:
    return _case([(f"{e.value} IS NOT NULL", e.reason) for e in evidence])


def dissent(evidence: Sequence[Evidence], separator: str = "; ") -> str:
    """Every source whose value differs from the chosen one, with its reason; NULL if none does."""
    top = chosen_value(evidence)
    parts = [
        _case([(f"{e.value} <> {top}", f"{quoted(e.source + ' disagrees: ')} || {e.reason}")])
        for e in evidence
    ]
    return f"nullif(concat_ws({quoted(separator)}, {', '.join(parts)}), '')"


def _differing_pairs(evidence: Sequence[Evidence]) -> list[tuple[Evidence, Evidence, str]]:
    """(a, b, "a and b are the two strongest available sources and differ") for all a before b."""
    found = []
    for (i, a), (j, b) in combinations(enumerate(evidence), 2):
        skipped = [f"{e.value} IS NULL" for k, e in enumerate(evidence[:j]) if k != i]
        found.append((a, b, " AND ".join([f"{a.value} <> {b.value}", *skipped])))
    return found


def top_two_differ(evidence: Sequence[Evidence]) -> str:
    """Do the two strongest available sources differ? False with fewer than two."""
    pairs = [f"({differ})" for _, _, differ in _differing_pairs(evidence)]
    return f"coalesce({' OR '.join(pairs)}, FALSE)" if pairs else "FALSE"


def top_two_conflict(metric: str, evidence: Sequence[Evidence]) -> str:
    """``metric: A=x vs B=y`` when the two strongest available sources differ, else NULL."""
    if len(evidence) < 2:
        return "CAST(NULL AS STRING)"
    return _case([
        (f"{differ} AND {a.value} = {top}", quoted(f"{metric}: {a.source}={top} vs {b.source}={not top}"))
        for a, b, differ in _differing_pairs(evidence)
        for top in (True, False)
    ])


def top_vs_rest_differ(evidence: Sequence[Evidence]) -> str:
    """Does the strongest available source differ from all others? False if there are no others."""
    if len(evidence) == 2:
        return top_two_differ(evidence)
    saying = {
        value: " + ".join(f"int({e.value} <=> {value})" for e in evidence) for value in (True, False)
    }
    top = chosen_value(evidence)
    return _case(
        [(f"{top} = {v}", f"{saying[v]} = 1 AND {saying[not v]} > 0") for v in (True, False)], "FALSE"
    )


def top_vs_rest_conflict(metric: str, evidence: Sequence[Evidence]) -> str:
    """``metric: A=x vs others=['B=y', ...]`` when the strongest available source differs from every
    other available one (at least one), else NULL."""
    if len(evidence) < 2:
        return "CAST(NULL AS STRING)"

    if len(evidence) == 2:
        a, b = evidence
        return _case([
            (
                f"{a.value} = {top} AND {b.value} = {not top}",
                quoted(f"{metric}: {a.source}={top} vs others=['{b.source}={not top}']"),
            )
            for top in (True, False)
        ])

    def text(top: bool) -> str:
        leader = _case([(f"{e.value} IS NOT NULL", quoted(f"{e.source}={top}")) for e in evidence])
        others = [_case([(f"{e.value} = {not top}", quoted(f"{e.source}={not top}"))]) for e in evidence]
        listed = f"""concat_ws("', '", {', '.join(others)})"""
        return f"""{quoted(metric + ': ')} || {leader} || " vs others=['" || {listed} || "']\""""

    differ, top = top_vs_rest_differ(evidence), chosen_value(evidence)
    return _case([(differ, _case([(f"{top} = {v}", text(v)) for v in (True, False)]))])
