"""Parameters of the analysis. Everything client- or domain-specific lives here."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

RECURRING = "recurring"
RESERVICE = "reservice"
ZERO_TIME = "zero_time"
HAS_RESERVICE = "has_reservice"
SIGNALS = (RECURRING, RESERVICE, ZERO_TIME, HAS_RESERVICE)

#: The six catalogue flags, in scan order; each becomes an ``API_<flag>`` column.
FLAGS = ("RESERVICE", "REGULAR_SERVICE", "FREQUENCY", "DEFAULT_LENGTH", "INITIAL_ID", "INITIAL")


@dataclass(frozen=True)
class FlagRule:
    """``flag <op> operand`` sets ``signal`` to ``value``; a later matching rule wins."""

    flag: str
    op: str
    operand: int
    signal: str
    value: bool


@dataclass(frozen=True)
class ConstraintRule:
    """While ``given`` is true, ``target`` must be ``value``; otherwise it is corrected."""

    given: str
    target: str
    value: bool
    correction: str
    violation: str | None = None


# Substrings looked for in lower-cased descriptions.
KEYWORDS = {
    RESERVICE: ("reservice", "call back", "callback", "qc", "quality control", "quality"),
    RECURRING: (
        "seasonal", "recurring", "monthly", "bi-weekly", "weekly", "quarterly", "yearly", "yard",
        "yard service", "annual", "annually", "bimonthly", "biweekly", "per month", "per week",
        "per quarter", "per year",
    ),
    ZERO_TIME: (
        "equipment", "charge", "lead", "donation", "cancellation", "fee", "write off", "write-off",
        "bait", "payment", "collection", "return", "quote", "free", "billing",
    ),
    HAS_RESERVICE: (
        "bed bug", "carpenter", "roach", "ant", "ants", "cockroach", "termite", "pest", "home",
        "yard",
    ),
}

# Flag rules, in evaluation order.
FLAG_RULES = (
    FlagRule("FREQUENCY", ">", 0, RECURRING, True),
    FlagRule("RESERVICE", "=", 1, RECURRING, False),
    FlagRule("RESERVICE", "=", 1, HAS_RESERVICE, False),
    FlagRule("RESERVICE", "=", 1, RESERVICE, True),
    FlagRule("RESERVICE", "!=", 1, RESERVICE, False),
    FlagRule("DEFAULT_LENGTH", "=", 0, ZERO_TIME, True),
    FlagRule("INITIAL", "=", 1, RECURRING, False),
    FlagRule("INITIAL", "=", 1, RESERVICE, False),
    FlagRule("INITIAL", "=", 1, ZERO_TIME, False),
)

# Business constraints, in evaluation order, with their texts.
CONSTRAINTS = (
    ConstraintRule(
        RECURRING, HAS_RESERVICE, True,
        "Set has_reservice to True due to recurring=True",
    ),
    ConstraintRule(
        ZERO_TIME, HAS_RESERVICE, False,
        "Set has_reservice to False due to zeroVisitTime=True",
        "zeroVisitTime=True cannot have has_reservice=True",
    ),
    ConstraintRule(
        RECURRING, RESERVICE, False,
        "Set isRervice to False due to isRecurring=True",
        "isRecurring=True cannot have isRervice=True",
    ),
    ConstraintRule(
        RESERVICE, HAS_RESERVICE, False,
        "Set has_reservice to False due to isRervice=True",
        "isRervice=True cannot have has_reservice=True",
    ),
)

# Evidence sources per metric, strongest first, and the metric names in reasons.
PRIORITIES = {
    RECURRING: ("SalesMapping", "Appointments", "API", "Word"),
    RESERVICE: ("API", "Word"),
    ZERO_TIME: ("Word", "API"),
}
METRIC_NAMES = {RECURRING: "isRecurring", RESERVICE: "isRervice", ZERO_TIME: "zeroVisitTime"}

# Median days between visits, low inclusive, high exclusive; 150-299 is no cadence.
CADENCE_BANDS = {
    "weekly_biweekly": (20, 50),
    "monthly": (50, 90),
    "bimonthly_quarterly": (90, 150),
    "yearly": (300, 420),
}


@dataclass(frozen=True)
class Params:
    keywords: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: KEYWORDS)
    flag_rules: tuple[FlagRule, ...] = FLAG_RULES
    constraints: tuple[ConstraintRule, ...] = CONSTRAINTS
    priorities: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: PRIORITIES)
    cadence_bands: Mapping[str, tuple[float, float]] = field(default_factory=lambda: CADENCE_BANDS)
    min_visits: int = 3
    strong_ratio: float = 0.6
    activity_years: int = 2
    top_volume: int = 20
    top_revenue: int = 10


DEFAULTS = Params()
