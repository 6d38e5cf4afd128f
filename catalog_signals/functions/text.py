"""Number and text formatting used in shares and reason texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(col: Column, digits: int = 2) -> Column:
    """Round the scaled double half to even (``round`` would go half up)."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def share_pct(part: Column, total: Column) -> Column:
    """``part`` as a percentage of ``total``, two decimals; NULL unless the total is positive."""
    pct = part.cast("double") / total.cast("double") * 100
    return F.when(total > 0, round_half_even(pct))


def percent_text(ratio: str) -> str:
    """SQL: 0.125 becomes ``12%``, half to even."""
    return f"(bigint(rint({ratio} * 100)) || '%')"


def quoted(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def contains_any(text: str, keywords: Iterable[str]) -> str:
    """SQL: does the column ``text`` hold any keyword as a substring?

    A keyword that contains another one can never decide the outcome, so it is left out of the
    expression ("quality control" never matters next to "quality").
    """
    words = list(dict.fromkeys(keywords))
    needed = [w for w in words if not any(o != w and o in w for o in words)]
    return " OR ".join([f"contains({text}, {quoted(w)})" for w in needed] or ["FALSE"])
