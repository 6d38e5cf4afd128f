"""Boolean signals of a service type from its flags, its description and the sales mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.config import DEFAULTS, FLAGS, SIGNALS, FlagRule, Params
from catalog_signals.functions.casts import clean_text
from catalog_signals.functions.text import contains_any


def _verdict(rules: Sequence[FlagRule]) -> str:
    """The last matching rule's value, False if none matches."""
    whens = [f"WHEN API_{r.flag} {r.op} {r.operand} THEN {r.value}" for r in reversed(rules)]
    return f"CASE {' '.join(whens)} ELSE FALSE END" if whens else "FALSE"


def api_signals(types: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Missing flags become 0; adds ``flagged_<signal>``, the last matching rule's value or False."""
    zeroed = types.withColumns({f"API_{f}": F.expr(f"coalesce(API_{f}, 0L)") for f in FLAGS})
    rules = {s: [r for r in params.flag_rules if r.signal == s] for s in SIGNALS}
    return zeroed.selectExpr("*", *[f"{_verdict(rules[s])} AS flagged_{s}" for s in SIGNALS])


def keyword_signals(
    df: DataFrame, text: str = "DESCRIPTION", params: Params = DEFAULTS
) -> DataFrame:
    """Adds ``word_<signal>``: True if the text holds one of the signal's keywords, else NULL.

    Keywords match anywhere, inside words too ("ant" in "plant").
    """
    lowered = df.selectExpr("*", f"lower(coalesce(`{text}`, '')) AS _text")
    hits = [
        f"CASE WHEN {contains_any('_text', params.keywords[s])} THEN TRUE END AS word_{s}"
        for s in SIGNALS
    ]
    return lowered.selectExpr(*[f"`{c}`" for c in df.columns], *hits)


def mapping_text(col: Column) -> Column:
    """``TRUE`` or ``FALSE`` in any case and with any padding, in upper case; else NULL."""
    text = F.upper(clean_text(col))
    return F.when(text.isin("TRUE", "FALSE"), text)


def mapping_signal(df: DataFrame) -> DataFrame:
    """Adds ``mapping_value`` and ``mapping_reason`` from ``isRecurring``."""
    text = mapping_text(F.col("isRecurring"))
    return df.withColumn("_mapping", text).select(
        *df.columns,
        (F.col("_mapping") == "TRUE").alias("mapping_value"),
        F.concat(F.lit("SalesMapping="), F.col("_mapping")).alias("mapping_reason"),
    )
