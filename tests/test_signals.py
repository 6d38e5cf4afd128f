"""Flag rules, keywords, mapping, evidence resolution and constraints, against small plain models."""

import itertools

import pytest
from pyspark.sql import functions as F

from catalog_signals.config import DEFAULTS, FLAGS, KEYWORDS, SIGNALS, Params
from catalog_signals.functions import evidence as ev
from catalog_signals.functions.evidence import Evidence
from catalog_signals.operators import resolution, signals


def model_flags(freq, reservice, length, initial):
    return {
        "recurring": freq > 0 and reservice != 1 and initial != 1,
        "reservice": reservice == 1 and initial != 1,
        "zero_time": length == 0 and initial != 1,
        "has_reservice": False,
    }


def model_conflicts(metric, sources):
    known = [(n, v) for n, v in sources if v is not None]
    two = rest = None
    if len(known) > 1 and known[0][1] != known[1][1]:
        two = f"{metric}: {known[0][0]}={known[0][1]} vs {known[1][0]}={known[1][1]}"
    if len(known) > 1 and all(v != known[0][1] for _, v in known[1:]):
        others = [f"{n}={v}" for n, v in known[1:]]
        rest = f"{metric}: {known[0][0]}={known[0][1]} vs others={others}"
    return two, rest


def test_truth_table(spark):
    """Every combination of flags, keywords, mapping and cadence evidence."""
    combos = list(
        itertools.product(
            (0, 1, 30), (0, 1, 2), (0, 15), (0, 1),
            (None, True), (None, True), (None, True), (None, True, False), (None, True),
        )
    )
    schema = (
        "id int, API_FREQUENCY bigint, API_RESERVICE bigint, API_DEFAULT_LENGTH bigint, "
        "API_INITIAL bigint, word_recurring boolean, word_reservice boolean, word_zero_time boolean, "
        "mapping_value boolean, appt_bool boolean"
    )
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(combos)], schema).selectExpr(
        "*", "0L AS API_REGULAR_SERVICE", "0L AS API_INITIAL_ID", "'visits' AS appt_reason",
        "concat('SalesMapping=', upper(string(mapping_value))) AS mapping_reason",
    )
    found = resolution.constraint_correction(
        resolution.final_signals(resolution.conflict_reasons(signals.api_signals(df)))
    )
    assert found.count() == len(combos)
    for row in found.collect():
        freq, reservice, length, initial, w_rec, w_res, w_zero, mapping, appt = combos[row.id]
        api = model_flags(freq, reservice, length, initial)
        assert {s: row[f"flagged_{s}"] for s in SIGNALS} == api
        recurring = next(v for v in (mapping, appt, api["recurring"]) if v is not None)
        zero = api["zero_time"] if w_zero is None else w_zero
        finals = (recurring, api["reservice"] and not recurring, zero, recurring and not zero)
        assert tuple(row[f"final_{s}"] for s in SIGNALS) == finals
        violations = []
        if recurring and zero:
            violations.append("zeroVisitTime=True cannot have has_reservice=True")
        if recurring and api["reservice"]:
            violations.append("isRecurring=True cannot have isRervice=True")
        assert row.violations == "; ".join(violations)
        assert row.violation_count == len(violations)
        corrections = ["Set has_reservice to True due to recurring=True"] * recurring
        if recurring and zero:
            corrections.append("Set has_reservice to False due to zeroVisitTime=True")
        if recurring and api["reservice"]:
            corrections.append("Set isRervice to False due to isRecurring=True")
        assert row.corrections == "; ".join(corrections)
        expected = {
            "recurring": model_conflicts(
                "isRecurring",
                [("SalesMapping", mapping), ("Appointments", appt), ("API", api["recurring"]), ("Word", w_rec)],
            ),
            "reservice": model_conflicts("isRervice", [("API", api["reservice"]), ("Word", w_res)]),
            "zero_time": model_conflicts("zeroVisitTime", [("Word", w_zero), ("API", api["zero_time"])]),
        }
        for metric, texts in expected.items():
            assert row[f"conflict_{metric}"] == "; ".join(t for t in texts if t)
        assert row.conflicts == sum(t is not None for texts in expected.values() for t in texts)
        if expected["recurring"][1]:
            assert expected["recurring"][0], "top-versus-rest implies top-two for recurring"


@pytest.mark.parametrize("names", [("A",), ("A", "B"), ("A", "B", "C"), ("A", "B", "C", "D"), tuple("ABCDE")])
def test_evidence_functions_for_any_number_of_sources(spark, names):
    combos = list(itertools.product((None, True, False), repeat=len(names)))
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(combos)],
        ", ".join(["id int", *[f"{n} boolean" for n in names]]),
    )
    sources = [Evidence(n, n, f"'why {n}'") for n in names]
    found = df.selectExpr(
        "id",
        f"{ev.chosen_value(sources)} AS value",
        f"{ev.chosen_source(sources)} AS source",
        f"{ev.chosen_reason(sources)} AS reason",
        f"{ev.dissent(sources)} AS dissent",
        f"{ev.top_two_conflict('m', sources)} AS two",
        f"{ev.top_vs_rest_conflict('m', sources)} AS rest",
        f"{ev.top_two_differ(sources)} AS two_differ",
        f"{ev.top_vs_rest_differ(sources)} AS rest_differ",
    )
    for row in found.collect():
        pairs = list(zip(names, combos[row.id], strict=True))
        known = [(n, v) for n, v in pairs if v is not None]
        top = known[0] if known else (None, None)
        assert (row.source, row.value) == top
        assert row.reason == (f"why {top[0]}" if known else None)
        contrary = [f"{n} disagrees: why {n}" for n, v in known if v != top[1]]
        assert row.dissent == ("; ".join(contrary) or None)
        two, rest = model_conflicts("m", pairs)
        assert (row.two, row.rest) == (two, rest)
        assert (row.two_differ, row.rest_differ) == (two is not None, rest is not None)


def test_names_with_quotes_are_kept(spark):
    sources = [Evidence("it's", "a", "'x'"), Evidence("b\\c", "b", "'y'")]
    df = spark.sql("SELECT TRUE AS a, FALSE AS b")
    got = df.select(F.expr(ev.top_two_conflict("m'n", sources))).first()[0]
    assert got == "m'n: it's=True vs b\\c=False"


def test_missing_flags_count_as_zero(spark):
    df = spark.createDataFrame([(None,) * 6], ", ".join(f"API_{f} bigint" for f in FLAGS))
    row = signals.api_signals(df).first()
    assert [row[f"API_{f}"] for f in FLAGS] == [0] * 6
    assert row.flagged_zero_time is True  # a missing length counts as 0


KEYWORD_CASES = {
    "Plant care": {"has_reservice"},  # "ant"
    "Coffee delivery": {"zero_time"},  # "fee"
    "MONTHLY Pest Control": {"recurring", "has_reservice"},
    "Quality visit": {"reservice"},
    "call  back": set(),
    "write-off": {"zero_time"},
    "": set(),
    None: set(),
}


def test_keywords_match_inside_words(spark):
    df = spark.createDataFrame([(t,) for t in KEYWORD_CASES], "DESCRIPTION string")
    for row in signals.keyword_signals(df).collect():
        hits = {s for s in SIGNALS if row[f"word_{s}"] is not None}
        assert hits == KEYWORD_CASES[row.DESCRIPTION]
        assert all(row[f"word_{s}"] is True for s in hits)


def test_dropping_implied_keywords_changes_nothing(spark):
    texts = [w for words in KEYWORDS.values() for w in words] + ["x" + w + "y" for w in KEYWORDS["recurring"]]
    df = spark.createDataFrame([(t,) for t in texts], "DESCRIPTION string")
    for row in signals.keyword_signals(df).collect():
        for signal, words in KEYWORDS.items():
            assert (row[f"word_{signal}"] is True) == any(w in row.DESCRIPTION for w in words)


def test_a_lexicon_may_be_empty_or_hold_quotes(spark):
    params = Params(keywords={**KEYWORDS, "recurring": (), "reservice": ("client's",)})
    df = spark.createDataFrame([("The client's visit",)], "DESCRIPTION string")
    row = signals.keyword_signals(df, params=params).first()
    assert (row.word_recurring, row.word_reservice) == (None, True)


def test_mapping_signal(spark):
    cases = {
        "TRUE": (True, "SalesMapping=TRUE"), " true\n": (True, "SalesMapping=TRUE"),
        "False": (False, "SalesMapping=FALSE"), "yes": (None, None), "": (None, None), None: (None, None),
    }
    df = spark.createDataFrame([(t,) for t in cases], "isRecurring string")
    for row in signals.mapping_signal(df).collect():
        assert (row.mapping_value, row.mapping_reason) == cases[row.isRecurring]


def test_rules_can_be_replaced(spark):
    params = Params(flag_rules=tuple(r for r in DEFAULTS.flag_rules if r.flag != "INITIAL"))
    df = spark.createDataFrame([(0, 0, 30, 30, 0, 1)], ", ".join(f"API_{f} bigint" for f in FLAGS))
    assert signals.api_signals(df, params).first().flagged_recurring is True
    assert signals.api_signals(df).first().flagged_recurring is False
