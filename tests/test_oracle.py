"""Every registered query against its SQL twin, and the driver's entry points."""

import pytest

import __spark_entry__ as entry_point
from verification.compare import connect, differences
from verification.oracle import ORACLE
from verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

# The queries of the coverage checklist.
REQUIRED = """
    clients_distinct latest_version client_selection tenant_rollup active_subscription recent_activity
    expired_flag activity_filter review_queue review_queue_unfiltered review_split_true settled_summary
    reference_mismatch lookup_attach lookup_attach_fanout api_signals keyword_signals mapping_signal
    priority_resolve dissent_reasons constraint_correction top_two_conflict top_vs_rest_conflict
    review_reasons duplicate_name final_report final_report_unfiltered account_cadence cadence_band
    recurrence_score volume_share volume_topk revenue_share revenue_topk share_report money_parse
    tenant_rollup_facts dedupe_by_key source_row_audit review_metrics table_profile keyword_signals_documents
    tenant_rollup_by_frame account_cadence_of_parts audit_of_reductions delivered_report
""".split()


def test_every_query_is_registered_with_its_twin():
    # operators for training data, where present, are registered beside these and tested on their own
    assert set(REQUIRED) == set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLE.items() <= entry_point.oracle_sql().items()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REQUIRED))
def test_query_equals_its_twin(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert differences(df, duck, entry_point.oracle_sql()[name]) == []


def test_entry(spark):
    types = "SELECT count(DISTINCT (p_type, p_partkey // 10)) FROM part WHERE p_partkey % 101 <> 7"
    expected = connect(entry_point.SMOKE_DIR).execute(types).fetchone()[0]
    assert entry_point.entry(spark).count() == expected
