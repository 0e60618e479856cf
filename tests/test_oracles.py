"""Registered queries against their SQL statements at the smallest scale.

``ORACLE_QUERIES=all`` runs every query; by default the long multi-table flows, which the other tests cover on
small fixtures, are left to ``tools/compare.py``.
"""

import os
import re

import pytest

import __spark_entry__ as entry
from tools.compare import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LONG = {
    "warehouse_load", "load_all_or_nothing", "backfill_equals_loop", "late_partition_repair", "daily_flow_features",
    "ingest_all_sources", "lineage_counts", "lineage_consistency", "gate_raw_defects", "upsert_buckets",
    "gate_summary", "gate_staged", "gate_staged_defects", "gate_curated", "gate_curated_defects", "constraint_violations",
    "profile_columns", "format_roundtrip_fidelity", "format_inferred_fidelity", "usage_summary",
}
# the queries of the optional subpackage have tests of their own
NAMES = sorted(n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in NAMES if n not in LONG or os.environ.get("ORACLE_QUERIES") == "all"])
def test_query_equals_sql(spark, con, name):
    ok, rows, message = compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, message
    assert rows > 0


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql())
