"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import connect, differences

from tidemark.queries.registry import load_all


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query_matches_sql(name, spark, folder, con):
    q = load_all()[name]
    assert q.sql, "queries without SQL need a brute-force test of their own"
    problem = differences(q(spark, folder), con, q.sql)
    assert problem is None or (problem == "EMPTY" and name in MAY_BE_EMPTY), problem


# Nothing qualifies in the smallest tables.
MAY_BE_EMPTY = {"src20_change_log_scan", "srt02_deep_page", "sch02_duplicate_keys", "chg08_drifted_hours", "chg08_reread_rows", "jn05_semi_join"}


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["o_orderstatus", "n", "total"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
