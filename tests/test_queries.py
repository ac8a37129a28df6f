"""Every registered query against its check SQL, and the plans it runs."""

import oracle
import plans
import pytest

import __spark_entry__ as entry

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_check_sql(spark, small, con, name, monkeypatch):
    written = plans.record_writes(monkeypatch)
    df = QUERIES[name](spark, small)
    assert [p for plan in [*written, plans.physical(df)] for p in plans.problems(plan)] == []
    assert oracle.compare(df, con, CHECKS[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert [r["n"] for r in rows] == sorted((r["n"] for r in rows), reverse=True)


def test_clusters_cover_every_url(spark, small):
    clusters = QUERIES["natural_clusters"](spark, small)
    assert clusters.count() == QUERIES["url_depth"](spark, small).count()
    assert 1 < clusters.select("cluster").distinct().count() < clusters.count()
