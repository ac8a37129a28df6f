"""What the plans of chosen queries must show."""

from plans import physical

import __spark_entry__ as entry

QUERIES = entry.queries()


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = physical(QUERIES["anti_pending_urls"](spark, small))
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_url_features_are_generated_code(spark, small):
    df = QUERIES["url_features_volume"](spark, small)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert all("*(" in line for line in final.splitlines() if "Project" in line)


def test_total_reuses_the_distribution(spark, small):
    df = QUERIES["topk_categories"](spark, small)
    df.collect()
    assert "ReusedExchange" in physical(df)
