"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "interaction_scan")
    assert "EqualTo(event_type,view)" in text
    assert "value" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in plan(spark, "orders_in_range")


@pytest.mark.parametrize("name", ["top_items_per_user", "described_lists", "items_for_users"])
def test_top_k_is_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name) and "Partial" in plan(spark, name)


def test_pair_counts_are_combined_before_the_shuffle(spark):
    text = plan(spark, "cooccurrence")
    assert "partial_count(1)" in text
    explode = text.index("Generate explode(items")
    assert "Exchange" not in text[text.rindex("partial_count", 0, explode):explode]


@pytest.mark.parametrize("name", ["items_for_users", "unseen_items_for_users"])
def test_lists_do_not_shuffle_the_score_matrix(spark, name):
    text = plan(spark, name)
    assert "FlatMapCoGroupsInArrow" in text and not re.search(r"hashpartitioning\(user_id#\d+L, item_id#\d+L", text)
