"""Layer 2: every registered key against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from oracle_texts import oracle_sql
from tallyspark.plans import registry
from tests.oracle_compare import compare, duck

SF = os.environ.get("TALLYSPARK_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_key_has_an_oracle():
    assert set(oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "total_amount"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    assert compare(df, con, E.oracle_sql()[key]) == []


ANSI_OFF_KEYS = ["revenue_with_extras", "pizza_deliveries_cleaned", "order_item_text", "ingredient_list_text",
                 "sub_payments", "sub_growth", "bank_balance_growth_pct", "retail_clean_weekly",
                 "retail_impact_region", "web_view_to_cart_rate", "web_visit_campaigns", "diner_member_ranked"]


@pytest.mark.parametrize("key", ANSI_OFF_KEYS)
def test_matches_oracle_with_ansi_off(spark, con, key):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = E.queries()[key](spark, SF)
        assert compare(df, con, E.oracle_sql()[key]) == []
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


TZ_KEYS = ["pizza_deliveries_cleaned", "runner_pickup_minutes", "order_prep_vs_size", "delivery_time_range",
           "retail_clean_weekly", "web_visit_campaigns", "pizza_volume_by_hour"]


@pytest.mark.parametrize("key", TZ_KEYS)
def test_matches_oracle_in_a_dst_time_zone(spark, key):
    """Wall-clock timestamps must not move with the session zone (DST gaps included)."""
    sf = "/root/testdata/sf0.01"
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[key](spark, sf)
        assert compare(df, duck(sf), E.oracle_sql()[key]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
