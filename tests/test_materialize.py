"""Materialised shared views give the same rows as the fully lazy plans."""

import pytest

import __spark_entry__ as E
from tallyspark.operators.materialize import CONF_ENABLED, shared
from tallyspark.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
KEYS = ["diner_member_ranked", "ingredient_list_text", "sub_payments", "bank_running_balance",
        "retail_impact_region", "web_product_funnel", "web_visit_campaigns"]


@pytest.mark.parametrize("key", KEYS)
def test_lazy_equals_materialised(spark, key):
    fn = E.queries()[key]
    spark.conf.set(CONF_ENABLED, "true")
    mat = fn(spark, SF)
    spark.conf.set(CONF_ENABLED, "false")
    try:
        lazy = fn(spark, SF)
        assert [(f.name, f.dataType) for f in mat.schema] == [(f.name, f.dataType) for f in lazy.schema]
        assert mat.exceptAll(lazy).count() == 0 and lazy.exceptAll(mat).count() == 0
    finally:
        spark.conf.set(CONF_ENABLED, "true")


def test_changed_input_is_seen(spark, tmp_path):
    spark.conf.set(CONF_ENABLED, "true")
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    build = lambda: spark.read.parquet(str(tmp_path / "t.parquet"))
    assert shared(spark, str(tmp_path), "v", build).count() == 3
    spark.range(4).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert shared(spark, str(tmp_path), "v", build).count() == 7


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(type("Session", (), {"sparkContext": Context})())


def test_pages_beyond_a_hundred_count(spark):
    from tallyspark.plans.web import top_pages
    from tallyspark.sources.dims import page_hierarchy

    events = spark.createDataFrame([(1, 250), (1, 250), (1, 7), (1, None)], "event_type int, page_id long")
    assert [tuple(r) for r in top_pages(events, page_hierarchy(events)).collect()] == [("page_250", 2), ("page_7", 1)]
