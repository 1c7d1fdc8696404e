"""Plan shape: the properties the 100 TB design relies on, asserted on the
"""

import re

import pytest

from panelforge.operators import model
from panelforge.plans import bindings as B
from panelforge.plans.catalog import REGISTRY, build_panel

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_aggregate_partially_before_the_shuffle(spark):
    plan = physical(model.fct_price(B.prices_long(spark, SF)))
    assert "partial_avg" in plan
    plan = physical(model.fct_socio(B.socio(spark, SF)))
    assert "partial_max" in plan


def test_distinct_count_first_shuffle_includes_the_id(spark):
    plan = physical(model.fct_complaints_total(B.complaints(spark, SF)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("unique_key" in e for e in exchanges), exchanges
    assert "partial_count(distinct" in plan


def test_default_period_mean_is_not_a_period_window(spark):
    plan = physical(build_panel(spark, SF, checkpoint=False))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan)
    # the only Window is the LAG one, partitioned by the entity
    assert windows and all("zip_code" in w for w in windows), windows
    assert "partial_avg" in plan
    lazy_window = physical(build_panel(spark, SF, mean_method="window", checkpoint=False))
    assert any("zip_code" not in w for w in re.findall(r"Window \[.*?\], \[([^\]]*)\]", lazy_window))


def test_scans_are_pruned_and_filtered(spark):
    df = REGISTRY["fct_complaints_total"](spark, SF)
    fmt = df._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", fmt)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and "l_comment" not in lineitem[0] and "l_tax" not in lineitem[0]
    assert "PushedFilters: [IsNotNull(l_shipdate)" in fmt or "IsNotNull(l_shipdate)" in fmt


@pytest.mark.parametrize("key", ["signals_panel", "prices_clean", "socio_clean",
                                 "json_matrix", "stream_ingest", "unpivot_months"])
def test_no_python_udfs(spark, key):
    plan = physical(REGISTRY[key](spark, SF))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert node not in plan


@pytest.mark.parametrize("key", ["signals_panel", "signals_panel_monthly"])
def test_panel_is_not_shuffled_for_the_period_mean(spark, key):
    """After the checkpoint the means are broadcast: no exchange on the panel."""
    df = REGISTRY[key](spark, SF)
    df.collect()
    plan = physical(df).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_extracts_do_not_build_the_whole_panel(spark):
    for key in ("corr_extract", "top_rate", "missingness"):
        assert "lag(" not in physical(REGISTRY[key](spark, SF)), key
