"""Plan-shape guards: the properties the scale design relies on, read from
executed physical plans (after AQE) at small scale.

- gold reads of a written silver table scan only the columns they use, push
  their IS NOT NULL filters into the scan, and prune source partitions;
- no headline query evaluates Python, funnels rows through one partition,
  or forms pairs (cartesian / nested-loop joins);
- each dedup key costs one hash shuffle, with a partial (map-side)
  aggregate below it, so a hot key is reduced before it moves.
"""

import re

import pytest

import __spark_entry__ as E
from paths import SF_SMALL

from offerlake.catalog import silver_both
from offerlake.plans.gold import ANALYTICS_COLUMNS, price_analytics
from offerlake.plans.pipeline import write_silver
from offerlake.session import scratch_path
from offerlake.sources.lake import LakePaths, read_table

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonMapInArrow")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def executed_plan(df) -> str:
    """The plan as run: AQE's final plan only (its text also carries the initial one)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


@pytest.fixture(scope="module")
def silver_path(spark):
    paths = LakePaths(scratch_path(spark, "plans-lake"))
    write_silver(silver_both(spark, SF_SMALL), paths)
    return paths.silver


def test_gold_read_prunes_columns_and_pushes_filters(spark, silver_path):
    plan = executed_plan(price_analytics(read_table(spark, silver_path), sort=False))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    read = {f.split(":")[0] for f in schema.split(",")}
    assert read == set(ANALYTICS_COLUMNS)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "IsNotNull(price_total)" in pushed and "IsNotNull(price_per_msq)" in pushed


def test_source_filter_prunes_partitions(spark, silver_path):
    from pyspark.sql import functions as F

    plan = executed_plan(read_table(spark, silver_path).filter(F.col("offer_source") == "olx").select("offer_id"))
    part = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "offer_source" in part


HEADLINE = ("j1_silver_olx", "j1_silver_otodom", "j2_analytics", "j3_ml_dataset", "d3_documents",
            "x13_bronze_olx", "x13_bronze_otodom", "x4_links", "s11_crawl_seeds", "a4_mode")


@pytest.mark.parametrize("name", HEADLINE)
def test_headline_plans_stay_distributed_and_jvm_side(spark, name):
    plan = executed_plan(E.queries()[name](spark, SF_SMALL))
    for node in PYTHON_NODES + PAIR_NODES:
        assert node not in plan, f"{name}: {node}"
    # One row of partial sums from each task may meet in one place; rows of data may not.
    for below in re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", plan):
        assert "functions=[partial_" in below and "keys=[]" in below, f"{name}: a shuffle into one partition"


def test_dedup_reduces_before_each_shuffle(spark):
    plan = executed_plan(E.queries()["j1_silver_otodom"](spark, SF_SMALL))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(keys) == ["offer_id", "short_description"]
    # Every hash exchange sits on a partial aggregate (map-side combine).
    for block in re.split(r"Exchange hashpartitioning", plan)[1:]:
        below = block.split("Exchange")[0]
        assert re.search(r"SortAggregate\(key=\[[^\]]*\], functions=\[partial_", below), below[:300]


def test_analytics_sort_is_range_partitioned(spark):
    plan = executed_plan(E.queries()["j2_analytics"](spark, SF_SMALL))
    assert "rangepartitioning(offer_date" in plan


@pytest.mark.parametrize("name", ("a5_categories", "m8_folds"))
def test_ranks_need_no_window(spark, name):
    """Category indexes and folds come from a distributed sort, not a window over one group."""
    plan = executed_plan(E.queries()[name](spark, SF_SMALL))
    assert not re.search(r"\bWindow\b", plan), name
    assert "SinglePartition" not in plan
