"""The plans Spark makes of the queries: what is pushed down, joined, shuffled, and how skew is met."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from footfall import bindings, plans

SF_DIR = "/root/testdata/sf0.01"
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(name for name in registry.queries() if not re.match(r"op\d+_|pipeline$", name)))
def test_no_python_no_cross_join(spark, name):
    plan = _plan(registry.queries()[name](spark, SF_DIR))
    assert not re.search("Python|Pandas|CartesianProduct|NestedLoopJoin|BatchEval", plan), plan


@pytest.mark.parametrize("name", ["shop_city_lookup", "last_line_lookup"])
def test_line_order_takes_one_scan(spark, name):
    plan = _plan(registry.queries()[name](spark, SF_DIR))
    assert len(re.findall("FileScan text", plan)) == 1
    assert "SinglePartition" not in plan and "Broadcast" not in plan


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast, as at scale."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_only_needed_columns_and_rows_are_read(spark):
    plan = _plan(registry.queries()["day_pay_top10"](spark, SF_DIR))
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    plan = _plan(registry.queries()["welcome_top10_city"](spark, SF_DIR))
    assert "EqualTo(p_brand,Brand#1)" in plan and "p_name" not in plan and "p_type" not in plan
    plan = _plan(registry.queries()["top_shops_by_daily_amount"](spark, SF_DIR))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_top_k_never_sorts_everything(spark):
    for name in ("top_shops_by_daily_amount", "city_pay_top10", "day_pay_view_last10", "shop_base_top10"):
        plan = _plan(registry.queries()[name](spark, SF_DIR))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    plan = _plan(registry.queries()["welcome_top10_per_city"](spark, SF_DIR))
    assert re.search("WindowGroupLimit.*Partial", plan) and re.search("WindowGroupLimit.*Final", plan)


def test_payments_are_reduced_before_shuffles_and_joins(spark, no_broadcast, tmp_path):
    """Each shuffle of payments is fed by a partial aggregate; the join with shops needs no further one."""
    pay_path, shop_path = str(tmp_path / "pay"), str(tmp_path / "shop")
    bindings.user_pay(spark, SF_DIR).write.parquet(pay_path)
    bindings.shop_info(spark, SF_DIR).write.parquet(shop_path)
    pay, shops = spark.read.parquet(pay_path), spark.read.parquet(shop_path)
    plan = _plan(plans.city_pay_top(pay, shops))
    assert plan.count("Exchange hashpartitioning(shop_id") == 2  # counts on one side, shops on the other
    assert plan.index("partial_sum") < plan.index("SortMergeJoin") < plan.index("partial_count")
    plan = _plan(plans.top_shops_by_daily_amount(shops, pay))
    assert len(re.findall("Exchange hashpartitioning", plan)) == 3
    assert "partial_count(user_id" in plan and "partial_sum(payments" in plan


def test_days_join_where_they_were_counted(spark, no_broadcast):
    plan = _plan(plans.day_pay_view_last(bindings.ev_pay(spark, SF_DIR), bindings.ev_view(spark, SF_DIR)))
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2


def test_hot_order_is_split(spark, no_broadcast, tmp_path):
    """A third of all line items on one order: the join splits that partition and loses nothing."""
    items = bindings.table(spark, SF_DIR, "lineitem")
    hot = items.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey")))
    hot.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    bindings.table(spark, SF_DIR, "orders").write.parquet(str(tmp_path / "orders.parquet"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = plans.shop_activity(bindings.user_pay(spark, str(tmp_path)))
        total = sum(r.countPay for r in df.collect())
        plan = _plan(df)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan
    assert total == items.count()
