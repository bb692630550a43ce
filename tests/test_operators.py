"""Rankings, indexes, joins and series against plain Python on small skewed fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from footfall import operators
from footfall.fixed import PROVINCE_NAMES


def _skewed_rows(n=3000):
    """A third of all rows in one group; many equal values."""
    rng = random.Random(1)
    return [("hot" if i % 3 == 0 else f"g{rng.randrange(20)}", f"k{i:05d}", rng.randrange(30)) for i in range(n)]


@pytest.mark.parametrize(("k", "threshold"), [(5, "1000"), (40, "10"), (2000, "1000")])
def test_top_k_per_group(spark, k, threshold):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "g string, key string, v int").repartition(8)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        top = operators.top_k_per_group(df, "g", [F.col("v").desc()], key="key", k=k).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    expected = set()
    for group in {g for g, _, _ in rows}:
        ordered = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[2], r[1]))[:k]
        expected |= {(*r, i) for i, r in enumerate(ordered, 1)}
    assert {tuple(r) for r in top} == expected and len(top) == len(expected)


def test_appearance_index(spark):
    rng = random.Random(2)
    ordinals = {0, 65535, 65536, 1 << 32, (1 << 47) + 3}
    ordinals |= {rng.randrange(1 << rng.choice([8, 17, 33, 47])) for _ in range(3000)}
    rows = [(f"n{o}", o) for o in ordinals]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "name string, ordinal long").repartition(5)
    got = operators.appearance_index(df).orderBy("idx").collect()
    assert [(r.idx, r.ordinal) for r in got] == list(enumerate(sorted(ordinals), 1))
    assert all(r.name == f"n{r.ordinal}" for r in got)


def test_appearance_index_of_nothing(spark):
    df = spark.createDataFrame([], "name string, ordinal long")
    assert operators.appearance_index(df).count() == 0


def test_rank_labels(spark):
    df = spark.createDataFrame([("b", 5.9), ("a", 5.9), ("c", 7.0), ("d", 1.0)], "cityName string, totalPay double")
    labels = [tuple(r) for r in operators.rank_labels(df, k=3).orderBy("label").collect()]
    assert labels == [("top1:c", 7), ("top2:a", 5), ("top3:b", 5)]


def test_relabel_drops_unknown_keys(spark):
    df = spark.createDataFrame([("BeiJing", 1), ("ShanXi3", 2), ("Nowhere", 3)], "province string, price long")
    expected = {("北京", 1), ("陕西", 2)}
    assert {tuple(r) for r in operators.relabel(df, PROVINCE_NAMES).collect()} == expected
    pairs = spark.createDataFrame(list(PROVINCE_NAMES.items()), "old string, new string")
    assert {tuple(r) for r in operators.relabel(df, pairs).collect()} == expected
    assert len(PROVINCE_NAMES) == 34


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lookup_join_is_the_same_either_way(spark, broadcast_bytes):
    rows = _skewed_rows()
    facts = spark.createDataFrame([(g, k) for g, k, _ in rows], "shop_id string, n string").repartition(4)
    lookup = spark.createDataFrame([("hot", "H"), ("g1", "A"), ("unused", "U")], "shop_id string, city_name string")
    joined = operators.lookup_join(facts, lookup, "shop_id", broadcast_bytes=broadcast_bytes)
    cities = {"hot": "H", "g1": "A"}
    shuffled = facts.groupBy("shop_id", "n").count().drop("count")  # rows out of a shuffle, in no fixed order
    assert operators.lookup_join(shuffled, lookup, "shop_id", broadcast_bytes=broadcast_bytes).count() == shuffled.count()
    assert sorted(map(tuple, joined.select("n", "city_name").collect())) == sorted((k, cities.get(g)) for g, k, _ in rows)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (broadcast_bytes > 0)


def test_salted_lookup_spreads_a_hot_key(spark):
    """A third of all facts on one key end in several tasks."""
    facts = spark.createDataFrame([(g, k) for g, k, _ in _skewed_rows()], "shop_id string, n string").repartition(4)
    lookup = spark.createDataFrame([("hot", "H")], "shop_id string, city_name string")
    joined = operators.lookup_join(facts, lookup, "shop_id", broadcast_bytes=0, salts=16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = joined.where(F.col("city_name") == "H").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in hot) == 1000
    assert len(hot) >= 5 and max(r["count"] for r in hot) < 500


def test_series(spark):
    df = spark.createDataFrame([("d1", 1, 2), ("d2", 3, 4)], "day string, countPay long, countView long")
    assert operators.series(df).columns == ["label", "value", "value2"]
    assert operators.series_lists(df.orderBy("day")) == [["d1", "d2"], [1, 3], [2, 4]]
    assert operators.series_lists(df.orderBy("day"), "day", "countView") == [["d1", "d2"], [2, 4]]
    assert operators.series(df.withColumn("more", F.lit(0))).columns == ["label", "value", "value2", "value3"]


def test_long_series(spark):
    assert len(operators.series_lists(spark.range(10_001).withColumn("n", F.lit(1)))[0]) == 10_001
