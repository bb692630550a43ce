"""Hot keys: found by a sketch, dealt over tasks, and alone in having their lookup rows copied."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall import operators, streaming

SALTS = 8


@pytest.fixture
def partitions(spark):
    """Partitions as they are dealt, without coalescing."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture
def facts(spark):
    """A third on shop s1, a third without a shop, the rest on 1000 shops."""
    n = F.col("id")
    shop = F.when(n % 3 == 0, F.lit("s1")).when(n % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("t"), (n % 1000).cast("string")))
    return spark.range(30_000).select(n.cast("string").alias("user_id"), shop.alias("shop_id"))


@pytest.fixture
def lookup(spark):
    rows = spark.range(1000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("shop_id"), F.lit("T").alias("city_name"))
    return rows.unionByName(spark.createDataFrame([("s1", "S"), ("s2", "S")], rows.schema))


def test_the_sketch_finds_hot_keys_only(facts):
    assert operators.hot_keys(facts, "shop_id") == ["s1"]
    assert operators.hot_keys(facts.where("shop_id is null"), "shop_id") == []
    assert operators.hot_keys(facts.limit(0), "shop_id") == []
    assert operators.hot_keys(facts.where("shop_id <> 's1'"), "shop_id", 0.5) == []


def test_only_rows_of_hot_keys_are_copied(lookup):
    copies = Counter(row.shop_id for row in operators.copies_of(lookup, "shop_id", ["s1"], SALTS).collect())
    assert copies.pop("s1") == SALTS
    assert set(copies.values()) == {1} and len(copies) == 1001
    assert operators.copies_of(lookup, "shop_id", [], SALTS).count() == 1002


def test_join_is_even_and_right(spark, facts, lookup, partitions):
    joined = operators.lookup_join(facts, lookup, "shop_id", broadcast_bytes=0, salts=64)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shop_id" in plan and "_salt" in plan and "Broadcast" not in plan
    sizes = Counter(row[0] for row in joined.select(F.spark_partition_id()).collect())
    assert sum(sizes.values()) == 30_000 and max(sizes.values()) < 2 * 30_000 / 8
    plain = operators.lookup_join(facts, lookup, "shop_id", broadcast_bytes=0, hot=[])
    sizes = Counter(row[0] for row in plain.select(F.spark_partition_id()).collect())
    assert max(sizes.values()) > 10_000  # as it would be without
    expected = facts.join(F.broadcast(lookup), "shop_id", "left")
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, expected.collect()))


def test_a_task_that_runs_again_deals_its_rows_as_before(facts, lookup):
    runs = [
        operators.lookup_join(facts, lookup, "shop_id", broadcast_bytes=0, salts=8).select("user_id", F.spark_partition_id().alias("p"))
        for _ in range(2)
    ]
    assert len({frozenset(map(tuple, run.collect())) for run in runs}) == 1


def test_stored_counters_name_hot_shops(spark):
    rows = [("jiaoyis1", 90), ("jiaoyis2", 5), ("交易A", 95), ("jiaoyis3", 5)]
    counters = spark.createDataFrame(rows, "k string, count long")
    assert streaming.hot_shops(counters, 0.2) == ["s1"]
    assert streaming.hot_shops(counters, 0.01) == ["s1", "s2", "s3"]
    assert streaming.hot_shops(counters.limit(0)) == []


def test_a_stream_salts_shops_that_were_hot_and_shows_new_ones(spark, tmp_path, monkeypatch):
    lookup = spark.createDataFrame([("s1", "A"), ("s2", "B")], "shop_id string, city_name string")
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "run")
    seen = []
    from footfall.streaming import counters as module

    join = operators.lookup_join
    monkeypatch.setattr(module, "lookup_join", lambda *a, **b: (seen.append(b["hot"]), join(*a, **b))[1])
    counts = Counter()
    for hot, other in (("s1", "s2"), ("s2", "s1")):
        shops = [hot] * 60 + [other] * 3 + ["s9"] * 2
        counts.update(shops)
        records = spark.createDataFrame([(f"u{i}", f"{s},2016-01-01") for i, s in enumerate(shops)], "key string, value string")
        streaming.write_records(records, {"format": "parquet", "path": inbox})
        stream = streaming.read_pay_stream(spark, {"format": "parquet", "path": inbox})
        query = streaming.start_counter_stream(stream, lookup, root, trigger={"availableNow": True}, broadcast_bytes=0, salts=4)
        query.awaitTermination()
        assert streaming.newly_hot(query, [], 0.5) == [hot]
    assert seen == [[], ["s1", "s2", "s9"]] and streaming.newly_hot(query, seen[-1], 0.5) == []
    got = {row.k: row["count"] for row in streaming.read_counters(spark, f"{root}/counters").collect()}
    assert {f"jiaoyi{shop}": n for shop, n in counts.items()}.items() <= got.items()
    assert got["交易null"] == 4
