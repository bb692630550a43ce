"""Counters by increments: equal to one batch count, whatever is replayed, folded or moved."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall import streaming

CITIES = {"s1": "A", "s2": "B", "s3": "A"}
NOW = {"availableNow": True}


class Counting:
    def __init__(self, spark, folder):
        self.spark, self.inbox, self.root = spark, str(folder / "inbox"), str(folder / "run")
        self.path = f"{self.root}/increments"
        self.cities, self.expected, self.seed = dict(CITIES), Counter(), 0

    def lookup(self):
        return self.spark.createDataFrame(list(self.cities.items()), "shop_id string, city_name string")

    def feed(self, n=30):
        dice = random.Random(self.seed)
        self.seed += 1
        shops = [dice.choice(["s1", "s1", "s1", "s2", "s3", "s9"]) for _ in range(n)]
        for shop in shops:
            self.expected.update([f"jiaoyi{shop}", f"交易{self.cities.get(shop, 'null')}"])
        rows = [(f"u{i}", f"{shop},2016-01-01") for i, shop in enumerate(shops)]
        frame = self.spark.createDataFrame(rows, "key string, value string").coalesce(1)
        streaming.write_records(frame, {"format": "parquet", "path": self.inbox})

    def run(self):
        source = {"format": "parquet", "path": self.inbox, "maxFilesPerTrigger": 1}
        records = streaming.read_pay_stream(self.spark, source)
        streaming.start_increment_stream(records, self.lookup, self.root, NOW).awaitTermination()

    def totals(self):
        return {row.k: row["count"] for row in streaming.read_increments(self.spark, self.path).collect()}


@pytest.fixture
def counting(spark, tmp_path):
    return Counting(spark, tmp_path)


def test_sums_across_restarts_and_moved_shops(counting):
    assert counting.totals() == {}
    for city in ("A", "C"):
        counting.cities["s1"] = city  # seen by the next micro-batch, without a renewed checkpoint
        for _ in range(2):
            counting.feed()
        counting.run()
        assert counting.totals() == counting.expected


def test_a_replayed_batch_replaces_itself(spark, counting):
    counting.feed()
    counting.run()
    batch = spark.read.parquet(counting.inbox).select("key", "value")
    streaming.write_increments(batch, 0, counting.lookup, counting.path)
    assert counting.totals() == counting.expected


def test_folds_keep_totals_for_new_and_old_readers(spark, counting):
    streaming.fold_increments(spark, counting.path)
    for turn in range(3):
        for _ in range(3):
            counting.feed()
        counting.run()
        old = streaming.read_increments(spark, counting.path)
        before = dict(counting.expected)
        streaming.fold_increments(spark, counting.path)
        assert counting.totals() == counting.expected
        assert {row.k: row["count"] for row in old.collect()} == before
        names = streaming.store.names_in(spark, counting.path)
        assert sum(name.startswith("upto") for name in names) <= 2 and len(names) <= 8
    streaming.fold_increments(spark, counting.path)
    assert counting.totals() == counting.expected
    assert len(streaming.store.names_in(spark, counting.path)) == 2  # the fold and the newest micro-batch


def test_an_interrupted_fold_or_batch_does_not_count(spark, counting, tmp_path):
    for _ in range(3):
        counting.feed()
    counting.run()
    wrong = spark.createDataFrame([("jiaoyis1", 999)], "k string, count long")
    for name in ("upto-000000000001", "batch-000000000007"):
        wrong.write.parquet(f"{counting.path}/{name}")
        (tmp_path / "run" / "increments" / name / "_SUCCESS").unlink()
    assert counting.totals() == counting.expected
    streaming.fold_increments(spark, counting.path)
    assert counting.totals() == counting.expected


def test_records_are_counted_before_the_lookup(spark, counting):
    """A hot shop crosses the shuffle as one row for each task, and the join sees one row for each shop."""
    records = spark.range(10_000).select(F.lit("u").alias("key"), F.lit("s1,2016-01-01").alias("value"))
    plan = streaming.key_counts(records, counting.lookup())._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("partial_count(1)") and "partial_sum" in plan
