"""Activity of shops that merges, streams, and comes from bucketed tables: all equal to the plain plan."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from footfall import bindings, plans, sources, streaming
from footfall.fixed import RECORD_SCHEMA, USER_PAY_SCHEMA

SF_DIR = "/root/testdata/sf0.01"
DAYS = ["2016-01-01", "2016-01-31", "2016-02-29", "2016-02-28", "2016-01", "2016-13-45", "x", "", "2016-01-00", "0000-00-32"]


def _payments(n, seed):
    dice = random.Random(seed)
    out = []
    for _ in range(n):
        day = dice.choice([*DAYS, None])
        stamp = None if day is None else day + dice.choice(["", " 10:00:00"]) if len(day) == 10 else day
        out.append((dice.choice(["u1", "u2", None]), dice.choice(["s1", "s1", "s2", "s3", None]), stamp))
    return out


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.select("shop_id", "countPay", "countDay").collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_maps_merge_to_the_plain_numbers(spark, seed):
    parts = [spark.createDataFrame(_payments(n, seed * 10 + n), USER_PAY_SCHEMA) for n in (1, 40, 90)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    expected = _rows(plans.shop_activity(every))
    maps = [plans.activity_maps(part) for part in parts]
    assert _rows(plans.activity_of(plans.merge_activity(*maps))) == expected
    assert _rows(plans.activity_of(plans.merge_activity(maps[2], plans.merge_activity(maps[0], maps[1])))) == expected
    assert _rows(plans.activity_of(plans.activity_maps(every))) == expected


def test_a_month_is_one_row(spark):
    pay = spark.createDataFrame([("u", "s", f"2016-05-{day:02d}") for day in range(1, 32)] * 2, USER_PAY_SCHEMA)
    (row,) = plans.activity_maps(pay).collect()
    assert (row.period, row.days & 0xFFFFFFFF, row.payments) == ("2016-05", (1 << 31) - 1, 62)


def test_typed_days_are_the_same(spark):
    pay = bindings.user_pay(spark, SF_DIR)
    text = pay.withColumn("time_stamp", F.col("time_stamp").cast("string"))
    assert _rows(plans.activity_of(plans.activity_maps(pay))) == _rows(plans.shop_activity(text))


def test_stored_slices_replace_themselves_and_old_payments_are_not_read(spark, tmp_path):
    path, pay = str(tmp_path), bindings.user_pay(spark, SF_DIR)
    early = F.col("time_stamp") < F.lit("1995-01-01").cast("date")
    plans.store_activity(pay.where(early), path, "a")
    plans.store_activity(pay, path, "b")  # wrong, and then right
    plans.store_activity(pay.where(~early), path, "b")
    stored = plans.activity_of(plans.stored_activity(spark, path))
    assert _rows(stored) == _rows(plans.shop_activity(pay))
    plan = _plan(registry.queries()["shop_activity_merged_top10"](spark, SF_DIR))
    assert "lineitem" not in plan and "l_shipdate" not in plan and "partial_bit_or" in plan


def test_an_empty_table(spark):
    none = spark.createDataFrame([], USER_PAY_SCHEMA)
    assert plans.activity_of(plans.activity_maps(none)).count() == 0


# The stream


def _records(payments):
    return [("u" if user is None else user, f"{'' if shop is None else shop},{stamp}") for user, shop, stamp in payments if stamp is not None]


def test_stream_equals_batch_across_restarts_and_replays(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "run")
    every = []
    for seed in range(3):
        records = _records(_payments(60, seed)) + [("u", "s9"), ("u", "s1,2016-01-01 23:00")]
        every += records
        streaming.write_records(spark.createDataFrame(records, RECORD_SCHEMA), {"format": "parquet", "path": inbox})
        stream = streaming.read_pay_stream(spark, {"format": "parquet", "path": inbox, "maxFilesPerTrigger": 2})
        streaming.start_activity_stream(stream, root, {"availableNow": True}).awaitTermination()
        pays, days = Counter(), {}
        for _, value in every:
            shop, comma, stamp = value.partition(",")
            pays[shop] += 1
            days.setdefault(shop, set()).update([stamp[:10]] if comma else [])
        expected = sorted(((shop, n, len(days[shop])) for shop, n in pays.items()), key=str)
        assert _rows(streaming.read_activity(spark, f"{root}/activity")) == expected
    latest = streaming.read_activity(spark, f"{root}/activity")
    streaming.write_activity(latest.limit(0), 0, f"{root}/activity")  # an old batch again
    assert len(_rows(streaming.read_activity(spark, f"{root}/activity"))) <= len(expected)
    state = spark.read.format("state-metadata").load(f"{root}/checkpoint")
    assert {row.operatorName for row in state.collect()} == {"dedupe", "stateStoreSave"}


def test_old_days_leave_the_state(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "run")
    state = []
    for month in range(1, 7):
        days = [f"2016-{month:02d}-{day:02d}" for day in range(1, 29)]
        rows = [("u", f"{shop},{day} 10:00") for day in days for shop in ("s1", "s1", "s2")] + [("u", "s1,x")]
        streaming.write_records(spark.createDataFrame(rows, RECORD_SCHEMA), {"format": "parquet", "path": inbox})
        stream = streaming.read_pay_stream(spark, {"format": "parquet", "path": inbox})
        streaming.start_activity_stream(stream, root, {"availableNow": True}, "10 days").awaitTermination()
        state.append(spark.read.format("statestore").option("operatorId", 1).load(f"{root}/checkpoint").count())
    assert _rows(streaming.read_activity(spark, f"{root}/activity")) == [("s1", 6 * 57, 6 * 28), ("s2", 6 * 28, 6 * 28)]
    assert max(state) <= 2 * 2 * 28 and state[-1] < 3 * 28  # all days would be 6 * 2 * 28
    late = spark.createDataFrame([("u", "s1,2016-01-01"), ("u", "s2,2016-06-28")], RECORD_SCHEMA)
    streaming.write_records(late, {"format": "parquet", "path": inbox})
    stream = streaming.read_pay_stream(spark, {"format": "parquet", "path": inbox})
    streaming.start_activity_stream(stream, root, {"availableNow": True}, "10 days").awaitTermination()
    assert _rows(streaming.read_activity(spark, f"{root}/activity")) == [("s1", 6 * 57 + 1, 6 * 28), ("s2", 6 * 28 + 1, 6 * 28)]


# Bucketed tables


@pytest.fixture
def hot_table(spark, tmp_path):
    """Payments with a third on one shop and some without a shop, saved as a bucketed table."""
    pay = bindings.user_pay(spark, SF_DIR)
    n = F.pmod(F.xxhash64("user_id", "shop_id", "time_stamp"), F.lit(30))
    pay = pay.withColumn("shop_id", F.when(n < 10, F.lit("hot")).when(n == 10, F.lit(None)).otherwise(F.col("shop_id")))
    sources.save_bucketed(pay, "pay_of_test", 4, path=str(tmp_path))
    yield pay
    spark.sql("drop table pay_of_test")
    spark.sql("drop table pay_of_test_hot")


def test_no_shuffle_before_the_aggregate(spark, hot_table):
    cold, hot = sources.bucketed_parts(spark, "pay_of_test")
    assert "Exchange" not in _plan(plans.shop_activity(cold))
    assert "Bucketed: true" in _plan(plans.shop_activity(cold))
    shops = bindings.shop_info(spark, SF_DIR)
    plan = _plan(plans.city_pay(cold, shops))
    before = plan[plan.index("HashAggregate(keys=[shop_id"):] if "HashAggregate(keys=[shop_id" in plan else plan
    side = before[:before.index("part.parquet")] if "part.parquet" in before else before
    assert len(re.findall("Exchange hashpartitioning", side)) <= 1  # of the shops, not of the payments
    assert {row.shop_id for row in hot.select("shop_id").distinct().collect()} == {"hot", None}
    assert cold.where("shop_id = 'hot' or shop_id is null").isEmpty()


def test_parts_give_the_plain_results(spark, hot_table):
    parts = sources.bucketed_parts(spark, "pay_of_test")
    shops = bindings.shop_info(spark, SF_DIR)
    assert _rows(plans.shop_activity(parts)) == _rows(plans.shop_activity(hot_table))
    assert Counter(map(tuple, plans.city_pay(parts, shops).collect())) == Counter(map(tuple, plans.city_pay(hot_table, shops).collect()))


def test_saving_again_replaces(spark, hot_table, tmp_path):
    few = hot_table.where("shop_id = 'hot'").limit(10)
    sources.save_bucketed(few, "pay_of_test", 2, path=str(tmp_path), hot=[])
    cold, hot = sources.bucketed_parts(spark, "pay_of_test")
    assert (cold.count(), hot.count()) == (10, 0)
