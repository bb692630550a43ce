"""Edge cases of the queries, as literals."""

import datetime

import pytest
from pyspark.sql import functions as F

from footfall import plans
from footfall.fixed import SHOP_INFO_SCHEMA, USER_PAY_SCHEMA


def _shops(spark, *rows):
    """(shop_id, city, per_pay, score, category)"""
    full = [(s, c, "loc", pay, score, 1, 1, cate, "y", "z") for s, c, pay, score, cate in rows]
    return spark.createDataFrame(full, SHOP_INFO_SCHEMA)


def _pay(spark, *rows):
    return spark.createDataFrame(list(rows), USER_PAY_SCHEMA)


def _tuples(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def test_daily_amount_edges(spark):
    shops = _shops(spark, ("a", "X", 10, 1, "p"), ("b", "X", 7, 1, "p"), ("c", "Y", None, 1, "p"), ("d", "Y", 9, 1, "p"))
    pay = _pay(
        spark,
        ("u", "a", "2016-01-01 09"), ("u", "a", "2016-01-01 10"), (None, "a", "2016-01-02 10"),
        ("u", "b", None), ("u", "b", None),
        ("u", "c", "2016-01-01"),
        ("u", "unknown", "2016-01-01"),
    )
    top = plans.top_shops_by_daily_amount(shops, pay)
    assert _tuples(top, "shop_id", "countPay", "countDay", "avgAmountPerDay") == [
        ("a", 2, 2, 10.0),  # the payment without user counts as a day only
        ("b", 2, 0, 0.0),  # no time stamp at all
        ("c", 1, 1, None),  # no per_pay: last
    ]
    assert top.columns[:4] == ["avgAmountPerDay", "shop_id", "countPay", "countDay"]
    assert top.columns.count("shop_id") == 1 and len(top.columns) == 13


def test_activity_ties_and_malformed_days(spark):
    rows = [("u", f"s{i:02d}", "2016-01-01") for i in range(12)] + [("u", "s05", "junk"), ("u", "s05", "junk")]
    top = plans.shop_activity_top(_pay(spark, *rows), k=3)
    assert _tuples(top, "shop_id", "countPay", "countDay") == [("s05", 3, 2), ("s00", 1, 1), ("s01", 1, 1)]


def test_typed_time_stamps_give_the_days_of_their_text(spark):
    stamps = [datetime.datetime(2016, 1, 1 + i % 3, i % 24, 5, 0, i) for i in range(50)] + [None]
    rows = [("u", f"s{i % 4}", s) for i, s in enumerate(stamps)]
    typed = spark.createDataFrame(rows, "user_id string, shop_id string, time_stamp timestamp_ntz")
    text = typed.withColumn("time_stamp", F.col("time_stamp").cast("string"))
    for plan in (plans.shop_activity, plans.day_pay_all, plans.day_pay_top):
        assert sorted(map(str, plan(typed).collect())) == sorted(map(str, plan(text).collect()))
    mixed = plans.day_pay_view_all(typed, text)
    assert _tuples(mixed, "day", "countPay", "countView")[:1] == [("2016-01-03", 16, 16)]
    assert mixed.collect() == plans.day_pay_view_all(typed, typed).collect()


def test_city_pay_edges(spark):
    amounts = [("a", "X", 10), ("b", "X", None), ("c", "Y", None), ("d", "Z", 1), ("d", "Z", 2)]
    shops = _shops(spark, *[(shop, city, amount, 1, "p") for shop, city, amount in amounts])
    pay = _pay(spark, *[("u", s, "t") for s in "aabbcdd?"])
    assert _tuples(plans.city_pay_top(pay, shops), "cityName", "totalPay") == [("X", 20), ("Z", 6), ("Y", None)]


def test_daily_series(spark):
    pay = _pay(spark, *[("u", "s", d) for d in ("2016-01-01 1", "2016-01-01 2", "2016-01-02", "bad", None)])
    view = _pay(spark, *[("u", "s", d) for d in ("2016-01-01", "2016-01-03", "bad")])
    assert _tuples(plans.day_pay_all(pay), "*") == [("2016-01-01", 2), ("2016-01-02", 1), ("bad", 1), (None, 1)]
    assert _tuples(plans.day_view_all(view), "*") == [("2016-01-01", 1), ("2016-01-03", 1), ("bad", 1)]
    both = [("bad", 1, 1), ("2016-01-02", 1, 0), ("2016-01-01", 2, 1), (None, 1, 0)]
    assert _tuples(plans.day_pay_view_all(pay, view), "*") == both
    assert _tuples(plans.day_pay_view_last(pay, view, k=2), "*") == both[:2]
    assert _tuples(plans.day_pay_top(pay, k=2), "*") == [("2016-01-01", 2), ("2016-01-02", 1)]
    assert _tuples(plans.day_view_top(view, k=2), "*") == [("2016-01-01", 1), ("2016-01-03", 1)]


def test_welcome_scores(spark):
    shops = _shops(
        spark,
        ("a", "北京", 100, 5, "火锅"), ("b", "北京", 100, 5, "小吃"), ("c", "北京", None, 5, "火锅"),
        ("d", "上海", 50, 3, "火锅"), ("e", "杭州", 500, 5, "火锅"), ("f", "上海", 50, 3, "火锅"),
    )
    assert _tuples(plans.welcome_top(shops, "北京"), "shop_id", "welcomeScore") == [("a", 30.7), ("b", 30.7), ("c", None)]
    per_city = plans.welcome_top_per_city(shops, k=2).orderBy("city_name", "rk")
    assert _tuples(per_city, "city_name", "shop_id", "rk") == [
        ("上海", "d", 1), ("上海", "f", 2), ("北京", "a", 1), ("北京", "b", 2)
    ]
    documented = plans.welcome_documented(shops).orderBy("city_name", "rk")
    assert _tuples(documented, "shop_id", "welcomeScore", "rk") == [
        ("d", 0.57, 1), ("f", 0.57, 2), ("a", 1.0, 1), ("c", None, 2)
    ]
    assert plans.welcome_documented(shops, category="none").count() == 0
    free = _shops(spark, ("a", "北京", 0, 5, "火锅"))
    assert _tuples(plans.welcome_documented(free), "shop_id", "welcomeScore") == [("a", None)]


@pytest.mark.parametrize("column", ["cate_1_name", "cate_2_name", "cate_3_name"])
def test_category_in_any_column(spark, column):
    shops = _shops(spark, ("a", "北京", 100, 5, "x")).withColumn(column, F.lit("火锅"))
    others = [c for c in ("cate_1_name", "cate_2_name", "cate_3_name") if c != column]
    shops = shops.withColumn(others[0], F.lit(None).cast("string"))
    assert plans.welcome_documented(shops).count() == 1


def test_shop_base(spark):
    shops = _shops(spark, *[(s, "X", 1, 1, "p") for s in ("10", "9", None, "1")])
    assert _tuples(plans.shop_base_top(shops, k=4), "shop_id") == [("1",), ("10",), ("9",), (None,)]
