"""Totals per city and series per day."""

from pyspark.sql import functions as F

from ..functions import day_of
from ..operators import top_k
from .parts import by_part


def city_pay(user_pay, shop_info):
    """Amount paid per city.

    Payments are counted per shop first, so the join sees one row per shop and not one per payment, and no hot
    shop or city reaches a shuffle unreduced. The sum is that of ``per_pay`` over the joined payments. The payments may
    be a list of tables without a shop in common.
    """
    payments = by_part(user_pay, lambda part: part.groupBy("shop_id").agg(F.count("*").alias("payments")))
    return (
        payments.join(shop_info, "shop_id")
        .groupBy(F.col("city_name").alias("cityName"))
        .agg(F.sum(F.col("payments") * F.col("per_pay")).alias("totalPay"))
    )


def city_pay_top(user_pay, shop_info, k=10):
    totals = city_pay(user_pay, shop_info)
    return top_k(totals, F.col("totalPay").desc_nulls_last(), F.col("cityName").asc_nulls_last(), k=k)


def _per_day(records, name):
    return records.groupBy(day_of(records).alias("day")).agg(F.count("*").alias(name))


def _day_as_text(df):
    return df.withColumn("day", F.col("day").cast("string"))


def daily_count(records, name):
    return _day_as_text(_per_day(records, name))


def _busiest_days(records, name, k):
    return top_k(daily_count(records, name), F.col(name).desc_nulls_last(), F.col("day").asc_nulls_last(), k=k)


def day_pay_top(user_pay, k=10):
    return _busiest_days(user_pay, "countPay", k)


def day_view_top(user_view, k=10):
    return _busiest_days(user_view, "countView", k)


def day_pay_all(user_pay):
    return daily_count(user_pay, "countPay").orderBy(F.col("day").asc_nulls_last())


def day_view_all(user_view):
    return daily_count(user_view, "countView").orderBy(F.col("day").asc_nulls_last())


def _day_pay_view(user_pay, user_view):
    """Days with payments and their views, 0 if none; both sides are hashed by day already when they join."""
    payments, views = _per_day(user_pay, "countPay"), _per_day(user_view, "countView")
    if payments.schema["day"].dataType != views.schema["day"].dataType:
        payments, views = _day_as_text(payments), _day_as_text(views)
    joined = payments.join(views, "day", "left")
    return _day_as_text(joined.select("day", "countPay", F.coalesce("countView", F.lit(0)).alias("countView")))


def day_pay_view_last(user_pay, user_view, k=10):
    return top_k(_day_pay_view(user_pay, user_view), F.col("day").desc_nulls_last(), k=k)


def day_pay_view_all(user_pay, user_view):
    return _day_pay_view(user_pay, user_view).orderBy(F.col("day").desc_nulls_last())
