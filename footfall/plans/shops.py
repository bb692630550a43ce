"""Rankings of shops."""

from decimal import Decimal

from pyspark.sql import functions as F

from ..fixed import WELCOME_CATEGORY, WELCOME_CITIES
from ..functions import day_of
from ..operators import top_k, top_k_per_group
from .parts import by_part


def shop_activity(user_pay):
    """Payments and distinct payment days per shop.

    Counted per shop and day, then per shop: both steps combine on the map side, so a hot shop crosses the first
    shuffle as one row per task and day, and never gathers its payments in one place. On a table that is bucketed by
    shop neither step shuffles. A list of tables without a shop in common is counted table by table.
    """
    return by_part(user_pay, _activity)


def _activity(user_pay):
    per_day = user_pay.groupBy("shop_id", day_of(user_pay).alias("day")).agg(F.count("user_id").alias("payments"))
    return per_day.groupBy("shop_id").agg(
        F.sum("payments").alias("countPay"),
        F.count("day").alias("countDay"),
    )


def shop_activity_top(user_pay, k=10, activity=None):
    """Shops with the most payments. Pass a kept ``activity`` to spare the pass over the payments."""
    activity = shop_activity(user_pay) if activity is None else activity
    return top_k(activity, F.col("countPay").desc_nulls_last(), F.col("shop_id").asc_nulls_last(), k=k)


def top_shops_by_daily_amount(shop_info, user_pay, k=10, activity=None):
    """Shops by average amount per payment day; payments are aggregated before they meet the shops.

    Pass a kept ``activity`` to spare the pass over the payments.
    """
    activity = shop_activity(user_pay) if activity is None else activity
    shops = shop_info.select("shop_id", *[c for c in shop_info.columns if c != "shop_id"])
    per_day = F.when(
        F.col("countDay") > 0, F.col("countPay") * F.col("per_pay") / F.col("countDay")
    ).otherwise(F.lit(0.0))
    ranked = activity.join(shops, "shop_id").select(per_day.alias("avgAmountPerDay"), "*")
    return top_k(ranked, F.col("avgAmountPerDay").desc_nulls_last(), F.col("shop_id").asc_nulls_last(), k=k)


def _with_welcome_score(shop_info):
    # Exact decimal arithmetic, then a double: the same value whatever the order of the additions.
    score = F.lit(Decimal("0.7")) * F.col("score") / 5 + F.lit(Decimal("0.3")) * F.col("per_pay")
    return shop_info.select(F.round(score.cast("double"), 6).alias("welcomeScore"), "*")


def welcome_top(shop_info, city, k=10):
    """Most popular shops of one city, by 0.7 * score / 5 + 0.3 * per_pay."""
    scored = _with_welcome_score(shop_info.where(F.col("city_name") == city))
    return top_k(scored, F.col("welcomeScore").desc_nulls_last(), F.col("shop_id").asc_nulls_last(), k=k)


def welcome_top_per_city(shop_info, cities=WELCOME_CITIES, k=10):
    """``welcome_top`` for several cities in one pass."""
    scored = _with_welcome_score(shop_info.where(F.col("city_name").isin(*cities)))
    return top_k_per_group(scored, "city_name", [F.col("welcomeScore").desc_nulls_last()], key="shop_id", k=k)


def welcome_documented(shop_info, cities=WELCOME_CITIES, category=WELCOME_CATEGORY, k=10):
    """Popularity as specified: shops of one category, spending relative to the largest of all candidates."""
    in_category = (
        (F.col("cate_1_name") == category) | (F.col("cate_2_name") == category) | (F.col("cate_3_name") == category)
    )
    candidates = shop_info.where(F.col("city_name").isin(*cities) & in_category)
    largest = candidates.agg(F.max("per_pay")).scalar()
    score = F.lit(0.7) * F.col("score") / 5 + F.try_divide(F.lit(0.3) * F.col("per_pay"), largest)
    scored = candidates.select(F.round(score, 6).alias("welcomeScore"), "*")
    return top_k_per_group(scored, "city_name", [F.col("welcomeScore").desc_nulls_last()], key="shop_id", k=k)


def shop_base_top(shop_info, k=10):
    return top_k(shop_info, F.col("shop_id").asc_nulls_last(), k=k)
