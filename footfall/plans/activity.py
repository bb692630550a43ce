"""Payments and payment days per shop as a table that merges.

The days of a shop are bits: a row for each shop and month has a 32-bit map of the days with a payment, and their number.
Maps are joined by ``bit_or`` and numbers by ``sum``, so the activity of new payments is added to what is stored and old
payments are never read again. A distinct count has no such form, and one map over all days (``bitmap_construct_agg``)
takes 4 KB a shop where a month takes 4 bytes.

A day that is no ``yyyy-MM-dd`` text counts as one day of a period of its own, and a missing day as none, so that the
numbers are those of ``shop_activity`` on any payments.
"""

from pyspark.sql import functions as F

from ..functions import day_of

SCHEMA = "shop_id string, period string, days int, payments long"

_DAY = r"^[0-9]{4}-[0-9]{2}-(0[1-9]|[12][0-9]|3[01])$"
_SLICE = "slice="


def activity_maps(user_pay):
    """``(shop_id, period, days, payments)`` of payments: a row for each shop and month at most, and odd days beside.

    Payments are counted per shop and day before the days of a month meet, so a hot shop crosses each shuffle as a few
    rows per task.
    """
    per_day = user_pay.groupBy("shop_id", day_of(user_pay).alias("day")).agg(F.count("user_id").alias("payments"))
    text = F.col("day").cast("string")
    whole = text.rlike(_DAY)
    number = F.substring(text, 9, 2).try_cast("int")
    bits = F.when(whole, F.call_function("shiftleft", F.lit(1), number - 1)).when(text.isNotNull(), F.lit(1))
    maps = per_day.select(
        "shop_id",
        F.when(whole, F.substring(text, 1, 7)).otherwise(F.concat(F.lit("?"), text)).alias("period"),
        F.coalesce(bits, F.lit(0)).alias("days"),
        "payments",
    )
    return merge_activity(maps)


def merge_activity(*tables):
    """One table of several: maps of the same shop and period become one."""
    first, *others = tables
    for other in others:
        first = first.unionByName(other)
    return first.groupBy("shop_id", "period").agg(F.bit_or("days").alias("days"), F.sum("payments").alias("payments"))


def activity_of(maps):
    """``(shop_id, countPay, countDay)`` as ``shop_activity`` gives it, from maps that need not be merged yet."""
    return merge_activity(maps).groupBy("shop_id").agg(
        F.sum("payments").alias("countPay"), F.sum(F.bit_count("days").cast("long")).alias("countDay")
    )


def store_activity(user_pay, path, name):
    """Write the maps of some payments as the slice ``name``, such as their day of arrival.

    Storing a slice again replaces it, so a job that failed half-way may simply run again.
    """
    activity_maps(user_pay).write.mode("overwrite").parquet(f"{path}/{_SLICE}{name}")


def stored_activity(spark, path):
    """The maps of all slices. Take ``activity_of`` for the numbers."""
    return spark.read.schema(SCHEMA).parquet(path)
