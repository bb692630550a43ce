"""Counters of the known shops and cities, numbered in the order in which the shop file names them."""

from pyspark.sql import functions as F

from ..fixed import CITY_KEY_PREFIX, SHOP_KEY_PREFIX
from ..operators import appearance_index


def _report(names, counters, column, prefix):
    shown = counters.where(F.col("count").isNotNull()).select("k", "count")
    found = names.withColumn("k", F.concat(F.lit(prefix), F.col(column))).join(shown, "k")
    return appearance_index(found.select(column, "count", "ordinal")).select(F.col("idx").cast("int").alias("idx"), column, "count").orderBy("idx")


def shop_counter_report(shops, counters):
    """``shops`` is ``(shop_id, ordinal)``, one row per shop; shops without a counter are left out."""
    return _report(shops, counters, "shop_id", SHOP_KEY_PREFIX)


def city_counter_report(cities, counters):
    return _report(cities, counters, "city_name", CITY_KEY_PREFIX)
