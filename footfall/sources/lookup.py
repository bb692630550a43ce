"""Shop and city lists from the lines of the shop file, as ``(value, ordinal)``."""

from pyspark.sql import functions as F

from ..functions import line_fields


def _shop_city(lines):
    return (
        lines.select(line_fields(F.col("value")).alias("fields"), "ordinal")
        .where(F.size("fields") >= 2)
        .select(F.get("fields", F.lit(0)).alias("shop_id"), F.get("fields", F.lit(1)).alias("city_name"), "ordinal")
    )


def shop_city_lookup(lines):
    """City of each shop; the last line of a shop wins."""
    return _shop_city(lines).groupBy("shop_id").agg(F.max_by("city_name", "ordinal").alias("city_name"))


def first_appearance(lines, column):
    """Distinct ``shop_id`` or ``city_name`` with the ordinal of its first line, in no order."""
    return _shop_city(lines).groupBy(column).agg(F.min("ordinal").alias("ordinal"))


def distinct_shops(lines):
    return first_appearance(lines, "shop_id").orderBy("ordinal")


def distinct_cities(lines):
    return first_appearance(lines, "city_name").orderBy("ordinal")
