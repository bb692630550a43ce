"""Readers for the delimited shop and payment files.

The CSV source is not used: it honours quotes and drops empty lines, while here a quote is data and every line
is a row.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..fixed import SHOP_INFO_SCHEMA, USER_PAY_SCHEMA
from ..functions import line_fields, tolerant_int

_ROW_BITS = 33  # bits that monotonically_increasing_id() gives to the row within its partition


def _faults(schema):
    """Aggregates over split lines: how many there are, are too short or too long, and fields that are no integers."""
    bad = [
        F.count_if((F.get("fields", F.lit(i)) != "") & tolerant_int(F.get("fields", F.lit(i))).isNull()).alias(f"bad_{field.name}")
        for i, field in enumerate(schema) if field.dataType == IntegerType()
    ]
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.size("fields") < len(schema)).alias("short_lines"),
        F.count_if(F.size("fields") > len(schema)).alias("long_lines"),
        *bad,
    ]


def _parse(lines, schema, seen):
    # Two selects, so that a line is split once and not once per column.
    fields = lines.select(line_fields(F.col("value")).alias("fields"))
    if seen is not None:
        fields = fields.observe(seen, *_faults(schema))
    columns = []
    for i, field in enumerate(schema):
        text = F.get("fields", F.lit(i))
        column = tolerant_int(text) if field.dataType == IntegerType() else text
        columns.append(column.alias(field.name))
    return fields.select(*columns)


def parse_shop_info(lines, seen=None):
    """``value`` lines to typed shops: missing fields are null, surplus ones ignored, no line is dropped.

    ``seen``, an ``Observation``, counts the faults of the lines in the pass that reads them: ``lines``, ``short_lines``,
    ``long_lines`` and, for each integer column, ``bad_<column>``, fields that are there but are no integers. Its
    ``get`` has them once an action on the shops has run; all lines are counted only if that action needs all.
    """
    return _parse(lines, SHOP_INFO_SCHEMA, seen)


def parse_user_pay(lines, seen=None):
    return _parse(lines, USER_PAY_SCHEMA, seen)


def read_shop_info(spark, path, seen=None):
    return parse_shop_info(spark.read.text(path), seen)


def read_user_pay(spark, path, seen=None):
    return parse_user_pay(spark.read.text(path), seen)


def read_lines(spark, path):
    """``(value, ordinal)``, where ordinal grows with the position of the line (file name, then line).

    For the shop file, whose line order has meaning. A row id alone does not follow line order, as Spark packs file
    splits into partitions by size; within one split it does. So ordinal is (file, start of the split, row), which
    orders like any column and needs no second look at the file.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), row.alias("row")
    )
    return spark.read.text(path).select("value", place.alias("ordinal"))
