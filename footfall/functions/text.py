"""Column expressions for delimited text. All run inside generated code; none needs Python."""

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def line_fields(line):
    """Fields of a comma-separated line: no quoting, trailing empty fields do not exist.

    An empty line has one empty field; a line of only commas has none.
    """
    kept = F.rtrim(line, F.lit(","))
    no_fields = F.array().cast("array<string>")
    return F.when((kept == "") & (line != ""), no_fields).otherwise(F.split(kept, ","))


def first_field(line):
    return F.substring_index(line, ",", 1)


def second_field(line):
    """The field after the first comma, null without one."""
    return F.get(F.split(line, ","), F.lit(1))


def tolerant_int(text):
    """32-bit integer, or null for anything but an optional sign and digits within range.

    The pattern is needed because a cast alone would accept surrounding blanks. It also leaves no cast that can
    fail: ten digits fit a long, and a failing cast costs far more than the comparison with the range.
    """
    number = F.when(text.rlike(r"^[+-]?0*[0-9]{1,10}\z"), text.try_cast("long"))
    return F.when(number.between(-(1 << 31), (1 << 31) - 1), number.cast("int"))


def day_of(records):
    """Grouping column for the day of ``time_stamp``: its first ten characters, well-formed or not.

    A table that stores typed time stamps is grouped by date, which gives the same days without formatting every
    row as text. Cast the day to a string once grouped.
    """
    if isinstance(records.schema["time_stamp"].dataType, (TimestampType, TimestampNTZType, DateType)):
        return F.col("time_stamp").cast("date")
    return F.substring("time_stamp", 1, 10)


def non_empty(text):
    return text.isNotNull() & (F.length(text) > 0)
