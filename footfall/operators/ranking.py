"""Top-k, ranks and running indexes. Every order ends in a key, so results do not depend on the run."""

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from ..session import write_shared

RANGES = 256  # at most: each is a leaf of the expression that finds the range of a row


def top_k(df, *order, k=10):
    return df.orderBy(*order).limit(k)


def top_k_per_group(df, group, order, key, k=10, rank="rk"):
    """First ``k`` rows of each group by ``order``, then by ``key``, with their rank.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark cuts each task's rows to ``k`` per group before
    the shuffle, so a hot group is small when it meets. Beyond it the cut is made here, on salted groups.
    """
    order = [*order, F.col(key).asc_nulls_last()]
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.xxhash64(key), F.lit(salts))
        partial = Window.partitionBy(group, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_rank", F.row_number().over(partial))
            .where(F.col("_rank") <= k)
            .drop("_salt", "_rank")
        )
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def rank_labels(df, name="cityName", value="totalPay", k=10):
    """``top<i>:<name>`` labels of the ``k`` largest values. The single-task window sees only those k rows."""
    order = [F.col(value).desc_nulls_last(), F.col(name).asc_nulls_last()]
    position = F.row_number().over(Window.orderBy(*order))
    return top_k(df, *order, k=k).select(
        F.concat(F.lit("top"), position.cast("string"), F.lit(":"), F.col(name)).alias("label"),
        F.col(value).cast("long").alias("price"),
    )


def _range_of(value, bounds, first=0):
    """The number of ``bounds`` (ascending) below ``value``, by halving: as many comparisons as the bounds have bits."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    above = _range_of(value, bounds[middle + 1:], first + middle + 1)
    return F.when(value > F.lit(bounds[middle]), above).otherwise(_range_of(value, bounds[:middle], first))


def _with_ranges(df, ordinal):
    """The rows of ``df``, written once, with a column ``_range`` that ascends with ``ordinal``.

    Bounds of numbers and times come from a quantile summary that is observed while the rows are written. The ordinal of
    a line has its range in itself, the file split it comes from. Other types are range-partitioned, which samples the
    written rows.
    """
    kind = df.schema[ordinal].dataType
    if isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        number = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), RANGES)
        seen = Observation()
        quantiles = F.percentile_approx(ordinal, [i / number for i in range(1, number)] or [1.0])
        rows = write_shared(df.observe(seen, quantiles.alias("bounds")), "appearance")
        found = _range_of(F.col(ordinal), sorted(set(seen.get["bounds"] or [])))
        return rows.withColumn("_range", F.when(F.col(ordinal).isNull(), F.lit(-1)).otherwise(found))
    rows = write_shared(df, "appearance")
    if getattr(kind, "names", None) == ["file", "start", "row"]:
        return rows.withColumn("_range", F.struct(f"{ordinal}.file", f"{ordinal}.start"))
    return write_shared(rows.repartitionByRange(ordinal).withColumn("_range", F.spark_partition_id()), "ranges")


def appearance_index(df, ordinal="ordinal", name="idx"):
    """Number rows 1, 2, 3, ... (bigint) by a unique ``ordinal`` of any type, without sorting all rows in one task.

    ``df`` runs once: its rows are kept in the shared folder, cut into ranges of about the same size. A row's index is
    its place in its range plus the rows of earlier ranges. Only the ranges, one row each, meet in one task.
    """
    ranged = _with_ranges(df, ordinal)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(ordinal)).cast("long")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_place", place).join(before, "_range")
    return placed.select((F.col("_before") + F.col("_place")).alias(name), *df.columns)
