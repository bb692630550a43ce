"""Payments and payment days per shop as a stream: two stateful operators in one query.

The first keeps the distinct (shop, day) pairs and lets each pass once; the second adds up payments and first payments of
a day per shop. Its totals go to the counter table's form, a folder per micro-batch, and survive restarts with the state.
"""

from functools import partial

from pyspark.sql import functions as F

from ..functions import first_field, second_field
from .store import run_of

SCHEMA = "shop_id string, countPay long, countDay long, batch_id long, run long"


def _payments(records):
    value = F.col("value")
    return records.select(first_field(value).alias("shop_id"), F.substring(second_field(value), 1, 10).alias("day"))


def activity_counts(records, late=None):
    """``(shop_id, countPay, countDay)`` of a stream of (key, value) records, in update mode.

    The state has a row for each shop and day ever met, and one for each shop. Of records without a day, payments count.

    With ``late``, such as "40 days", days are dates, and those more than that behind the latest day leave the state. A payment
    that comes later than that still counts as a payment, but its day counts no more; so does a payment whose day is no date.
    """
    payments = _payments(records)
    if late is None:
        days = payments.where(F.col("day").isNotNull()).dropDuplicates(["shop_id", "day"])
    else:
        dated = payments.select("shop_id", F.try_to_timestamp("day", F.lit("yyyy-MM-dd")).alias("date"))
        days = dated.where(F.col("date").isNotNull()).withWatermark("date", late).dropDuplicates(["shop_id", "date"])
    every = payments.select("shop_id", F.lit(1).alias("pay"), F.lit(0).alias("first"))
    first = days.select("shop_id", F.lit(0).alias("pay"), F.lit(1).alias("first"))
    return every.unionByName(first).groupBy("shop_id").agg(F.sum("pay").alias("countPay"), F.sum("first").alias("countDay"))


def write_activity(batch_df, batch_id, path, run=0):
    """Write the totals that a micro-batch of a run changed; a replayed batch replaces its folder."""
    named = batch_df.select("*", F.lit(batch_id).cast("long").alias("batch_id"), F.lit(run).cast("long").alias("run"))
    named.hint("rebalance").write.mode("overwrite").parquet(f"{path}/slice=batch-{run:06d}-{batch_id:012d}")


def read_activity(spark, path):
    """``(shop_id, countPay, countDay)``: the latest totals of each shop.

    Only one run is read, the last: days that two runs both met would count twice, so a renewed checkpoint has to
    read its payments from the start.
    """
    slices = spark.read.schema(SCHEMA).parquet(path)
    last = slices.agg(F.max("run")).first()[0]
    totals = F.struct("countPay", "countDay")
    latest = slices.where(F.col("run") == last).groupBy("shop_id").agg(F.max_by(totals, "batch_id").alias("totals"))
    return latest.select("shop_id", "totals.countPay", "totals.countDay")


def start_activity_stream(records, root, trigger=None, late=None):
    """Start the query; its checkpoint and its totals live under ``root``. ``late`` goes to ``activity_counts``."""
    run = run_of(records.sparkSession, f"{root}/checkpoint", f"{root}/activity")
    return (
        activity_counts(records, late)
        .writeStream.outputMode("update")
        .foreachBatch(partial(write_activity, path=f"{root}/activity", run=run))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
