"""Running payment counts per shop and per city."""

from functools import partial

from pyspark.sql import functions as F

from ..fixed import CITY_KEY_PREFIX, SHOP_KEY_PREFIX
from ..functions import first_field
from ..operators import hot_of, key_summary, lookup_join
from ..operators.joins import MOST_HOT
from ..session import write_shared
from .store import read_counters, run_of, upsert_counters


def _keys(shop_id="shop_id", city_name="city_name"):
    # A missing shop or city is spelled out, so that its payments are still counted.
    return F.array(
        F.concat(F.lit(SHOP_KEY_PREFIX), F.coalesce(shop_id, F.lit("null"))),
        F.concat(F.lit(CITY_KEY_PREFIX), F.coalesce(city_name, F.lit("null"))),
    )


def key_counts(records, lookup, hot=None, **join):
    """Counts ``(k, count)`` of both key families, for a batch or a stream of records.

    ``lookup`` holds one city per shop. A batch is counted per shop before it is joined. A stream can aggregate
    only once in update mode, so each record is joined, then counted with a map-side combine before the state; ``hot``
    and ``join`` go to ``lookup_join``.
    """
    shops = records.select(first_field(F.col("value")).alias("shop_id"), F.xxhash64("key", "value").alias("record"))
    if records.isStreaming:
        keyed = lookup_join(shops, lookup, "shop_id", by="record", hot=hot, **join).select(F.explode(_keys()).alias("k"))
        return keyed.groupBy("k").count()
    per_shop = shops.groupBy("shop_id").agg(F.count("*").alias("n")).join(lookup, "shop_id", "left")
    return per_shop.select(F.explode(_keys()).alias("k"), "n").groupBy("k").agg(F.sum("n").alias("count"))


def hot_shops(counters, share=None):
    """Shops with more than ``share`` of what is counted so far, at most ``MOST_HOT``: exact, from the stored counters."""
    share = share or 0.2 / int(counters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shops = counters.where(F.col("k").startswith(SHOP_KEY_PREFIX))
    total = shops.agg(F.sum("count")).first()[0] or 0
    found = shops.where(F.col("count") > share * total).orderBy(F.col("count").desc(), "k").limit(MOST_HOT).collect()
    return [row["k"].removeprefix(SHOP_KEY_PREFIX) for row in found]


def start_counter_stream(records, lookup, root, sink=None, trigger=None, hot=None, checkpoint="checkpoint", **join):
    """Start the counting query; its checkpoint and its counters live together under ``root``.

    The counters stay when the checkpoint is renewed: the new query adds to them. ``join`` goes to ``lookup_join``, as
    does ``hot``, by default the shops that the counters at ``root`` show to be hot when the query starts. Every
    micro-batch observes the shops of its own records under the name ``shops`` (columns ``top``, ``n``) in the query's progress, so
    that a shop that becomes hot meanwhile shows: restart the query to salt it.

    The lookup is read once, at the start, and written to the shared folder, so that the query does not depend on
    the shop file afterwards; restart the query to refresh it. ``sink(batch_df, batch_id)`` may replace the
    counter table by an external store.
    """
    lookup = write_shared(lookup, "lookup")  # not persisted: nothing is left behind when the query ends
    spark = lookup.sparkSession
    run = run_of(spark, f"{root}/{checkpoint}", f"{root}/counters")
    sink = sink or partial(upsert_counters, path=f"{root}/counters", run=run)
    if hot is None:
        hot = hot_shops(read_counters(spark, f"{root}/counters"))
    named = records.withColumn("_shop", first_field(F.col("value")))
    watched = named.observe("shops", key_summary("_shop").alias("top"), F.count(F.lit(1)).alias("n")).drop("_shop")
    return (
        key_counts(watched, lookup, hot=hot, **join)
        .writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{root}/{checkpoint}")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def newly_hot(query, hot, share):
    """Shops of the last micro-batch that hold more than ``share`` of its records and are not in ``hot``."""
    progress = query.lastProgress
    seen = progress.observedMetrics.get("shops") if progress else None
    return [shop for shop in hot_of(seen["top"], seen["n"], share) if shop not in hot] if seen else []
