"""Counters by increments: each micro-batch is counted per shop, then looked up, and its counts are kept as they are.

A record is never joined: the lookup meets a row for each shop of a micro-batch, and is read anew for each. There is no
state. A total is the sum of the increments of all micro-batches, a folder each, which a replayed batch replaces.
"""

import re
from functools import partial

from pyspark.sql import functions as F

from .counters import key_counts
from .store import names_in, remove_from

SCHEMA = "k string, count long"

_NAME = re.compile(r"(batch|upto)-([0-9]{12})$")


def write_increments(batch_df, batch_id, lookup, path):
    """Count the records of a micro-batch by shop and city and write the counts; ``lookup()`` gives the city of each shop."""
    counted = key_counts(batch_df, lookup())
    counted.hint("rebalance").write.mode("overwrite").parquet(f"{path}/batch-{batch_id:012d}")


def start_increment_stream(records, lookup, root, trigger=None):
    """Start the query; its checkpoint and its increments live under ``root``.

    ``lookup`` is called for each micro-batch, so a shop that moves counts for its new city from the next one on.
    """
    return (
        records.writeStream.foreachBatch(partial(write_increments, lookup=lookup, path=f"{root}/increments"))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def _complete(spark, path):
    """(kind, batch) of the folders that are written to the end."""
    found = (_NAME.match(name) for name in names_in(spark, path))
    return sorted((m[1], int(m[2])) for m in found if m and "_SUCCESS" in names_in(spark, f"{path}/{m[0]}"))


def _current(spark, path):
    """Paths of the folders that make up the totals: the newest fold and the micro-batches after it."""
    found = _complete(spark, path)
    folded = max((batch for kind, batch in found if kind == "upto"), default=-1)
    batches = [batch for kind, batch in found if kind == "batch" and batch > folded]
    paths = [f"{path}/batch-{batch:012d}" for batch in batches]
    return folded, batches, [f"{path}/upto-{folded:012d}"] * (folded >= 0) + paths


def read_increments(spark, path):
    """``(k, count)``: the sums of all complete increments; no rows where nothing was counted yet."""
    _, _, paths = _current(spark, path)
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*paths).groupBy("k").agg(F.sum("count").alias("count"))


def fold_increments(spark, path):
    """Fold past increments into one folder, so that reads do not grow with the age of the stream.

    For a separate job beside the stream, one at a time. The newest micro-batch may be written again and is left alone. A fold
    replaces what it holds only once it is complete, and the folders in it stay until the next call: a reader that chose
    them before goes on undisturbed. An interrupted fold is made anew.
    """
    folded, batches, paths = _current(spark, path)
    stale = [name for name in names_in(spark, path) if (m := _NAME.match(name)) and (
        int(m[2]) < folded if m[1] == "upto" else int(m[2]) <= folded)]
    for name in stale:
        remove_from(spark, path, name)
    if len(batches) < 2:
        return
    last = batches[-2]
    sums = spark.read.schema(SCHEMA).parquet(*paths[:-1]).groupBy("k").agg(F.sum("count").alias("count"))
    sums.write.mode("overwrite").parquet(f"{path}/upto-{last:012d}")
