"""What a checkpoint holds: the counters of its state as a table, and how far its sources were read."""

import json

from pyspark.sql import functions as F

from .store import names_in, upsert_counters


def counters_from_state(spark, checkpoint, batch_id=None):
    """``(k, count)`` of a counter stream as its state store has them after a batch, by default the last committed one."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select(F.col("key.k").alias("k"), F.col("value.count").alias("count"))


def state_partitions(spark, checkpoint):
    """The number of shuffle partitions that the checkpoint is fixed to."""
    return spark.read.format("state-metadata").load(checkpoint).agg(F.max("numPartitions")).first()[0]


def restore_counters(spark, checkpoint, path, run=0):
    """Write the counters of a checkpoint's state to a counter table, as the totals of ``run``.

    For a table that was lost, or for the start of a run with another number of shuffle partitions: a checkpoint
    cannot change that number, so the next run gets a checkpoint of its own, counts from 0, and adds to the run written here. It
    has to begin where the old one ended (``read_offsets``).
    """
    upsert_counters(counters_from_state(spark, checkpoint), 0, path, run)


def read_offsets(spark, checkpoint):
    """The last committed offsets of each source of a checkpoint, as a list of dicts.

    For a topic, ``{topic: {partition: offset}}`` as JSON is the ``startingOffsets`` of a run that goes on from there.
    Nothing committed gives an empty list.
    """
    done = [int(name) for name in names_in(spark, f"{checkpoint}/commits") if name.isdigit()]
    if not done:
        return []
    lines = spark.read.text(f"{checkpoint}/offsets/{max(done)}", wholetext=True).first()["value"].splitlines()
    return [json.loads(line) for line in lines[2:] if line != "-"]  # after the version and the settings
