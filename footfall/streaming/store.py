"""Counter table: totals of each run, one folder per micro-batch.

A run is the life of one checkpoint; its totals start at 0 and only grow. A replayed batch replaces its own folder and
totals do not depend on how often a batch ran, so nothing is counted twice. The total of a key is the sum over the
runs of its latest total in each, that of its highest batch. So counters may be kept when the checkpoint is renewed.
"""

import uuid

from pyspark.sql import functions as F

from ..fixed import COUNTER_SCHEMA

_BATCH = "slice=batch-"
_COMPACTED = "slice=upto-"
_LIST = "_folded"


def upsert_counters(batch_df, batch_id, path, run=0):
    """Write the totals that a micro-batch of a run changed; keys are unique.

    The rows are rebalanced by their size: a few keys make one file, many make as many as they need.
    """
    (
        batch_df.select("k", "count", F.lit(batch_id).cast("long").alias("batch_id"), F.lit(run).cast("long").alias("run"))
        .hint("rebalance")
        .write.mode("overwrite")
        .parquet(f"{path}/{_BATCH}{run:06d}-{batch_id:012d}")
    )


def run_of(spark, checkpoint, path):
    """The number of the run that a checkpoint folder belongs to.

    It lies inside the checkpoint, so a renewed checkpoint begins a new run: 0, or one more than any in the counters
    at ``path``.
    """
    folder = f"{checkpoint}/run"
    if not _Folder(spark, folder).names():
        last = _slices(spark, path).agg(F.max("run")).first()[0] if _Folder(spark, path).names() else None
        run = 0 if last is None else last + 1
        spark.createDataFrame([(str(run),)], "run string").coalesce(1).write.mode("overwrite").text(folder)
    return int(spark.read.text(folder).first()["value"])


def set_counters(batch_df, batch_id, connect, chunk=500):
    """Put the totals of a micro-batch into an external store, one client per partition.

    ``connect()`` runs on the executor and returns a client with ``set_many(pairs)``, which gets up to ``chunk`` pairs
    (key, count) at a time, and ``close()``. A failure fails the batch, which is then safe to run again as totals are
    set and not added.
    """

    def put(rows):
        client = connect()
        try:
            pairs = []
            for row in rows:
                pairs.append((row["k"], row["count"]))
                if len(pairs) == chunk:
                    client.set_many(pairs)
                    pairs = []
            if pairs:
                client.set_many(pairs)
        finally:
            client.close()

    batch_df.select("k", "count").foreachPartition(put)


class _Folder:
    """Names and removal in a folder of any file system that Spark reads: the one place that reaches into the JVM."""

    def __init__(self, spark, path):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self):
        if not self._fs.exists(self._folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._folder))

    def delete(self, name):
        self._fs.delete(self._path(self._folder, name), True)


def names_in(spark, path):
    """Names in a folder of any file system that Spark reads; none if there is no such folder."""
    return _Folder(spark, path).names()


def remove_from(spark, path, name):
    """Remove a file or folder of a folder."""
    _Folder(spark, path).delete(name)


def _slices(spark, path):
    return spark.read.schema(COUNTER_SCHEMA).parquet(path)


def _latest(slices):
    return slices.groupBy("run", "k").agg(
        F.max_by("count", "batch_id").alias("count"), F.max("batch_id").alias("batch_id")
    )


def read_counters(spark, path):
    """``(k, count)``; no rows where nothing was counted yet."""
    if not _Folder(spark, path).names():
        return spark.createDataFrame([], COUNTER_SCHEMA).select("k", "count")
    return _latest(_slices(spark, path)).groupBy("k").agg(F.sum("count").alias("count"))


def _folded(spark, compacted):
    """Names of the folders that a compacted one holds."""
    if _LIST not in _Folder(spark, compacted).names():
        return []
    return [row["value"] for row in spark.read.text(f"{compacted}/{_LIST}").collect()]  # a name for each past batch


def compact_counters(spark, path):
    """Fold the folders of past batches into one, so that reads do not grow with the age of the stream.

    For a separate job, one at a time, beside a running stream. The newest batch of each run may still be in writing
    and is left alone. Rows keep the run and the batch they came from, so readers get the same totals before, during
    and after. What a compaction has folded is deleted by the next one, so a reader that listed the old folders has the
    time between two compactions to finish.
    """
    folder = _Folder(spark, path)
    names = folder.names()
    folded = [name for kept in names if kept.startswith(_COMPACTED) for name in _folded(spark, f"{path}/{kept}")]
    for name in folded:
        folder.delete(name)
    names = [name for name in names if name not in folded]
    newest = {}
    for name in names:
        if name.startswith(_BATCH):
            newest[name.rpartition("-")[0]] = name
    past = [name for name in names if name.startswith(_BATCH) and name not in newest.values()]
    if not past:
        return
    old = past + [name for name in names if name.startswith(_COMPACTED)]
    target = f"{_COMPACTED}{uuid.uuid4().hex}"
    paths = [f"{path}/{name}" for name in old]
    totals = _latest(spark.read.schema(COUNTER_SCHEMA).option("basePath", path).parquet(*paths))
    totals.write.parquet(f"{path}/{target}")
    listed = spark.createDataFrame([(name,) for name in old], "name string")
    listed.coalesce(1).write.text(f"{path}/{target}/{_LIST}")  # readers pass over names with this start
