"""Session settings and the shared folder for written intermediates."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on. Shuffle partition count and executor sizes belong to the deployment.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # One state row per shop and city for ever: keep it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit what a micro-batch changed, not all of the state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_root = None


def build_session(app="footfall", master=None, **conf):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark, purpose):
    """A fresh path under the cluster's shared folder.

    The cluster names that folder in ``spark.checkpoint.dir``. A local session without the setting uses one
    temporary folder of its own; a cluster session without it is refused, since executors share no local disk.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        _local_root = _local_root or tempfile.mkdtemp(prefix="footfall-")
        root = _local_root
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def write_shared(df, purpose):
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
