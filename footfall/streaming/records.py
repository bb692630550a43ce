"""Payment records, (key = user, value = "shop,time stamp"), to and from topics."""

from pyspark.sql import functions as F

from ..fixed import RECORD_SCHEMA


def pay_to_records(user_pay, copies=1):
    """Key/value records of the payments that have all three fields.

    A parsed line has its third field only if it has the first two. ``copies`` publishes each record more than
    once.
    """
    value = F.concat(F.coalesce("shop_id", F.lit("")), F.lit(","), F.col("time_stamp").cast("string"))
    records = user_pay.where(F.col("time_stamp").isNotNull()).select(F.col("user_id").alias("key"), value.alias("value"))
    if copies == 1:
        return records
    return records.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("_copy")


def write_records(records, options):
    """Publish records with the batch writer; ``options`` as for ``kafka_source`` or any other sink format."""
    options = dict(options)
    records.write.format(options.pop("format", "kafka")).options(**options).mode("append").save()


def kafka_source(servers, topics, **options):
    """Options of a topic source. Several topics are separated by commas; new records only, unless told otherwise.

    Pass ``minPartitions`` to read a topic partition that holds much of the data in several tasks, and
    ``maxOffsetsPerTrigger`` to bound a micro-batch.
    """
    return {
        "format": "kafka",
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": "latest",
        **options,
    }


def archived_files(path, archive, format="parquet", **options):
    """Options of a file source that moves each file to ``archive`` once the batch after its own is committed.

    So the folder that is listed for every micro-batch holds new files only, however long the stream runs. ``archive``
    must be outside ``path``, on the same file system. Totals do not depend on it: files that were read are known by name.
    """
    return {"format": format, "path": path, "cleanSource": "archive", "sourceArchiveDir": archive, **options}


def record_view(raw):
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def read_raw_stream(spark, source):
    """Streaming frame with all columns of the source; from ``kafka_source`` or a file format and path."""
    options = dict(source)
    source_format = options.pop("format")
    reader = spark.readStream.format(source_format).options(**options)
    if source_format != "kafka":
        reader = reader.schema(RECORD_SCHEMA)
    return reader.load()


def read_pay_stream(spark, source):
    """Streaming (key, value) strings of ``read_raw_stream``."""
    return record_view(read_raw_stream(spark, source))


def event_audit(raw):
    """Each record with its topic, offset and timestamp, from ``read_raw_stream`` on a topic."""
    return raw.select(
        "topic",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )
