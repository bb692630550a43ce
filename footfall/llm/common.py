"""Helpers the operators share."""

import ctypes
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"
CHUNK_CHARS = 3_000_000


def words(text):
    """The words of a text column, separated by ASCII white space; a null text has none."""
    split = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(split, lambda word: word != "")


def bind(column, use):
    """``use(value)`` with ``column`` evaluated once, however often ``use`` mentions it."""
    return F.transform(F.array(column), use)[0]


def nested(docs, **columns):
    """All columns of ``docs`` as the struct ``_doc`` beside the given ones, so that no names clash; ``_doc.*`` has them back."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc")
    return docs.select(whole, *[column.alias(name) for name, column in columns.items()])


def few(df):
    """``df``, narrow rows of which there are few beside the texts, in no more parts than the cluster has cores."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def parts_of(lengths, rows, total):
    """Bounds of parts of at most so many rows and so much length together; one longer row is a part of its own."""
    bounds, held = [0], 0
    for i, n in enumerate(lengths.tolist()):
        if i - bounds[-1] >= rows or (i > bounds[-1] and held + n > total):
            bounds.append(i)
            held = 0
        held += n
    return [*bounds, len(lengths)] if len(lengths) else [0]


def slices(batch, column="text", limit=CHUNK_CHARS):
    """Parts of an Arrow batch whose texts stay near ``limit`` bytes; one longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, length in enumerate(lengths):
        if i > start and total + length > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(length)
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch, column="text"):
    return ["" if text is None else text for text in batch.column(column).to_pylist()]


def release():
    """Give memory that is free in this Python worker back to the machine: idle workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def released(run):
    """``run`` for mapInArrow, whose worker keeps no free memory after the task."""
    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


def gather(flat, starts, lengths):
    """The runs ``flat[start:start + length]`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def binary_column(values, bounds):
    """A binary Arrow column of the byte runs between ``bounds`` of a numpy array of bytes."""
    data = np.ascontiguousarray(values).view(np.uint8)
    offsets = pa.py_buffer(np.asarray(bounds, np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(data)]).cast(pa.binary())


def numbered(df, groups, order, salt, number="slot"):
    """A gapless number from 0 within each group, without gathering a group in one task.

    Rows of a group are dealt over buckets by ``salt``, a column of bounded range that only depends on the row, numbered
    by ``order`` within their bucket, and moved up by the rows of the buckets before. The offsets have a row for each group and bucket; ``groups`` must be columns
    of bounded range without nulls.
    """
    from pyspark.sql import Window

    salted = df.withColumn("_salt", salt.cast("int"))
    keys = [*groups, "_salt"]
    sizes = salted.groupBy(*keys).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    placed = salted.withColumn("_within", within.cast("long"))
    joined = placed.join(offsets, keys)
    return joined.select(*df.columns, (F.col("_within") + F.col("_offset")).alias(number))
