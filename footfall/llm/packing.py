"""Packing of token ids into sequences: shortest pack first over the histogram of lengths."""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.llm.common import binary_column, released
from footfall.llm.encoded import encoded, id_type
from footfall.session import shared_folder, write_shared


def plan(histogram, size):
    """Packing patterns for ``{length: count}``: a list of (how often, lengths, longest first).

    Lengths are placed longest first. A length goes to the shortest pack, the one with most room; a pattern's count is
    split if it is larger than what is left to place. Where none has room, new packs take as many of the length as fit,
    since a new pack is the shortest one for the next. The work depends on the number of lengths, not of documents.
    """
    open_packs = [[] for _ in range(size + 1)]  # by room left: [count, lengths]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            room = next((r for r in range(size, length - 1, -1) if open_packs[r]), None)
            if room is None:
                fit = size // length
                packs, rest = divmod(left, fit)
                for count, times in ((packs, fit), (1, rest)):
                    if count and times:
                        open_packs[size - times * length].append([count, (length,) * times])
                break
            count, lengths = open_packs[room].pop()
            taken = min(count, left)
            if count > taken:
                open_packs[room].append([count - taken, lengths])
            open_packs[room - length].append([taken, (*lengths, length)])
            left -= taken
    return [(count, lengths) for packs in open_packs for count, lengths in packs]


def intervals(patterns):
    """Where the ranks of each length lie: arrays (length, first rank, first sequence, times in a pack, first offset).

    Equal lengths lie beside each other in a pack, so a rank fixes sequence and offset.
    """
    next_rank, rows, sequence = {}, [], 0
    for count, lengths in patterns:
        offset = 0
        for length in dict.fromkeys(lengths):
            times = lengths.count(length)
            rank = next_rank.get(length, 0)
            rows.append((length, rank, sequence, times, offset))
            next_rank[length] = rank + count * times
            offset += length * times
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5).T


def _ranks(lengths, before):
    """The rank of each length among equal ones, after ``before[length]`` earlier ones; ``before`` is moved on."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    begins = np.flatnonzero(np.diff(ordered, prepend=-1))
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths)) - np.repeat(begins, np.diff(np.append(begins, len(lengths)))) + before[ordered]
    before += np.bincount(lengths, minlength=len(before))
    return rank


def pieces(docs, path, end_id, size, payload="ids"):
    """Ids of each whole text with ``end_id`` after it, cut into pieces of ``size`` and a rest.

    Columns doc_id, start, length, doc_tokens, task, rank and the payload: ``ids`` (little-endian, of the type returned)
    or ``ids_crc32``. A piece's rank counts the pieces of its length that its encoding task met before. The table is written to the
    shared folder, so texts are encoded once and ranks are those of one attempt of each task. A null text counts as empty.
    """
    kind = id_type(path, end_id)

    def run(batches):
        met = np.zeros(size + 1, np.int64)
        task = TaskContext.get().partitionId()
        for rows, ids, counts in encoded(batches, path, end_id):
            number = -(-counts // size)
            of = np.repeat(np.arange(len(counts)), number)
            start = (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)) * size
            length = np.minimum(size, counts[of] - start)
            bounds = np.append(0, np.cumsum(length))
            if payload == "ids":
                own = binary_column(ids.astype(kind), bounds * np.dtype(kind).itemsize)
            else:
                data = memoryview(ids.astype("<u4")).cast("B")
                edges = (4 * bounds).tolist()
                own = pa.array([zlib.crc32(data[a:b]) for a, b in zip(edges, edges[1:])], pa.int64())
            columns = [
                rows.column("doc_id").take(pa.array(of)),
                pa.array(start), pa.array(length), pa.array(counts[of]),
                pa.array(np.full(len(of), task)), pa.array(_ranks(length, met)), own,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "task", "rank", payload])

    path_out = shared_folder(docs.sparkSession, "pieces")
    cut = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        released(run), "doc_id long, start long, length long, doc_tokens long, task long, rank long, "
        + ("ids binary" if payload == "ids" else "ids_crc32 long")
    )
    cut.write.parquet(path_out)
    return docs.sparkSession.read.parquet(path_out), kind


def pack(docs, path, end_id=1, size=2048, payload="ids"):
    """All documents (doc_id, text) in sequences of at most ``size`` ids.

    A row for each piece: doc_id, start, length, doc_tokens, ids (little-endian uint32) or, as ``payload``, ids_crc32,
    sequence_id, offset. Offsets of a sequence are gapless from 0. A null text has the end id alone; equal rows are
    packed each; an empty table gives no rows. Pieces are ranked where they are encoded; only a number for each task and length is
    ordered, so a length that a third of all pieces share meets nowhere.
    """
    cut, kind = pieces(docs, path, end_id, size, payload)
    by_task = write_shared(cut.groupBy("length", "task").agg((F.max("rank") + 1).alias("n")), "piece-counts")
    counts = {row.length: row.n for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= size rows
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    moved = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    table = intervals(plan(counts, size))
    if not table.size:
        table = np.zeros((5, 1), np.int64)
    lengths, firsts, sequences, times, offsets = table
    begins = np.searchsorted(lengths, np.arange(size + 2))  # the intervals of a length lie together

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.empty(len(length), np.int64)
        for one in np.unique(length):
            own = np.flatnonzero(length == one)
            begin, end = begins[one], begins[one + 1]
            at[own] = begin + np.searchsorted(firsts[begin:end], rank[own], "right") - 1
        within = rank - firsts[at]
        return pd.DataFrame({
            "sequence_id": sequences[at] + within // times[at],
            "offset": offsets[at] + within % times[at] * length,
        })

    @F.pandas_udf("binary")
    def widen(ids: pd.Series) -> pd.Series:
        return ids.map(lambda own: np.frombuffer(own, kind).astype("<u4").tobytes())

    ranked = cut.join(moved, ["length", "task"]).withColumn("_place", place("length", F.col("rank") + F.col("_before")))
    own = widen("ids").alias("ids") if payload == "ids" else F.col(payload)
    return ranked.select("doc_id", "start", "length", "doc_tokens", own, "_place.sequence_id", "_place.offset")


def digests(docs, path, end_id=1, size=2048):
    """``pack`` with the crc32 of each piece's ids in place of the ids, taken where they are encoded."""
    packed = pack(docs, path, end_id, size, "ids_crc32")
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
