"""Token ids in files: ranks by frequency, each in one to four bytes, their lengths in separate control bytes.

A file holds the documents of one run in ascending order of their ids:

    b"FRV1", documents (uint64), values (uint64)
    document ids (int64), a null mark for each (uint8), values of each document (uint32)
    control bytes, one for four values: two bits each, the value's length less one, lowest bits first
    data bytes: each value's low bytes, little-endian

A value is the rank of a token id among all ids of the corpus by falling frequency, so the 256 most frequent ids take
one byte each. ``ranks`` beside the files holds the id of each rank.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.llm.common import binary_column
from footfall.llm.encoded import encoded, id_type
from footfall.session import shared_folder

MAGIC = b"FRV1"
FILE_VALUES = 8_000_000
MANIFEST = "part int, seq long, n_docs long, n_values long"

# The lengths of the four values that a control byte describes.
LENGTHS = (np.arange(256)[:, None] >> (2 * np.arange(4)) & 3) + 1


def pack_values(values):
    """Control bytes and data bytes of unsigned values below 2**32."""
    values = np.ascontiguousarray(values, "<u4")
    lengths = 1 + (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[:len(values)] = lengths - 1
    control = (codes.reshape(-1, 4) << (2 * np.arange(4, dtype=np.uint8))).sum(axis=1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    return control, data


def unpack_values(control, data, count):
    """The values back, by table look-up of their lengths."""
    lengths = LENGTHS[control].ravel()[:count]
    starts = np.cumsum(lengths) - lengths
    padded = np.append(data, np.zeros(3, np.uint8))
    values = padded[starts].astype(np.uint32)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(lengths > byte)
        values[longer] |= padded[starts[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def file_bytes(doc_ids, counts, ranks):
    control, data = pack_values(ranks)
    null = np.array([id is None for id in doc_ids], np.uint8)
    ids = np.array([0 if id is None else id for id in doc_ids], "<i8")
    head = MAGIC + np.array([len(ids), len(ranks)], "<u8").tobytes()
    return b"".join([head, ids.tobytes(), null.tobytes(), np.asarray(counts, "<u4").tobytes(), control.tobytes(), data.tobytes()])


def parse_file(content):
    """Document ids, values of each document, and all values of a file."""
    if content[:4] != MAGIC:
        raise ValueError("not a file of ranks")
    docs, values = np.frombuffer(content, "<u8", 2, 4).tolist()
    at = 20
    ids = np.frombuffer(content, "<i8", docs, at).tolist()
    null = np.frombuffer(content, np.uint8, docs, at + 8 * docs)
    counts = np.frombuffer(content, "<u4", docs, at + 9 * docs)
    at += 13 * docs
    control = np.frombuffer(content, np.uint8, -(-values // 4), at)
    data = np.frombuffer(content, np.uint8, -1, at + len(control))
    return [None if gone else id for id, gone in zip(ids, null)], counts, unpack_values(control, data, values)


def _values(column, kind):
    """The ids of all rows of a binary Arrow column one after another, and how many each row has."""
    width = np.dtype(kind).itemsize
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    data = b"" if data is None else memoryview(data)[offsets[0]:offsets[-1]]
    return np.frombuffer(data, kind), np.diff(offsets) // width


def _put(folder, name, content):
    """Write a file whole or not at all, so that a task that runs again replaces it."""
    from pyarrow import fs

    # Arrow has one name for the store that Spark's clients name in three ways.
    scheme, colon, rest = folder.partition("://")
    system, path = fs.FileSystem.from_uri(f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(content)
    system.move(draft, f"{path}/{name}")


def write(docs, folder, path, end_id):
    """Write the ids of all documents (doc_id, text) under ``folder``, in ascending doc_id order.

    ``folder`` must be one that all executors reach. Texts are encoded once, range-partitioned by doc_id (rows of one
    doc_id may be dealt over neighbouring ranges); frequencies cover all documents. A null text counts as empty; a
    null doc_id comes first. Returns the manifest: a row for each file.
    """
    spark = docs.sparkSession
    kind = id_type(path, end_id)

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for rows, ids, counts in encoded(batches, path, end_id):
            width = np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows.num_rows, part, np.int32)),
                    pa.array(np.arange(seq, seq + rows.num_rows)),
                    rows.column("doc_id"),
                    binary_column(ids.astype(kind), np.append(0, np.cumsum(counts)) * width),
                ],
                names=["part", "seq", "doc_id", "ids"],
            )
            seq += rows.num_rows

    ordered = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    stored = shared_folder(spark, "token-ids")
    ordered.mapInArrow(run, "part int, seq long, doc_id long, ids binary").write.parquet(stored)
    rows = spark.read.parquet(stored)

    by_rank = _ids_by_rank(rows, kind)
    ranks = spark.createDataFrame(list(enumerate(by_rank.tolist())), "rank int, id long")
    ranks.coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(int(by_rank.max(initial=-1)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)  # no longer than the vocabulary

    def put(batches):
        file = None  # (part, first seq, document ids, counts, values) in the making

        def done():
            part, seq, ids, counts, values = file
            values = np.concatenate(values)
            _put(f"{folder}/files", f"{part:08d}-{seq:012d}.frv", file_bytes(ids, np.concatenate(counts), values))
            out = [part], [seq], [len(ids)], [len(values)]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int32(), *[pa.int64()] * 3))], names=["part", "seq", "n_docs", "n_values"])

        for batch in batches:
            part, seq = batch.column("part").to_numpy(), batch.column("seq").to_numpy()
            doc_ids = batch.column("doc_id").to_pylist()
            ids, counts = _values(batch.column("ids"), kind)
            ranks, bounds = shared.value[ids], np.append(0, np.cumsum(counts))
            breaks = np.flatnonzero((part[1:] != part[:-1]) | (seq[1:] != seq[:-1] + 1)) + 1
            for start, end in zip([0, *breaks.tolist()], [*breaks.tolist(), len(part)]):
                while start < end:
                    if file and (part[start], seq[start]) != (file[0], file[1] + len(file[2])):
                        yield done()
                        file = None
                    held = sum(map(len, file[4])) if file else 0
                    # As many documents as fit; one that is longer than a file is a file.
                    until = int(np.searchsorted(bounds, bounds[start] + FILE_VALUES - held, "right")) - 1
                    until = min(max(until, start if file else start + 1), end)
                    file = file or (int(part[start]), int(seq[start]), [], [], [])
                    file[2].extend(doc_ids[start:until])
                    file[3].append(counts[start:until])
                    file[4].append(ranks[bounds[start]:bounds[until]])
                    start = until
                    if start < end:
                        yield done()
                        file = None
        if file:
            yield done()

    rows.select("part", "seq", "doc_id", "ids").mapInArrow(put, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _ids_by_rank(rows, kind):
    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(_values(batch.column("ids"), kind)[0], minlength=len(total))
            own[:len(total)] += total
            total = own
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    totals = rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    pairs = np.array(totals.collect(), np.int64).reshape(-1, 2)  # at most a row for each id of the vocabulary
    return pairs[np.lexsort((pairs[:, 0], -pairs[:, 1])), 0]


def read(spark, folder):
    """All documents of ``folder``: doc_id, start (ids before it), n_tokens, ids (little-endian uint32).

    Each file is decoded by one task; a file's place among all ids is the sum over the files before it.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    schema = "part int, seq long, doc_id long, before long, n_tokens long, ids binary"
    by_rank = np.array(
        [row.id for row in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()], np.uint32
    )  # no longer than the vocabulary
    shared = spark.sparkContext.broadcast(by_rank)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                part, seq = map(int, name.rsplit("/", 1)[1].removesuffix(".frv").split("-"))
                doc_ids, counts, values = parse_file(content.as_buffer().to_pybytes())
                ids = shared.value[values]
                bounds = np.append(0, np.cumsum(counts, dtype=np.int64))
                for at in range(0, len(doc_ids), 2000):
                    cut = slice(at, at + 2000)
                    edges = bounds[at:at + 2001]
                    n = len(edges) - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, part, np.int32)),
                            pa.array(np.full(n, seq, np.int64)),
                            pa.array(doc_ids[cut], pa.int64()),
                            pa.array(edges[:-1]),
                            pa.array(counts[cut].astype(np.int64)),
                            binary_column(ids[edges[0]:edges[-1]], (edges - edges[0]) * 4),
                        ],
                        names=["part", "seq", "doc_id", "before", "n_tokens", "ids"],
                    )

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.frv").load(f"{folder}/files")
    docs = files.select("path", "content").mapInArrow(run, schema)
    # One row for each file, so the window's rows are fewer than the documents by thousands.
    sums = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select("part", "seq", F.coalesce(F.sum("n_values").over(sums), F.lit(0)).alias("offset"))
    found = docs.join(offsets, ["part", "seq"])
    return found.select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids")


def digests(docs, path, end_id=2):
    """Write all documents to files, read them back: doc_id, start, n_tokens and the crc32 of the ids.

    An empty table gives no rows. Repeated doc_ids each keep a row.
    """
    folder = shared_folder(docs.sparkSession, "token-files")
    write(docs, folder, path, end_id)
    return read(docs.sparkSession, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
