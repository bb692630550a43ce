"""Approximate nearest neighbours by inner product: several shifted Hilbert orderings of projected vectors.

Each curve projects the vectors on a few random orthogonal directions, shifts them, and orders them along a Hilbert
curve. Spark range-partitions the vectors by their place on each curve; the order is cut into blocks, and a query
meets its own block and those beside it. What the curves find is merged and ranked by the exact inner product.

How wide the windows are follows from the table: some queries are answered by brute force, and blocks, then windows,
grow until TARGET of these true neighbours lie in a window of any curve. Where windows would hold more places than the
table has rows, every query meets every row once instead.

A constant coordinate makes the largest inner product the smallest distance: vectors get sqrt(M**2 - norm**2), with M
the largest norm; queries are scaled to M and get 0.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.session import write_shared

CURVES, DIRECTIONS, BITS = 16, 8, 7
# Blocks start at BLOCK rows and grow to BLOCK_NUMBERS components; a group of vectors has at most about TILE queries.
BLOCK, BLOCK_NUMBERS, TILE = 2048, 1 << 20, 16_384
NEAREST = 20
# Recall aimed at, what a sample of PILOTS queries may be off by, and the scores that are held at a time.
TARGET, MARGIN, PILOTS, HELD = 0.9, 0.02, 128, 1 << 22
# Vectors of which the spread along each direction is taken.
SAMPLE = 20_000


def hilbert(cells, bits):
    """Places on the Hilbert curve of integer points (n, d) below 2**bits, with d * bits < 63."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo excess work of the coarser squares, from the largest
        low = bit - 1
        for i in range(d):
            swap = np.where((x[i] & bit) != 0, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where((x[i] & bit) != 0, low, swap)
            if i:
                x[i] ^= swap
        bit >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[d - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            place = place << 1 | x[i] >> b & 1
    return place


def _matrix(column, dims):
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def _usable(vectors, id_column, vector):
    """(id, v) of the vectors that take part: no null, no zero, all components finite, of the commonest length."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"))
    rows = rows.where("id is not null and v is not null").where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    top = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    return (rows.where(F.size("v") == top.dims), top.dims) if top else (rows, 0)


def _ordered(points, dims, seed):
    """Rows (curve, id, query) of every curve, with their place ``pos`` in the order by curve and place on it.

    Vectors stay behind: a curve orders some twenty bytes a row.
    """
    sample = points.where("not query").orderBy(F.xxhash64("id")).limit(SAMPLE)
    base = _stack(sample.select("v").toPandas()["v"], dims)
    largest = points.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).alias("m")).first().m
    rng = np.random.default_rng(seed)
    width = min(DIRECTIONS, dims + 1)
    curves = [np.linalg.qr(rng.normal(size=(dims + 1, width)))[0] for _ in range(CURVES)]
    shifts = rng.uniform(0, 1, (CURVES, width))
    lifted = _lift(base, np.zeros(len(base), bool), largest)
    centres = [(lifted @ c).mean(axis=0) for c in curves]
    spreads = [np.maximum((lifted @ c).std(axis=0), 1e-12) for c in curves]

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            x = _lift(v, batch.column("query").to_numpy(zero_copy_only=False), largest)
            for number in range(CURVES):
                # Three deviations to each side fill half of the cube, and the shift moves them within the whole.
                unit = np.clip(((x @ curves[number] - centres[number]) / spreads[number] + 3) / 6, 0, 1)
                cells = np.minimum((unit + shifts[number]) / 2 * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
                keys = hilbert(cells, BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), number, np.int32)), pa.array(keys), *map(batch.column, ("id", "query"))],
                    names=["curve", "key", "id", "query"],
                )

    keyed = points.select("id", "query", "v").mapInArrow(run, "curve int, key long, id long, query boolean")
    order = ["curve", "key", "id", "query"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def place(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), *map(batch.column, ("curve", "id", "query"))],
                names=["part", "at", "curve", "id", "query"],
            )
            at += n

    stored = write_shared(ranged.mapInArrow(place, "part int, at long, curve int, id long, query boolean"), "hilbert")
    sizes = stored.groupBy("part").agg(F.count("*").alias("n"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return stored.join(offsets, "part").select("curve", "id", "query", (F.col("offset") + F.col("at")).alias("pos"))


def _lift(v, query, largest):
    norm = np.sqrt((v * v).sum(axis=1))
    extra = np.where(query, 0.0, np.sqrt(np.maximum(largest ** 2 - norm ** 2, 0)))
    scale = np.where(query, largest / np.maximum(norm, 1e-300), 1.0)
    return np.column_stack([v * scale[:, None], extra])


def _stack(column, dims):
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, dims))


def _scores(dims, k):
    def run(rows):
        candidates, queries = rows[~rows["query"]], rows[rows["query"]]
        none = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(candidates) or not len(queries):
            return none
        c, q = _stack(candidates["v"], dims), _stack(queries["v"], dims)
        ids, asked = candidates["id"].to_numpy(), queries["id"].to_numpy()
        out, step = [none], max(1, HELD // len(c))
        for at in range(0, len(q), step):
            near = q[at:at + step] @ c.T
            # One more than asked for, as a query's own vector may be among them; equal scores at the edge all stay.
            edge = np.partition(near, -min(k + 1, near.shape[1]), axis=1)[:, -min(k + 1, near.shape[1])]
            row, column = np.nonzero(near >= (edge - 1e-12 * np.abs(edge))[:, None])
            exact = np.einsum("ij,ij->i", q[at + row], c[column])
            out.append(pd.DataFrame({"query_id": asked[at + row], "vec_id": ids[column], "score": exact}))
        return pd.concat(out)

    return run


def _pilot_places(placed, points, dims, k):
    """Places of pilot queries and of their true neighbours on each curve: arrays (pairs, CURVES) of both."""
    pilots = points.where("query").orderBy(F.xxhash64("id", F.lit(5)), "id").limit(PILOTS).select("id", "v", "query").toPandas()
    score = _scores(dims, k)

    def run(parts):
        for part in parts:
            yield score(pd.concat([part, pilots]))

    schema = "query_id long, vec_id long, score double"
    near = points.where("not query").select("id", "v", "query").mapInPandas(run, schema).where("query_id != vec_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    pairs = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("query_id", "vec_id")
    pairs = F.broadcast(write_shared(pairs, "pilots"))  # PILOTS * k rows
    there = placed.where("not query").join(pairs, placed["id"] == pairs["vec_id"]).select("query_id", "vec_id", "curve", F.col("pos").alias("to"))
    asked = F.broadcast(pairs.select("query_id").distinct())
    here = placed.where("query").join(asked, placed["id"] == asked["query_id"]).select("query_id", "curve", "pos")
    rows = there.join(here, ["query_id", "curve"]).orderBy("query_id", "vec_id", "curve").select("pos", "to").toPandas()
    return rows["pos"].to_numpy().reshape(-1, CURVES), rows["to"].to_numpy().reshape(-1, CURVES)


def _windows(placed, points, dims, k):
    """(rows of a block, blocks to each side, rows of the table); no blocks to each side: every query meets every row."""
    n = points.where("not query").count()
    longest = placed.where("curve = 0").count()
    if longest <= BLOCK:  # a curve lies in two blocks at most
        return BLOCK, 1, n
    here, there = _pilot_places(placed, points, dims, k)
    block, reach = BLOCK, 1
    while len(here):
        met = (np.abs(here // block - there // block) <= reach).any(axis=1).mean()
        if met >= TARGET + MARGIN:
            break
        if 2 * block <= max(BLOCK, BLOCK_NUMBERS // dims):
            block *= 2
        else:
            reach *= 2
        if CURVES * (2 * reach + 1) * block >= n:
            return block, 0, n
    return block, reach, n


def search(vectors, is_query, id_column="vec_id", vector="embedding", k=NEAREST, seed=0):
    """The ``k`` nearest found for every query: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on the id. Candidates are all rows but the query's own; score is the inner product of
    the original vectors in double precision; ties go to the smaller id. Null ids and vectors that are null, zero,
    of another length than most, or hold null or non-finite components take no part. Equal vectors stand for each
    other on the curves: each different vector is placed once, and its k + 1 smallest ids are put back at the end, so
    a vector that a third of all rows share fills no window. Rows that repeat an id are one, the one whose vector comes first
    in the order of components.
    """
    rows, dims = _usable(vectors, id_column, vector)
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return spark.createDataFrame([], schema)
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    rows = write_shared(rows, "vectors")
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    distinct = write_shared(ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    heads = distinct.select(F.col("ids")[0].alias("id"), "v", "ids")
    asked = rows.where(is_query(F.col("id"))).join(heads.select("v", F.col("id").alias("head")), "v").select("id", "head")
    asked = write_shared(asked, "queries")
    query_heads = asked.select(F.col("head").alias("id")).distinct().join(heads, "id")
    points = heads.select("id", "v", F.lit(False).alias("query")).unionByName(query_heads.select("id", "v", F.lit(True).alias("query")))
    points = write_shared(points, "points")

    placed = _ordered(points, dims, seed)
    block, reach, n = _windows(placed, points, dims, k)
    placed = placed.withColumn("block", F.floor(F.col("pos") / block))
    if reach:
        beside = F.array(*[F.col("block") + F.lit(i) for i in range(-reach, reach + 1)])
    else:
        placed = placed.where("curve = 0")
        last = placed.agg(F.max("block")).first()[0]
        beside = F.sequence(F.lit(0), F.lit(last))
    share = query_heads.count() / n
    tiles = max(1, math.ceil(share * ((2 * reach + 1) * block if reach else n) / TILE))
    # Candidates stand in every tile of their block, a query in one tile of the blocks that it meets.
    tile = F.when(F.col("query"), F.array(F.pmod(F.xxhash64("id"), F.lit(tiles)))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long")))
    met = placed.select(F.explode(F.when(F.col("query"), beside).otherwise(F.array("block"))).alias("block"), tile.alias("tile"), "curve", "id", "query")
    met = met.withColumn("tile", F.explode("tile")).join(points, ["id", "query"])
    # Blocks of one curve only, so that no vector is twice in a group, which holds at most a block of candidates and a tile of queries.
    found = met.groupBy("curve", "block", "tile").applyInPandas(_scores(dims, k), "query_id long, vec_id long, score double")
    found = found.dropDuplicates(["query_id", "vec_id"])
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).drop("n")
    best = write_shared(best, "found")
    members = best.join(heads.select(F.col("id").alias("vec_id"), "ids"), "vec_id")
    # Per query vector: its nearest ids, one more than asked for, as an array; then for each query without its own.
    listed = members.select("query_id", F.explode("ids").alias("vec_id"), "score")
    top = listed.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1)
    packed = top.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    each = asked.join(packed, asked["head"] == packed["query_id"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)
    numbered = F.posexplode(others).alias("at", "hit")
    return each.select(F.col("id").alias("query_id"), numbered).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
