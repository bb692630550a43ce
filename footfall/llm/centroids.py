"""Centroid clustering of integer vectors by a vantage-point tree over the centroids.

Each round builds the tree of its centroids on the driver, which holds a few dozen of them, and broadcasts it. A vector
takes the open node with the least lower bound, computes the exact distance to the node's centroids, and opens the
children that may hold a centroid as near as the best so far. All vectors of a batch take their own best node at a
time, so the work is numpy's. Only sums per centroid and component are shuffled.
"""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.session import write_shared

SCALE = 256
LARGEST = 1 << 27  # of a whole component: squared distances of up to 128 of them then fit in 63 bits
LEAF = 4
ROWS = 8192  # vectors that search together
SLACK = 1e-9  # far above the rounding of square roots, relative


class Node:
    """A vantage centroid and its two halves, or a leaf's centroids."""

    def __init__(self, members, children=()):
        self.members, self.children = members, children  # children: (number of the node, least and largest distance)


class VantageTree:
    """Nearest of a list of integer vectors; ties go to the smaller number."""

    def __init__(self, centroids, leaf=LEAF):
        self.centroids = np.asarray(centroids, np.int64)
        self.nodes = []
        if len(self.centroids):
            self._build(np.arange(len(self.centroids)), leaf)

    def _build(self, members, leaf):
        number = len(self.nodes)
        self.nodes.append(None)
        if len(members) <= leaf:
            self.nodes[number] = Node(members)
            return number
        vantage, others = members[0], members[1:]
        squares = ((self.centroids[others] - self.centroids[vantage]) ** 2).sum(axis=1)
        order = np.argsort(squares, kind="stable")
        children = []
        for half in np.array_split(order, 2):
            if len(half):
                radii = np.sqrt(squares[half].astype(np.float64))
                children.append((self._build(others[half], leaf), radii.min(), radii.max()))
        self.nodes[number] = Node(members[:1], children)
        return number

    def nearest(self, vectors):
        """The number of the nearest centroid of each row and the squared distance, both exact."""
        vectors = np.asarray(vectors, np.int64)
        rows = len(vectors)
        best = np.full(rows, np.iinfo(np.int64).max)
        who = np.full(rows, -1, np.int64)
        bound = np.full((rows, len(self.nodes)), np.inf)  # of nodes that are not open: infinite
        if self.nodes:
            bound[:, 0] = 0
        going = np.arange(rows)
        while len(going):
            node = bound[going].argmin(axis=1)
            least = bound[going, node]
            # The radius of the best so far is inclusive: a centroid at the same distance may have a smaller number.
            radius = np.sqrt(best[going].astype(np.float64))
            search = least <= radius * (1 + SLACK)
            search &= np.isfinite(least)
            going, node = going[search], node[search]
            bound[going, node] = np.inf
            order = np.argsort(node, kind="stable")
            cuts = np.flatnonzero(np.diff(node[order])) + 1
            for own in np.split(order, cuts) if len(order) else ():
                self._visit(self.nodes[node[own[0]]], going[own], vectors, best, who, bound)
        return who, best

    def _visit(self, node, rows, vectors, best, who, bound):
        points = vectors[rows]
        for member in node.members.tolist():
            difference = points - self.centroids[member]
            squares = np.einsum("ij,ij->i", difference, difference)
            nearer = (squares < best[rows]) | ((squares == best[rows]) & (member < who[rows]))
            best[rows[nearer]], who[rows[nearer]] = squares[nearer], member
        if node.children:  # the only member is the vantage point, so ``squares`` is of it
            away = np.sqrt(squares.astype(np.float64))
            for child, least, largest in node.children:
                low = np.maximum(least - away * (1 + SLACK), away * (1 - SLACK) - largest * (1 + SLACK))
                bound[rows, child] = np.maximum(low, 0)


def whole_vectors(embeddings, dims=64, id="vec_id", vector="embedding"):
    """``(id, _q)``: vectors of ``dims`` components as little-endian 32-bit integers ``floor(256 * x)``, written once.

    Vectors of another length, null ones, and those with a null or non-finite component take no part; neither do those
    with a component beyond ``LARGEST`` after scaling, whose distances no long holds.
    """
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    usable = (F.size(vector) == dims) & F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * SCALE <= LARGEST),
    )
    kept = embeddings.where(F.coalesce(usable, F.lit(False)))

    def pack(batches):
        for batch in batches:
            flat = batch.column("_whole").flatten().to_numpy(zero_copy_only=False).astype("<i4")
            offsets = pa.py_buffer(np.arange(batch.num_rows + 1, dtype=np.int32) * 4 * dims)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(id), packed], names=[id, "_q"])

    columns = kept.select(F.col(id), whole.alias("_whole"))
    schema = T.StructType([embeddings.schema[id], T.StructField("_q", T.BinaryType())])
    return write_shared(columns.mapInArrow(pack, schema), "whole-vectors")


def _matrix(column, dims):
    """The rows of a binary Arrow column as integers, a slice of the column at a time."""
    for start in range(0, len(column), ROWS):
        part = column.slice(start, ROWS)
        yield start, np.frombuffer(b"".join(part.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def first_centroids(vectors, k, seed="2", id="vec_id"):
    """The vectors of the ``k`` rows with the least sha256 of ``seed:id``; repeated ids go by their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    rows = vectors.select(name.alias("_name"), "_q").orderBy("_name", "_q").limit(k).collect()  # k rows
    return [np.frombuffer(row["_q"], "<i4").astype(np.int64) for row in rows]


def _sums(vectors, tree, dims):
    """``(cluster, dim, total)`` over all vectors; dimension -1 counts them."""
    def run(batches):
        sums = np.zeros((len(tree.value.centroids), dims), np.int64)
        counts = np.zeros(len(sums), np.int64)
        for batch in batches:
            for _, own in _matrix(batch.column("_q"), dims):
                who, _ = tree.value.nearest(own)
                order = np.argsort(who, kind="stable")
                cuts = np.flatnonzero(np.diff(who[order], prepend=-1))
                sums[who[order[cuts]]] += np.add.reduceat(own[order], cuts, axis=0)
                counts += np.bincount(who, minlength=len(counts))
        met = np.flatnonzero(counts)
        table = np.column_stack((counts, sums))[met]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(met, dims + 1)), pa.array(np.tile(np.arange(-1, dims), len(met))),
                pa.array(table.ravel()),
            ],
            names=["cluster", "dim", "total"],
        )

    part = vectors.select("_q").mapInArrow(run, "cluster long, dim long, total long")
    return part.groupBy("cluster", "dim").agg(F.sum("total").alias("total"))


def refine(vectors, centroids, dims):
    """One round: every centroid with vectors becomes the floor of their mean, the others stay."""
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    rows = _sums(vectors, tree, dims).collect()  # a number for each centroid and dimension
    counts = {row.cluster: row.total for row in rows if row.dim < 0}
    moved = [np.array(one) for one in centroids]
    for row in rows:
        if row.dim >= 0:
            moved[row.cluster][row.dim] = row.total // counts[row.cluster]
    tree.unpersist()
    return moved


def _assigned(vectors, tree, dims, id):
    def run(batches):
        for batch in batches:
            found = [tree.value.nearest(own) for _, own in _matrix(batch.column("_q"), dims)]
            who = np.concatenate([np.zeros(0, np.int64), *(one for one, _ in found)])
            distance = np.concatenate([np.zeros(0, np.int64), *(one for _, one in found)])
            columns = [batch.column(id), pa.array(who.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=[id, "cluster", "distance"])

    schema = T.StructType([
        vectors.schema[id], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
    ])
    return vectors.mapInArrow(run, schema)


def cluster(embeddings, k=40, rounds=5, dims=64, seed="2", id="vec_id", vector="embedding"):
    """``k`` clusters of the vectors of ``embeddings`` after ``rounds`` rounds.

    Returns the rows (id, cluster, distance) and the centroids, a list of integer arrays. All arithmetic is exact; of
    centroids at the same distance the smaller number takes the vector. Repeated and null ids are vectors like others.
    With fewer than ``k`` vectors there are as many centroids; an empty table gives no rows. Other columns are not read.
    """
    vectors = whole_vectors(embeddings, dims, id, vector)
    centroids = first_centroids(vectors, k, seed, id)
    centroids = reduce(lambda own, _: refine(vectors, own, dims), range(rounds if centroids else 0), centroids)
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    return write_shared(_assigned(vectors, tree, dims, id), "clusters"), centroids


def digests(embeddings, k=40, rounds=5, dims=64, seed="2"):
    """A row for each clustered vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    An inertia that no long holds is null.
    """
    rows, centroids = cluster(embeddings, k, rounds, dims, seed)
    exact = F.sum(F.col("distance").cast("decimal(20,0)"))
    inertias = {row["cluster"]: int(row["own"]) for row in rows.groupBy("cluster").agg(exact.alias("own")).collect()}  # <= k rows
    fits = lambda total: total if total < 1 << 63 else None
    total = fits(sum(inertias.values()))
    names = [hashlib.sha256(",".join(map(str, one.tolist())).encode()).hexdigest() for one in centroids]
    table = [(number, fits(own), total, names[number]) for number, own in inertias.items()]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    clusters = embeddings.sparkSession.createDataFrame(table, schema)  # <= k rows
    return rows.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle_sql(k=40, rounds=5, dims=64, seed="2"):
    """The same in SQL: squared distances from inner products, which doubles hold exactly at these sizes."""
    nearest = """
    select place, centroid, distance from (
      select place, centroid, list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c) distance
      from kept cross join {table})
    qualify row_number() over (partition by place order by distance, centroid) = 1
"""
    steps, last = [f"""
with kept as materialized (
  select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 place, vec_id,
    list_transform(embedding, lambda x: floor(x::double * {SCALE})) q
  from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dims}
), c0 as materialized (select place centroid, q c from kept where place < {k})
"""], "c0"
    for number in range(1, rounds + 1):
        steps.append(f"""
, a{number} as materialized ({nearest.format(table=last)})
, m{number} as (
  select centroid, dim, floor(sum(q[dim]) / count(*)) part
  from a{number} join kept using (place), range(1, {dims + 1}) dims(dim) group by centroid, dim
), c{number} as materialized (
  select {last}.centroid, coalesce(moved.c, {last}.c) c
  from {last} left join (select centroid, list(part order by dim) c from m{number} group by centroid) moved using (centroid)
)""")
        last = f"c{number}"
    steps.append(f"""
, final as materialized ({nearest.format(table=last)})
select vec_id, centroid::int as cluster, distance::bigint distance,
  sum(distance) over (partition by centroid)::bigint cluster_inertia, sum(distance) over ()::bigint inertia,
  sha256(list_aggregate(list_transform(c, lambda x: x::bigint::varchar), 'string_agg', ',')) centroid_sha256
from final join kept using (place) join {last} using (centroid)
""")
    return "".join(steps)
