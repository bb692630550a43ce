"""Shards and nearest neighbours."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import neighbours, shards


def _jump(key, n):
    bucket = 0
    while True:
        drawn = int(hashlib.md5(f"{key}:{bucket}".encode()).hexdigest()[:13], 16)
        target = int(min((bucket + 1) * 2.0 ** 52 / (drawn + 1), 4e18))
        if target >= n:
            return bucket
        bucket = target


@pytest.mark.parametrize("which", ["docs", "odd_docs", "no_docs"])
def test_shards(which, request):
    docs = request.getfixturevalue(which)
    rows = shards.assign(docs).collect()
    texts = sorted(((row.doc_id is not None, row.doc_id or 0), row.text or "") for row in docs.collect())
    assert len(rows) == len(texts)
    slots = {}
    for row in rows:
        key = "" if row.doc_id is None else str(row.doc_id)
        assert row.shard == _jump(key, 40) and row.grown_shard == _jump(key, 41)
        assert row.grown_shard in (row.shard, 40) and row.law == "key"
        slots.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    expected = sorted((len(t.encode()) + 16, zlib.crc32(t.encode())) for _, t in texts)
    assert sorted((row.size, row.text_crc32) for row in rows) == expected


def test_shards_are_even_and_move_little(spark):
    keys = spark.range(40_000).select(*[shards.jump(F.col("id").cast("string"), n).alias(f"s{n}") for n in (1, 9, 10)]).toPandas()
    assert set(keys["s1"]) == {0}
    assert keys["s10"].value_counts().between(3700, 4300).all()
    moved = keys[keys["s9"] != keys["s10"]]
    assert set(moved["s10"]) == {9} and 3700 < len(moved) < 4300


def test_shards_written(docs, spark, tmp_path):
    shards.write(docs, str(tmp_path / "out"), 5)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


@settings(max_examples=20, deadline=None)
@given(st.integers(2, 3), st.integers(1, 4))
def test_hilbert_is_a_path(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    place = neighbours.hilbert(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def _brute(rows, asked, k):
    out = {}
    for q, v in rows:
        if asked(q):
            scored = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def _check(found, expected):
    got = {}
    for row in sorted(found, key=lambda row: (row.query_id, row.rank)):
        got.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    hits = total = 0
    for q, near in expected.items():
        assert [rank for rank, _, _ in got[q]] == list(range(1, len(near) + 1))
        order = [(-score, i) for _, i, score in got[q]]
        assert all(a[0] <= b[0] + 1e-12 for a, b in zip(order, order[1:]))
        hits += len({i for _, i, _ in got[q]} & {i for i, _ in near})
        total += len(near)
    assert got.keys() == expected.keys()
    return hits / total


def test_neighbours_of_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in vectors.collect()]
    found = neighbours.search(vectors, lambda id: id % 20 == 0).collect()
    assert _check(found, _brute(rows, lambda i: i % 20 == 0, 20)) == 1.0


def test_recall_over_many_blocks(spark, monkeypatch):
    """Clustered vectors of different lengths, in blocks far smaller than the table."""
    monkeypatch.setattr(neighbours, "BLOCK", 128)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    data = centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 16))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data * rng.uniform(0.8, 1.2, (4000, 1)))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = _brute(rows[:], lambda i: i % 200 == 0, 20)
    assert _check(neighbours.search(vectors, lambda id: id % 200 == 0).collect(), expected) >= 0.9


def test_neighbours_odd_rows(spark):
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(60)] + [(100, None), (120, [0.0, 0.0]), (140, [1.0, None]), (160, [float("nan"), 1.0]),
            (180, [float("inf"), 1.0]), (200, [1.0]), (None, same), (220, [3.0, 6.0]), (220, [3.0, 6.0]), (240, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    usable = [(i, v) for i, v in dict(rows[:60] + [(220, [3.0, 6.0]), (240, [-1.0, 0.0])]).items()]
    found = neighbours.search(vectors, lambda id: id % 20 == 0).collect()
    expected = _brute(usable, lambda i: i % 20 == 0, 20)
    assert _check(found, expected) == 1.0
    assert [row.vec_id for row in sorted(found, key=lambda r: r.rank) if row.query_id == 40] == [i for i, _ in expected[40]]
    assert neighbours.search(vectors.limit(0), lambda id: id % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(row) for row in neighbours.search(few, lambda id: id % 20 == 0).collect()] == [(0, 1, 1, 2.0)]


def test_recall_when_windows_are_a_small_part(spark, monkeypatch):
    """Nearly random vectors of 64 components, of which three blocks on every curve are 4 in 10 rows at most."""
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "TILE", 30, raising=False)
    data = np.random.default_rng(2).normal(size=(8000, 64)) / 8
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = _brute(rows[:], lambda i: i % 100 == 0, 20)
    assert _check(neighbours.search(vectors, lambda id: id % 100 == 0).collect(), expected) >= 0.9
