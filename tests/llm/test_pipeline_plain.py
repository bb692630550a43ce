"""The whole pipeline against plain Python and SQL: what each stage decides, on what the plain stage before it kept."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F
from test_minhash import _classes
from test_models import Letters, _markov

import corpus_pipeline
from footfall.llm import quality, toxicity

SF = "/root/testdata/sf0.001"


def _good(rows):
    """By the quality rules in SQL."""
    connection = duckdb.connect()
    for table in ("documents", "labels"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    found = connection.execute(f"select doc_id, kept from ({quality.oracle_sql()})").fetchall()
    kept = {doc_id for doc_id, good in found if good}
    return [row for row in rows if row.doc_id in kept]


def _words(text):
    return [word for word in re.split(r"[\W_]+", (text or "").lower()) if word]


def _features(models, texts):
    rows, known = [], {}
    for words in texts:
        gains = [known[word] if word in known else known.setdefault(word, models.gain(word)) for word in words]
        sums = np.append(0, np.cumsum(gains))
        best = [max(((sums[min(i + w, len(gains))] - sums[i]) / w for i in range(len(gains))), default=0) for w in toxicity.WINDOWS]
        rows.append([np.mean(gains) if gains else 0, *best, math.log1p(len(words))])
    return np.array(rows)


def _models(texts, toxic):
    counts = {}
    for words, label in zip(texts, toxic):
        for word in set(words):
            counts.setdefault(word, [0, 0])[0 if label else 1] += 1
    return Letters(counts)


def _curve(x, y):
    """A logistic curve with a ridge of 1 on standardised features, found by gradient steps."""
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    ridge = np.append(np.ones(x.shape[1]), 1e-6)
    weights = np.zeros(z.shape[1])
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(z @ weights)))
        weights -= (z.T @ (p - y) + ridge * weights) / (len(x) * 0.25 * z.shape[1] + 1)
    return lambda new: np.column_stack([(new - mean) / spread, np.ones(len(new))]) @ weights


def _not_toxic(spark, rows):
    labels = {row.doc_id: row.toxic for row in spark.read.parquet(f"{SF}/labels.parquet").collect() if row.toxic is not None}
    known = [row for row in rows if row.doc_id in labels and zlib.crc32(str(row.doc_id).encode()) % 5]
    ids = spark.createDataFrame([(row.doc_id,) for row in known], "doc_id long")
    hashed = ids.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(toxicity.FOLDS)).alias("fold")).collect()
    fold_of = {row.doc_id: row.fold for row in hashed}
    texts, toxic = [_words(row.text) for row in known], np.array([labels[row.doc_id] for row in known])
    folds = np.array([fold_of[row.doc_id] for row in known])
    x = np.zeros((len(known), len(toxicity.WINDOWS) + 2))
    for fold in range(toxicity.FOLDS):
        models = _models([t for t, f in zip(texts, folds) if f != fold], toxic[folds != fold])
        x[folds == fold] = _features(models, [t for t, f in zip(texts, folds) if f == fold])
    curve = _curve(x, toxic)
    return [row for row, at in zip(rows, curve(_features(_models(texts, toxic), [_words(row.text) for row in rows]))) if at < 0]


def _first_copies(rows):
    classes = _classes([(row.doc_id, row.text) for row in rows])
    kept = {doc_id for doc_id, class_id in classes if doc_id == class_id}
    return [row for row in rows if row.doc_id in kept]


def _masked(text, spans):
    """Each run of overlapping spans as one mask."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda span: span[1:]):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_every_stage_and_the_run(spark, docs, library):
    rows = _good(docs.collect())
    good = {row.doc_id for row in rows}
    rows = _not_toxic(spark, rows)
    clean = {row.doc_id for row in rows}
    rows = _first_copies(rows)
    texts = [row.text or "" for row in rows]
    texts = [_masked(text, spans) for text, spans in zip(texts, _markov(texts))]
    expected = Counter()
    for row, text in zip(rows, texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            piece = np.array(ids[start:start + 2048], "<u4")
            expected[(row.doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert len(good) > len(clean) > len(rows) > 50
    found = corpus_pipeline.run(spark, SF).collect()
    assert Counter((row.doc_id, row.start, row.length, row.ids_crc32, row.doc_tokens) for row in found) == expected
    places = {}
    for row in found:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in places.values():
        ends = [offset + length for offset, length in sorted(parts)]
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
