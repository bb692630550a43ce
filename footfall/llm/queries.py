"""The registered queries of this subpackage."""

import os
import sys
import tempfile
import zipfile
from pathlib import Path

import public_tokenizers

from footfall.bindings import table
from footfall.llm import (
    bpe, centroids, collocations, minhash, neighbours, packing, quality, secret_scan, sentence_pieces, shards, token_files,
    toxicity, urls,
)

# Rows that a Python worker gets at once. Rows here hold whole texts, and each worker and its executor hold a batch or two.
BATCH_ROWS = 4000
ROOT = Path(__file__).resolve().parents[2]
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
_shipped = set()


def ship(spark):
    """Let Python workers import this package, as ``--py-files`` does, unless they find it already, and get small batches."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    context = spark.sparkContext
    found = {Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    if ROOT in found or context.applicationId in _shipped:
        return
    archive = f"{tempfile.mkdtemp(prefix='footfall-')}/footfall-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in (ROOT / "footfall").rglob("*.py"):
            out.write(file, file.relative_to(ROOT))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def _documents(spark, sf_dir):
    ship(spark)
    return table(spark, sf_dir, "documents")


def _labels(spark, sf_dir):
    return table(spark, sf_dir, "labels")


def _op1(spark, sf_dir):
    ship(spark)
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda id: id % 20 == 0)


def _op2(spark, sf_dir):
    return toxicity.predictions(_documents(spark, sf_dir), _labels(spark, sf_dir))


def _op3(spark, sf_dir):
    return quality.verdicts(_documents(spark, sf_dir), _labels(spark, sf_dir))


def _op4(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), _labels(spark, sf_dir))


def _op5(spark, sf_dir):
    return minhash.dedup_classes(_documents(spark, sf_dir))


def _op6(spark, sf_dir):
    return shards.assign(_documents(spark, sf_dir))


def _op7(spark, sf_dir):
    return token_files.digests(_documents(spark, sf_dir), BYTE_BPE)


def _op8(spark, sf_dir):
    return secret_scan.digests(_documents(spark, sf_dir))


def _op9(spark, sf_dir):
    return bpe.digests(_documents(spark, sf_dir), BYTE_BPE)


def _op10(spark, sf_dir):
    return packing.digests(_documents(spark, sf_dir), BYTE_BPE)


def _op11(spark, sf_dir):
    ship(spark)
    return centroids.digests(table(spark, sf_dir, "embeddings"))


def _op12(spark, sf_dir):
    return collocations.collocations(_documents(spark, sf_dir))


def _op13(spark, sf_dir):
    return sentence_pieces.digests(_documents(spark, sf_dir), PIECE_BPE)


def queries():
    return {
        "op1_hilbert_neighbours": _op1,
        "op2_kneser_ney_toxicity": _op2,
        "op3_risk_controlled_quality": _op3,
        "op4_association_url_filter": _op4,
        "op5_probminhash_dedup": _op5,
        "op6_jump_hash_shards": _op6,
        "op7_token_files": _op7,
        "op8_markov_secrets": _op8,
        "op9_pair_index_bpe": _op9,
        "op10_shortest_pack_first": _op10,
        "op11_vantage_point_centroids": _op11,
        "op12_tiled_collocations": _op12,
        "op13_merge_round_pieces": _op13,
    }


def oracle_sql():
    """SQL for the queries that it can express; the others are held against brute force in tests."""
    return {
        "op3_risk_controlled_quality": quality.oracle_sql(),
        "op6_jump_hash_shards": shards.oracle_sql(),
        "op11_vantage_point_centroids": centroids.oracle_sql(),
        "op12_tiled_collocations": collocations.oracle_sql(),
    }
