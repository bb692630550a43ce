"""A training corpus out of raw documents.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. The first four return the
columns of ``documents``; the last returns a row for each piece of a packed document.
"""

from footfall.bindings import table
from footfall.llm import minhash, packing, quality, secret_scan, toxicity
from footfall.llm.queries import BYTE_BPE, ship
from footfall.session import write_shared


def good_quality(spark, docs, sf_dir):
    """Documents that pass the quality rules."""
    ship(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark, docs, sf_dir):
    """Documents that are not predicted toxic."""
    ship(spark)
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark, docs, sf_dir):
    """One document of each class of near-duplicates."""
    ship(spark)
    return minhash.keep(docs)


def without_secrets(spark, docs, sf_dir):
    """All documents, with the secrets in their texts masked and ``n_chars`` as it then is."""
    ship(spark)
    return secret_scan.redact(docs)


def packed(spark, docs, sf_dir):
    """Pieces of all documents in sequences of at most 2048 ids."""
    ship(spark)
    return packing.digests(docs, BYTE_BPE)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_copies", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Training, hashing and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``; each result but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
