"""Token ids of whole texts as Arrow batches, for the operators that write or pack ids."""

import json

import numpy as np

from footfall.llm.common import slices, texts_of
from footfall.llm.pretokens import encoder


def id_type(path, *more):
    """The narrowest unsigned type for the ids of a tokenizer file and the further ids given."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    ids = vocab.values() if isinstance(vocab, dict) else range(len(vocab))
    most = max([*ids, *(token["id"] for token in spec["added_tokens"]), *more])
    return "<u2" if most < 1 << 16 else "<u4"


def encoded(batches, path, end_id):
    """For each part of the batches: the part, all its ids with ``end_id`` after each text, and their counts.

    A null text counts as empty and has the end id alone.
    """
    own = encoder(path)
    for batch in batches:
        for part in slices(batch):
            ids, counts = own.encode(texts_of(part))
            yield part, np.insert(ids, np.cumsum(counts), end_id), counts + 1
