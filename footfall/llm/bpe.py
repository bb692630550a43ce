"""Byte-level BPE by a pair occurrence index.

All new words of a slice of a partition are laid out in one array of symbols. Each adjacent pair that a merge rule
knows is mapped to all its positions. The active ranks are taken in ascending order from a heap; a rank's positions
are merged together and only the lists of the pairs beside them are updated. A rule's pair holds the symbol of an
earlier rule or a byte, so ranks made by a merge are higher than the merge's own.
"""

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm.common import slices, texts_of
from footfall.llm.pretokens import PieceEncoder, byte_letters, is_byte_level

NO_RULE = np.iinfo(np.int64).max


class PairIndex:
    """The merge rules of a vocabulary, applied to many words at once."""

    def __init__(self, vocab, merges):
        self.vocab = vocab
        self.size = max(vocab.values()) + 1
        pairs = [(vocab[left], vocab[right], vocab[left + right]) for left, right in merges]
        left, right, made = np.array(pairs, np.int64).reshape(-1, 3).T
        keys = left * self.size + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.left, self.right, self.made = left, right, made

    def ranks(self, left, right):
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(len(keys), NO_RULE)
        return np.where(self.keys[at] == keys, self.order[at], NO_RULE)

    def encode(self, words):
        """Ids of all words, and how many each has. A word is a text of byte letters, all in the vocabulary."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lengths = np.array([len(word) for word in words], np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        table = np.full(int(letters.max(initial=0)) + 1, -1, np.int64)
        for letter in np.unique(letters):
            table[letter] = self.vocab[chr(letter)]
        # One empty symbol (-1) before each word and one at the end keep pairs inside their words.
        word_of = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(letters)) + word_of + 1
        symbols = np.full(len(letters) + len(words) + 1, -1, np.int64)
        symbols[place] = table[letters]
        following = np.arange(1, len(symbols) + 1)
        before = np.arange(-1, len(symbols) - 1)
        index, heap = {}, []

        def note(positions):
            """Enter the pairs that start at these positions."""
            left, right = symbols[positions], symbols[following[positions]]
            inside = (left >= 0) & (right >= 0)
            positions = positions[inside]
            rank = self.ranks(left[inside], right[inside])
            known = rank != NO_RULE
            rank, positions = rank[known], positions[known]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            rank, positions = rank[order], positions[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            firsts = rank[np.append(0, cuts)].tolist()
            for one, part in zip(firsts, np.split(positions, cuts) if len(cuts) else [positions]):
                if one in index:
                    index[one].append(part)
                else:
                    index[one] = [part]
                    heapq.heappush(heap, one)

        note(place)
        while heap:
            rank = heapq.heappop(heap)
            parts = index.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            left, right = self.left[rank], self.right[rank]
            at = at[(symbols[at] == left) & (symbols[following[at]] == right)]
            if not len(at):
                continue
            if left == right and len(at) > 1:
                at = self._apart(np.sort(at), following)
            gone = following[at]
            after = following[gone]
            symbols[at] = self.made[rank]
            symbols[gone] = -2
            following[at] = after
            before[after] = at
            note(np.unique(np.concatenate((before[at], at))))
        alive = symbols[place] >= 0
        counts = np.bincount(word_of[alive], minlength=len(words))
        return symbols[place[alive]].astype(np.uint32), counts

    @staticmethod
    def _apart(at, following):
        """Of overlapping positions of a pair of equal symbols, every other one from the left."""
        out, taken = [], -1
        for position in at.tolist():
            if position != taken:
                out.append(position)
                taken = following[position]
        return np.array(out, np.int64)


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path):
        if not is_byte_level(path):
            raise ValueError(f"{path} is not plain byte-level BPE")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = [tuple(rule) if isinstance(rule, list) else tuple(rule.split(" ")) for rule in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        self.index = PairIndex(vocab, merges)
        self.pieces = PieceEncoder(path, self.index.encode)
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        entries = {id: bytes(byte_of[letter] for letter in token) for token, id in vocab.items()}
        entries |= {token["id"]: token["content"].encode() for token in spec["added_tokens"]}
        self.bytes = [entries.get(id, b"") for id in range(max(entries) + 1)]
        self.decimal = [str(id) for id in range(len(self.bytes))]

    def encode(self, texts):
        return self.pieces.encode(texts)

    def decode(self, ids):
        """The text of a list of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_codecs = {}


def codec(path):
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs, path, text="text", ids="ids"):
    """``docs`` with the ids of each whole text as an array column.

    A null or empty text has no ids. Other columns stay; a column named ``ids`` is replaced.
    """
    @F.pandas_udf("array<int>")
    def run(texts):
        found, counts = codec(path).encode(texts.fillna("").tolist())
        return type(texts)(np.split(found.astype(np.int32), np.cumsum(counts)[:-1]), index=texts.index)

    return docs.withColumn(ids, run(F.col(text)))


def decode(docs, path, ids="ids", text="text"):
    """``docs`` with the text of each array of ids. A null array gives null, an empty one an empty text."""
    @F.pandas_udf("string")
    def run(values):
        return values.map(lambda own: None if own is None else codec(path).decode(own))

    return docs.withColumn(text, run(F.col(ids)))


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs, path):
    """A row for each row of (doc_id, text): the number of ids, and digests of the ids and of the text decoded.

    A null text counts as empty; null and repeated ids are rows like others. Long texts are encoded whole.
    """
    def run(batches):
        own = codec(path)
        sha = hashlib.sha256
        for batch in batches:
            for part in slices(batch):
                ids, counts = own.encode(texts_of(part))
                listed, at = ids.tolist(), 0
                id_digests, text_digests = [], []
                for count in counts.tolist():
                    values = listed[at:at + count]
                    at += count
                    id_digests.append(sha(",".join(map(own.decimal.__getitem__, values)).encode()).hexdigest())
                    text_digests.append(sha(own.decode(values).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DIGESTS)
