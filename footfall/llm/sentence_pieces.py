"""SentencePiece BPE by vectorised merge rounds.

New words lie in one flat array of symbols, cut into segments where no piece of the vocabulary has the two characters
side by side: no merge can ever cross such a cut. In each round every segment finds the least rank of its pairs and
merges that pair's places from the left, all segments at once. Segments without a pair leave the array.

A round merges several places of a segment only as far as one place at a time would: a place whose merge makes a pair
of the same or a lesser rank is the last one of its round, since that pair comes before the places to its right.
"""

import codecs
import hashlib
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm.common import gather, slices, texts_of

SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "  # what an unknown id decodes to
CODE_POINTS = 0x110000
NO_RANK = np.iinfo(np.int32).max
BLOCK = 1 << 19  # symbols that are merged together
CACHE_BYTES = 96_000_000  # of words, their ids and what Python needs around them
WORD_BYTES = 150

_RUNS = re.compile(" *[^ ]+| +")
# Each byte of an invalid sequence is replaced on its own.
codecs.register_error("each_byte", lambda error: ("�" * (error.end - error.start), error.end))


def read_model(path):
    """The parsed model file. Other kinds of models than plain BPE with byte fallback are refused."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = type(model.pieces[0])
    plain = (
        model.trainer_spec.model_type == model.trainer_spec.BPE
        and model.trainer_spec.byte_fallback
        and not model.trainer_spec.treat_whitespace_as_suffix
        and not model.normalizer_spec.precompiled_charsmap
        and model.normalizer_spec.add_dummy_prefix
        and model.normalizer_spec.escape_whitespaces
        and not model.normalizer_spec.remove_extra_whitespaces
        and not model.denormalizer_spec.precompiled_charsmap
        and all(p.type in (kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE) for p in model.pieces)
        and not any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces if p.type == kinds.NORMAL)
    )
    if not plain:
        raise ValueError(f"{path} is not plain BPE with byte fallback")
    return model


class MergeRounds:
    """The merges of a vocabulary, applied to many words at once.

    A symbol is the id of a piece, or the size of the vocabulary plus a code point for a character that is no piece.
    """

    def __init__(self, pieces):
        """``pieces``: {text: (id, score)} of the pieces that merges can make."""
        self.size = max(id for id, _ in pieces.values()) + 1
        self.symbol = np.arange(CODE_POINTS, dtype=np.int32) + self.size
        for text, (id, _) in pieces.items():
            if len(text) == 1:
                self.symbol[ord(text)] = id
        # Equal scores are one rank: the place decides between them.
        ranks = {score: rank for rank, score in enumerate(sorted({score for _, score in pieces.values()}, reverse=True))}
        rules, beside = [], set()
        for text, (id, score) in pieces.items():
            beside.update(zip(text, text[1:]))
            for cut in range(1, len(text)):
                left, right = self._known(text[:cut], pieces), self._known(text[cut:], pieces)
                if left is not None and right is not None:
                    rules.append((left, right, ranks[score], id))
        table = np.array(sorted(rules), np.int64).reshape(-1, 4)
        self.keys = table[:, 0] * (self.size + CODE_POINTS) + table[:, 1]
        self.rank = np.append(table[:, 2], NO_RANK).astype(np.int32)
        self.made = np.append(table[:, 3], -1).astype(np.int32)
        self.beside = np.array(sorted(ord(a) * CODE_POINTS + ord(b) for a, b in beside), np.int64)

    def _known(self, text, pieces):
        if len(text) == 1:
            return int(self.symbol[ord(text)])
        return pieces[text][0] if text in pieces else None

    def _rule(self, left, right):
        """The number of the rule of each pair; the last number is that of no rule."""
        keys = left.astype(np.int64) * (self.size + CODE_POINTS) + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        return np.where(self.keys[at] == keys, at, len(self.keys))

    def _cuts(self, points):
        """Whether a character can never be in one piece with the character before it."""
        if not len(self.beside):
            return np.ones(len(points), bool)
        keys = points[:-1].astype(np.int64) * CODE_POINTS + points[1:]
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        return np.append(True, self.beside[at] != keys)

    def symbols(self, words):
        """The final symbols of all words one after another, and how many each word has."""
        lengths = np.array([len(word) for word in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(0, np.int32), lengths
        starts = self._cuts(points)
        starts[np.cumsum(lengths)[:-1][lengths[1:] > 0]] = True  # a word begins there
        out = self.symbol[points]
        starts = np.flatnonzero(starts)
        # Segments of one character are done. The others go in blocks.
        sizes = np.diff(np.append(starts, len(points)))
        starts, sizes = starts[sizes > 1], sizes[sizes > 1]
        block = (np.cumsum(sizes) - sizes) // BLOCK
        for number in np.unique(block):
            own = block == number
            self._merge(out, starts[own], sizes[own])
        alive = out >= 0
        counts = np.add.reduceat(np.append(alive, False).astype(np.int64), np.append(0, np.cumsum(lengths))[:-1])
        return out[alive], np.where(lengths > 0, counts, 0)

    def _merge(self, out, starts, sizes):
        """Merge the segments that begin at ``starts`` within ``out``; a symbol merged into the one before becomes -1."""
        segment = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
        place = gather(np.arange(len(out)), starts, sizes)
        symbol = out[place]
        while len(symbol):
            inside = np.append(segment[1:] == segment[:-1], False)
            rule = np.full(len(symbol), len(self.keys))
            rule[inside] = self._rule(symbol[:-1][inside[:-1]], symbol[1:][inside[:-1]])
            rank = self.rank[rule]
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            least = np.minimum.reduceat(rank, first)
            going = least != NO_RANK
            width = np.diff(np.append(first, len(symbol)))
            if not going.all():
                kept = np.repeat(going, width)
                segment, place, symbol, rule, rank = (x[kept] for x in (segment, place, symbol, rule, rank))
                if not len(symbol):
                    return
                width, least = width[going], least[going]
            chosen = self._leftmost(rank == np.repeat(least, width))
            at = np.flatnonzero(chosen)
            made = self.made[rule[at]]
            at, made = self._until_first_new(at, made, symbol, segment, rank)
            symbol[at] = made
            out[place[at]] = made
            out[place[at + 1]] = -1
            rest = np.ones(len(symbol), bool)
            rest[at + 1] = False
            segment, place, symbol = segment[rest], place[rest], symbol[rest]

    @staticmethod
    def _leftmost(found):
        """Of places whose pairs overlap in a row, every other one from the left."""
        index = np.arange(len(found))
        begin = found & ~np.append(False, found[:-1])
        since = index - np.maximum.accumulate(np.where(begin, index, 0))
        return found & (since % 2 == 0)

    def _until_first_new(self, at, made, symbol, segment, rank):
        """The places of each segment up to the first whose merge makes a pair of the same or a lesser rank."""
        own = segment[at]
        before = np.maximum(at - 1, 0)
        left = symbol[before].copy()
        joined = np.append(False, (at[1:] - at[:-1] == 2) & (own[1:] == own[:-1]))  # the left neighbour is merged too
        left[joined] = made[:-1][joined[1:]]
        after = np.minimum(at + 2, len(symbol) - 1)
        new = (at > 0) & (segment[before] == own)
        new[new] = self.rank[self._rule(left[new], made[new])] <= rank[at[new]]
        other = (at + 2 < len(symbol)) & (segment[after] == own)
        other[other] = self.rank[self._rule(made[other], symbol[after[other]])] <= rank[at[other]]
        new |= other
        if not new.any():
            return at, made
        earlier = np.cumsum(new) - new
        begins = np.append(True, own[1:] != own[:-1])
        base = np.maximum.accumulate(np.where(begins, earlier, 0))
        kept = earlier == base
        return at[kept], made[kept]


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path):
        model = read_model(path)
        kinds = type(model.pieces[0])
        self.rounds = MergeRounds({p.piece: (id, p.score) for id, p in enumerate(model.pieces) if p.type == kinds.NORMAL})
        of_byte = {int(p.piece[1:-1], 16): id for id, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_ids = np.array([of_byte[byte] for byte in range(256)], np.uint32)
        self.texts, self.opens, self.control = [], [], []
        for p in model.pieces:
            if p.type == kinds.BYTE:
                text = bytes([int(p.piece[1:-1], 16)])
            elif p.type == kinds.CONTROL:
                text = b""
            else:
                text = (UNKNOWN_TEXT if p.type == kinds.UNKNOWN else p.piece.replace(SPACE, " ")).encode()
            self.texts.append(text)
            self.opens.append(p.type == kinds.NORMAL and p.piece.startswith(SPACE))
            self.control.append(p.type == kinds.CONTROL)
        self.decimal = [str(id) for id in range(len(self.texts))]
        self._clear()

    def _clear(self):
        self.words, self.bytes = {}, 0
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_words(self, words):
        """Ids of the words one after another, and how many each has. A space is written as the space symbol."""
        symbols, counts = self.rounds.symbols(words)
        size = self.rounds.size
        odd = np.flatnonzero(symbols >= size)
        if not len(odd):
            return symbols.astype(np.uint32), counts
        # A character that is no piece becomes the ids of its bytes.
        points, which = np.unique(symbols[odd] - size, return_inverse=True)
        encoded = [chr(point).encode() for point in points.tolist()]
        widths = np.array([len(one) for one in encoded], np.int64)
        data = self.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)]
        width = np.ones(len(symbols), np.int64)
        width[odd] = widths[which]
        ends = np.cumsum(width)
        ids = np.repeat(symbols, width).astype(np.uint32)
        own = (ends - width)[odd]
        spread = np.repeat(own - (np.cumsum(width[odd]) - width[odd]), width[odd]) + np.arange(int(width[odd].sum()))
        ids[spread] = gather(data, (np.cumsum(widths) - widths)[which], width[odd])
        before = np.append(0, ends)
        bounds = before[np.append(0, np.cumsum(counts))]
        return ids, np.diff(bounds)

    @staticmethod
    def _keys(text):
        """Words of a text without the one space before each: no merge crosses from another character to a space."""
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        words = text.split(" ")
        if "" in words:  # a run of spaces stays together
            words = [word[1:] for word in _RUNS.findall(" " + text)]
        return words

    def _learn(self, keys):
        new = list(dict.fromkeys(keys))
        ids, counts = self.encode_words([SPACE + key.replace(" ", SPACE) for key in new])
        first = len(self.starts)
        self.words.update(zip(new, range(first, first + len(new))))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(counts) - counts))
        self.lengths = np.concatenate((self.lengths, counts))
        self.flat = np.concatenate((self.flat, ids))
        self.bytes += WORD_BYTES * len(new) + 4 * sum(map(len, new)) + 4 * len(ids)

    def encode(self, texts):
        """Ids of all texts one after another, and the number of ids of each text."""
        if self.bytes > CACHE_BYTES:
            self._clear()
        keys = [self._keys(text) for text in texts]
        sizes = np.array([len(own) for own in keys], np.int64)
        flat_keys = list(chain.from_iterable(keys))
        found = np.fromiter(map(self.words.get, flat_keys, repeat(-1)), np.int64, len(flat_keys))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [flat_keys[i] for i in missing.tolist()]
            self._learn(new)
            found[missing] = np.fromiter(map(self.words.__getitem__, new), np.int64, len(new))
        lengths = self.lengths[found]
        ids = gather(self.flat, self.starts[found], lengths)
        return ids, np.diff(np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(sizes))])

    def decode(self, ids):
        """The text of a list of ids, without the space that encoding puts before a text."""
        runs, begin = [], 0  # bytes do not join across a control id
        for i in [i for i, id in enumerate(ids) if self.control[id]]:
            runs.append(ids[begin:i])
            begin = i + 1
        runs.append(ids[begin:])
        text = "".join([b"".join(map(self.texts.__getitem__, run)).decode("utf-8", "each_byte") for run in runs])
        first = next((run[0] for run in runs if len(run)), None)
        return text[1:] if first is not None and self.opens[first] else text


_codecs = {}


def codec(path):
    """The codec of a model file; one per Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs, path, text="text", ids="ids"):
    """``docs`` with the ids of each whole text as an array column, without begin and end ids.

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

    A null text counts as empty and has no ids; null and repeated ids of documents are rows like others; an empty table
    gives no rows. Long texts are encoded whole. Other columns of ``docs`` are not read.
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
                columns = [part.column("doc_id"), pa.array(counts), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DIGESTS)
