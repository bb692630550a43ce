"""Fast byte-level encoding of whole texts: each different piece of text between spaces is encoded once per worker.

A byte-level pre-tokenizer always cuts before a single space between two characters that are no white space, so the
pieces between such spaces can be encoded on their own and their ids put one after another.
"""

import gc
import json
import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from footfall.llm.common import gather

# The public pre-tokenization pattern of byte-level BPE, and the bytes that stand for themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

CACHE_BYTES = 72_000_000  # of pieces, their ids and what Python needs around them
PIECE_BYTES = 160
OFTEN = 3
ODD, NEW = -1, -2

_WORDS = regex.compile(PATTERN)
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Characters whose classes the pattern's two implementations agree on; others go through the tokenizer's own.
_PLAIN = re.compile("[\n\x20-\x7e\xa1-\xac\xae-ɏ]*")

def byte_letters():
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next above 255."""
    others = iter(range(256, 512))
    return {byte: chr(byte if byte in PRINTABLE else next(others)) for byte in range(256)}


_LETTERS = byte_letters()
_ZERO, _BLANK = _LETTERS[0], _LETTERS[0x20]
GROUP = 64  # words that the library's model gets at once
_IS_LETTER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
_MARKS = b".,;:!?"
_MARK_NUMBER = np.full(256, len(_MARKS))
_MARK_NUMBER[np.frombuffer(_MARKS, np.uint8)] = np.arange(len(_MARKS))


def as_letters(words):
    """Words in byte letters. None may hold the character 0."""
    return "\0".join(words).encode().decode("latin-1").translate(_LETTERS).split(_ZERO) if words else []


def word_encoder(model, vocab):
    """Encodes lists of words by a model of the tokenizers library: all ids, and how many each word has.

    The letter of byte 0 is in no longer token of the usual vocabularies. Then it keeps words apart within one call.
    """
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker is one of many on its machine
    bare = Tokenizer(model)  # without a pre-tokenizer

    def one_by_one(words):
        found = [[token.id for token in model.tokenize(word)] for word in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    def together(words):
        groups = [_ZERO.join(words[at:at + GROUP]) + _ZERO for at in range(0, len(words), GROUP)]
        found = [item.ids for item in bare.encode_batch_fast(groups, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        ends = np.flatnonzero(ids == vocab[_ZERO])
        return ids[ids != vocab[_ZERO]], np.diff(ends, prepend=-1) - 1

    if any(_ZERO in token and token != _ZERO for token in vocab) or _ZERO not in vocab:
        return one_by_one
    return lambda words: one_by_one(words) if any(_ZERO in word for word in words) else together(words)


def is_byte_level(path):
    """Whether the file is plain byte-level BPE, which pieces can be encoded of on their own."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    return (
        spec["model"]["type"] == "BPE"
        and not spec.get("normalizer")
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        and not any(c.isspace() for t in spec["added_tokens"] for c in t["content"])
    )


def split_at_spaces(texts):
    """The pieces between the spaces of all texts, as a dictionary-encoded Arrow array, and how many each text has."""
    encoded = [text.encode() for text in texts]
    data = np.frombuffer(b" ".join(encoded), np.uint8)
    space = data == 0x20
    cuts = np.flatnonzero(space)
    starts = np.append(0, cuts + 1)
    lengths = np.append(cuts, len(data)) - starts
    offsets = np.append(0, np.cumsum(lengths))
    flat = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[~space])]
    )
    begins = np.cumsum([0, *(len(text) + 1 for text in encoded[:-1])])
    first = np.searchsorted(starts, begins)
    return flat.dictionary_encode(), np.diff(np.append(first, len(starts)))


class PieceEncoder:
    """Encodes texts piece by piece. ``encode_words`` gives the ids of words of byte letters, and how many each has.

    A piece is known by its bytes, without the space before it; the first of a text, which has none, by a tuple of
    them. The cache is bounded in bytes; pieces met at least three times outlive a full one.
    """

    def __init__(self, path, encode_words=None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.encode_words = encode_words or word_encoder(self.tokenizer.model, self.tokenizer.get_vocab(with_added_tokens=False))
        self.special = {token.content: id for id, token in self.tokenizer.get_added_tokens_decoder().items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.mark_ids, counts = self.encode_words(as_letters([chr(mark) for mark in _MARKS]))
        self.mark_counts = np.append(counts, 0)  # the last number is that of no mark
        self.mark_starts = np.append(np.cumsum(counts) - counts, 0)
        self._clear()

    def _clear(self):
        self.pieces, self.bytes = {}, 0
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.hits = np.zeros(0, np.int64)

    def _shrink(self):
        """Forget the pieces that were met less often, or all if that does not free half."""
        often = self.hits >= OFTEN
        starts, lengths, flat = self.starts[often], self.lengths[often], self.flat
        kept = [piece for piece, i in self.pieces.items() if i >= 0 and often[i]]  # in the order of their numbers
        self._clear()
        if PIECE_BYTES * len(kept) + 4 * int(lengths.sum()) < CACHE_BYTES // 2:
            self._keep(kept, gather(flat, starts, lengths), lengths, 0)

    def _keep(self, keys, ids, lengths, size):
        """Know pieces by ``keys`` of ``size`` bytes together."""
        first = len(self.starts)
        self.pieces.update(zip(keys, range(first, first + len(keys))))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.hits = np.concatenate((self.hits, np.zeros(len(keys), np.int64)))
        self.flat = np.concatenate((self.flat, ids))
        self.bytes += PIECE_BYTES * len(keys) + 4 * len(ids) + size

    def _learn_plain(self, keys, texts):
        """Pieces of common letters after a space: all are cut into words at once, as one text."""
        words = pa.array(_WORDS.findall(" " + " ".join(texts))).dictionary_encode()
        place = words.indices.to_numpy(zero_copy_only=False)
        opens = pc.starts_with(words.dictionary, " ").to_numpy(zero_copy_only=False)[place]
        ids, lengths = self.encode_words(as_letters(words.dictionary.to_pylist()))
        own = lengths[place]
        starts = np.flatnonzero(opens)  # no piece holds a space, so a word that begins with one begins a piece
        self._keep(keys, gather(ids, (np.cumsum(lengths) - lengths)[place], own), np.add.reduceat(own, starts), sum(map(len, keys)))

    def _learn_other(self, keys, texts):
        """Pieces with special tokens or other letters, cut by the library one by one."""
        parts, words, whole = [], [], []  # parts: numbers of words; of special tokens, -1 minus the id
        for text in texts:
            count = len(parts)
            for part in self.special_cut.split(text) if self.special else [text]:
                if part in self.special:
                    parts.append(-1 - self.special[part])
                elif part:
                    for letters, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                        parts.append(len(words))
                        words.append(letters)
            whole.append(len(parts) - count)
        ids, lengths = self.encode_words(words)
        parts = np.array(parts, np.int64)
        starts = np.append(np.cumsum(lengths) - lengths, 0)
        special = parts < 0
        at = np.where(special, len(ids) - 1 - parts, starts[np.where(special, len(words), parts)])
        own = np.where(special, 1, np.append(lengths, 0)[np.where(special, len(words), parts)])
        most = max(self.special.values(), default=0)
        flat = np.append(ids, np.arange(most + 1, dtype=np.uint32))  # so that a special token is a run like others
        ends = np.append(0, np.cumsum(own))[np.cumsum(whole, dtype=np.int64)]
        self._keep(keys, gather(flat, at, own), np.diff(ends, prepend=0), sum(map(len, texts)))

    def _special_in(self, text):
        return self.special_cut is not None and self.special_cut.search(text) is not None

    def _learn_simple(self, keys, letters, lengths, marks):
        """Pieces of letters and at most one mark after them: ``letters`` of all, ``lengths`` of their words, ``marks``."""
        offsets = np.append(0, np.cumsum(lengths)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        place = words.indices.to_numpy(zero_copy_only=False)
        spaced = b" ".join(words.dictionary.to_pylist()).decode()
        ids, counts = self.encode_words((_BLANK + spaced.replace(" ", " " + _BLANK)).split(" "))
        starts = np.stack(((np.cumsum(counts) - counts)[place], len(ids) + self.mark_starts[marks]), 1).ravel()
        own = np.stack((counts[place], self.mark_counts[marks]), 1)
        self._keep(keys, gather(np.append(ids, self.mark_ids), starts, own.ravel()), own.sum(axis=1), len(letters) + len(keys))

    def _learn_pieces(self, keys):
        """Pieces after a space, known by their bytes. One with white space at an end is only marked."""
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        data = np.frombuffer(b"".join(keys), np.uint8)
        bounds = np.append(0, np.cumsum(sizes))
        letter = _IS_LETTER[data]
        letters = np.diff(np.append(0, np.cumsum(letter))[bounds])
        last = np.append(data, np.uint8(0))[np.maximum(bounds[1:] - 1, 0)]
        marks = np.where(letters == sizes, len(_MARKS), _MARK_NUMBER[last])  # without a mark, the number after the last
        simple = (letters > 0) & ((letters == sizes) | (letters == sizes - 1) & (marks < len(_MARKS)))
        if self._special_in(b" ".join(keys).decode()):
            simple &= [not self._special_in(key.decode()) for key in keys]
        if simple.any():
            taken = data[letter & np.repeat(simple, sizes)]
            self._learn_simple([keys[i] for i in np.flatnonzero(simple).tolist()], taken, letters[simple], marks[simple])
        plain, plain_texts, other, other_texts = [], [], [], []
        for i in np.flatnonzero(~simple).tolist():
            key, text = keys[i], keys[i].decode()
            if not text or text[0].isspace() or text[-1].isspace():
                self.pieces[key] = ODD
                self.bytes += PIECE_BYTES + len(key)
            elif _PLAIN.fullmatch(text) and not self._special_in(text):
                plain.append(key)
                plain_texts.append(text)
            else:
                other.append(key)
                other_texts.append(" " + text)
        if plain:
            self._learn_plain(plain, plain_texts)
        if other:
            self._learn_other(other, other_texts)

    def _learn_marked(self, keys):
        """First pieces (bytes,) and careful pieces (bytes, whether a space is before them)."""
        learn, texts = [], []
        for key in keys:
            text = key[0].decode()
            if len(key) == 1 and text and (text[0].isspace() or text[-1].isspace()):
                self.pieces[key] = ODD
                self.bytes += PIECE_BYTES + len(key[0])
            else:
                learn.append(key)
                texts.append(" " + text if len(key) == 2 and key[1] else text)
        if learn:
            self._learn_other(learn, texts)

    def _find(self, keys, learn):
        """Numbers of pieces, learning those that are new.

        The quick cut at every space goes wrong beside other white space. Such pieces are marked when first met and
        their texts cut with care; careful pieces have keys of their own.
        """
        found = np.fromiter(map(self.pieces.get, keys, repeat(NEW)), np.int64, len(keys))
        missing = np.flatnonzero(found == NEW)
        if len(missing):
            new = [keys[i] for i in missing.tolist()]
            learn(list(dict.fromkeys(new)))
            found[missing] = np.fromiter(map(self.pieces.__getitem__, new), np.int64, len(new))
        return found

    def _careful(self, text):
        parts = [(part.encode(), 1) for part in _CUT.split(text)]
        parts[0] = (parts[0][0], 0)
        return parts

    def encode(self, texts):
        """Ids of all texts one after another, and the number of ids of each text."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        # Many pieces are made and none refers back: the cycle collector would only walk them.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts):
        if self.bytes > CACHE_BYTES:
            self._shrink()
        cut, sizes = split_at_spaces(texts)
        place = cut.indices.to_numpy(zero_copy_only=False)
        first = np.cumsum(sizes) - sizes
        later = np.ones(len(place), bool)
        later[first] = False
        needed = np.zeros(len(cut.dictionary), bool)
        needed[place[later]] = True
        needed = np.flatnonzero(needed)
        numbers = np.full(len(cut.dictionary), NEW)
        numbers[needed] = self._find(cut.dictionary.take(pa.array(needed)).to_pylist(), self._learn_pieces)
        found = numbers[place]
        firsts = [(key,) for key in cut.dictionary.take(pa.array(place[first])).to_pylist()]
        found[first] = self._find(firsts, self._learn_marked)
        of = np.repeat(np.arange(len(texts)), sizes)
        odd = np.unique(of[found == ODD])
        if len(odd):
            careful = [self._careful(texts[i]) for i in odd]
            parts = np.split(found, np.cumsum(sizes)[:-1])
            again = self._find(list(chain.from_iterable(careful)), self._learn_marked)
            again = np.split(again, np.cumsum([len(own) for own in careful])[:-1])
            for i, own in zip(odd, again):
                parts[i] = own
            found, sizes = np.concatenate(parts), np.array([len(own) for own in parts], np.int64)
        self.hits += np.bincount(found, minlength=len(self.hits))
        own = self.lengths[found]
        ids = gather(self.flat, self.starts[found], own)
        return ids, np.diff(np.append(0, np.cumsum(own))[np.append(0, np.cumsum(sizes))])


class WholeEncoder:
    """Encodes whole texts by the tokenizers library: for files that are not plain byte-level BPE."""

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def encode(self, texts):
        found = [item.ids for item in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(ids) for ids in found], np.int64)
        return np.array([id for ids in found for id in ids], np.uint32), counts


_encoders = {}


def encoder(path):
    """The encoder of a tokenizer file; one per Python worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path) if is_byte_level(path) else WholeEncoder(path)
    return _encoders[path]
