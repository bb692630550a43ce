"""Encoding, token files and packing against the tokenizers library."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import bpe, packing, token_files
from footfall.llm.bpe import Codec
from footfall.llm.pretokens import PATTERN, PieceEncoder, WholeEncoder, is_byte_level
from footfall.llm.queries import BYTE_BPE

PARTS = st.sampled_from(
    ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "<|endoftext|>", "1", "é", "ñ", "漢", "\xa0", " ", "\x85", "\x1c",
     "🙂", ".", "!", "²", "́", "᠎", "﻿", "\r\n", "Hello", "aaaa", "<|", "|>"]
)
TEXTS = st.lists(st.one_of(st.lists(PARTS, max_size=12).map("".join), st.text(max_size=20)), min_size=1, max_size=12)
pieces, codec = PieceEncoder(BYTE_BPE), Codec(BYTE_BPE)
LIBRARY = Tokenizer.from_file(BYTE_BPE)


def _split(ids, counts):
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def _rows(docs):
    return [(row.doc_id, row.text or "") for row in docs.select("doc_id", "text").collect()]


def test_pattern_is_the_public_one():
    import public_tokenizers

    assert PATTERN == public_tokenizers.PATTERN


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_encoders_equal_the_library(texts):
    expected = [item.ids for item in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert _split(*pieces.encode(texts)) == expected
    assert _split(*codec.encode(texts)) == expected
    assert [codec.decode(ids) for ids in expected] == texts


def test_every_character_beside_spaces(library):
    texts = [f"a{chr(c)} b {chr(c)}c{chr(c)}{chr(c)}d" for c in [*range(0x3000), *range(0xFE00, 0x10000), 0x1F642]]
    expected = [item.ids for item in library.encode_batch(texts, add_special_tokens=False)]
    assert _split(*pieces.encode(texts)) == expected
    assert _split(*codec.encode(texts)) == expected


def test_full_caches_change_nothing(library, monkeypatch):
    import footfall.llm.pretokens as module

    monkeypatch.setattr(module, "CACHE_BYTES", 4000)
    own = PieceEncoder(BYTE_BPE)
    for turn in range(6):
        texts = [f"word{i % (turn + 3)} other{i} same" for i in range(40)]
        expected = [item.ids for item in library.encode_batch(texts, add_special_tokens=False)]
        assert _split(*own.encode(texts)) == expected


def test_special_tokens_of_other_files(tmp_path):
    """Added tokens without a bracket, inside words, with zeros and digits; a vocabulary that joins the zero byte."""
    with open(BYTE_BPE, encoding="utf-8") as file:
        spec = json.load(file)
    added = ["SEP", "SEPARATE", "é", "\0x", "9", ".", "<|endoftext|>"]
    sample = dict(spec["added_tokens"][0])
    spec["added_tokens"] = [{**sample, "id": 50_256 + i, "content": text} for i, text in enumerate(reversed(added))]
    path = str(tmp_path / "added.json")
    dice = random.Random(2)
    parts = [*added, "S", "a", " ", "  ", "\n", "EP", "\0", "x", "word", "words.", "1", "漢"]
    texts = ["".join(dice.choices(parts, k=dice.randint(0, 14))) for _ in range(800)]
    for joined in (False, True):
        if joined:  # a merge with the letter of byte 0, which then cannot keep words apart
            spec["model"]["vocab"]["Āa"] = 50_300
            spec["model"]["merges"].append(["Ā", "a"] if isinstance(spec["model"]["merges"][0], list) else "Ā a")
        with open(path, "w", encoding="utf-8") as file:
            json.dump(spec, file)
        assert is_byte_level(path)
        library = Tokenizer.from_file(path)
        expected = [item.ids for item in library.encode_batch(texts, add_special_tokens=False)]
        assert _split(*PieceEncoder(path).encode(texts)) == expected
    spec["added_tokens"][0]["content"] = "two words"
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    assert not is_byte_level(path)
    library = Tokenizer.from_file(path)
    texts = ["", "a two words b", "x"]
    assert _split(*WholeEncoder(path).encode(texts)) == [library.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_bpe_digests(which, request, library):
    docs = request.getfixturevalue(which)
    expected = Counter()
    for doc_id, text in _rows(docs):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(value.encode()).hexdigest() for value in (",".join(map(str, ids)), decoded)]
        expected[(doc_id, len(ids), *sha)] += 1
    assert Counter(map(tuple, bpe.digests(docs, BYTE_BPE).collect())) == expected


def test_bpe_columns_round_trip(odd_docs):
    back = bpe.decode(bpe.encode(odd_docs, BYTE_BPE), BYTE_BPE, text="back").select("text", "back").collect()
    assert all((row.text or "") == row.back for row in back)


def test_values_of_every_length():
    values = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint64)
    for count in range(len(values) + 1):
        control, data = token_files.pack_values(values[:count])
        assert len(control) == -(-count // 4)
        assert token_files.unpack_values(control, data, count).tolist() == values[:count].tolist()


@pytest.mark.parametrize("which", ["docs", "odd_docs", "no_docs"])
def test_token_files(which, request, library):
    docs = request.getfixturevalue(which)
    found = token_files.digests(docs, BYTE_BPE).orderBy("start").collect()
    at = 0
    for row in found:
        assert row.start == at
        at += row.n_tokens
    order = [-1 if row.doc_id is None else row.doc_id for row in found]
    assert order == sorted(order)
    expected = Counter()
    for doc_id, text in _rows(docs):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        expected[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((row.doc_id, row.n_tokens, row.ids_crc32) for row in found) == expected


def test_small_files_and_ranks(docs, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_VALUES", 3000)
    manifest = token_files.write(docs, str(tmp_path), BYTE_BPE, 2)
    assert manifest.count() > 20
    assert token_files.read(spark, str(tmp_path)).count() == docs.count()
    sizes = [path.stat().st_size for path in (tmp_path / "files").iterdir() if path.suffix == ".frv"]
    values = manifest.groupBy().sum("n_values").first()[0]
    assert sum(sizes) < 2.2 * values  # two-byte ids would take as much, four-byte ids twice


@pytest.mark.parametrize("which", ["docs", "odd_docs", "no_docs"])
def test_packing(which, request, library):
    docs = request.getfixturevalue(which)
    rows = packing.pack(docs, BYTE_BPE).collect()
    sequences = {}
    whole = {}
    for row in rows:
        assert len(row.ids) == 4 * row.length <= 4 * 2048
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
        whole.setdefault((row.doc_id, row.doc_tokens), []).append((row.start, bytes(row.ids)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    expected, found = Counter(), Counter()
    for doc_id, text in _rows(docs):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            expected[(doc_id, start, len(ids), np.array(ids[start:start + 2048], "<u4").tobytes())] += 1
    for (doc_id, tokens), parts in whole.items():
        for start, ids in parts:
            found[(doc_id, start, tokens, ids)] += 1
    assert found == expected
    if which == "docs":
        assert sum(len(ids) for parts in whole.values() for _, ids in parts) / 4 > 0.97 * 2048 * len(sequences)


def test_digests_are_of_the_packed_ids(odd_docs):
    by_ids = packing.pack(odd_docs, BYTE_BPE).collect()
    crcs = Counter((row.doc_id, row.start, row.length, zlib.crc32(bytes(row.ids)), row.doc_tokens) for row in by_ids)
    assert Counter(tuple(row)[:5] for row in packing.digests(odd_docs, BYTE_BPE).collect()) == crcs


def test_one_length_over_many_tasks(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text")).repartition(11)
    rows = packing.digests(docs, BYTE_BPE).collect()
    assert len({(row.sequence_id, row.offset) for row in rows}) == 3000
    assert max(row.sequence_id for row in rows) + 1 == -(-3000 // (2048 // rows[0].length))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), max_size=30), max_size=5))
def test_ranks_go_on_over_batches(batches):
    met, seen = np.zeros(10, np.int64), Counter()
    for lengths in batches:
        for length, rank in zip(lengths, packing._ranks(np.array(lengths, np.int64), met).tolist()):
            assert rank == seen[length]
            seen[length] += 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
def test_plan_places_every_length_once(histogram):
    patterns = packing.plan(histogram, 64)
    placed = Counter()
    for count, lengths in patterns:
        assert sum(lengths) <= 64 and list(lengths) == sorted(lengths, reverse=True)
        for length in lengths:
            placed[length] += count
    assert placed == Counter(histogram)
    table = packing.intervals(patterns)
    assert sum(count for count, _ in patterns) >= (table[2].max() + 1 if table.size else 0)
