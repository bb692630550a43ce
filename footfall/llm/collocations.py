"""Phrase collocations by direct-address tiling.

Frequent words get their frequency rank as number. A pair of numbers lies in a square tile of the table of all pairs; a
task counts its pairs tile by tile, dense tiles in an array by ``bincount`` and sparse ones as sorted coordinates. The
frequent pairs get ranks again, and triples are the pairs of (rank of a pair, number of a word), counted the same way.

Only the most frequent words and pairs are numbered, as many as the bounds say, and broadcast. A phrase with a
frequent word beyond them is counted by its text, so no phrase is lost. Which other words and pairs are frequent is
known by Bloom filters of fixed size: they let pass some that are not, whose counts then stay below the least.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from footfall.llm.common import released
from footfall.operators import top_k_per_group
from footfall.session import write_shared

WORD_BITS = 21  # three numbers fit a key
HEAD_WORDS = 1 << 19  # numbered words of all languages together, at most 1 << WORD_BITS
HEAD_PAIRS = 1 << 19  # numbered pairs of all languages together
HEAD_BYTES = 64  # of a numbered word
BLOOM_BITS = 27
TILE_BITS = 9
DENSE = 1 << (2 * TILE_BITS - 4)  # pairs that make a tile dense
SLICE_BYTES = 2_000_000
FLUSH_TOKENS = 500_000
BATCH_ROWS = 50_000
UNKNOWN = "und"
MILLION = 1_000_000

OTHER, RARE = -1, -2
_SPACE, _BORDER = 0x20, 0xFF  # no UTF-8 text holds the byte that stands for a border between pieces
_LETTERS = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\xff" * 10
)


class Tokens:
    """The words of some texts (bytes): ``place`` numbers each in ``words``, ``opens`` tells whether it begins a piece."""

    def __init__(self, texts):
        data = np.frombuffer(b"\xff".join(texts).translate(_LETTERS), np.uint8)
        border = data == _BORDER
        inside = ~border & (data != _SPACE)
        before = np.append(False, inside[:-1])
        starts = np.flatnonzero(inside & ~before)
        lengths = np.flatnonzero(before & ~inside)
        if len(lengths) < len(starts):
            lengths = np.append(lengths, len(data))
        lengths -= starts
        offsets = np.append(0, np.cumsum(lengths)).astype(np.int64)
        flat = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        )
        found = flat.dictionary_encode()
        self.place = found.indices.to_numpy(zero_copy_only=False)
        self.words = found.dictionary
        piece = np.cumsum(border)[starts]
        self.opens = np.append(True, piece[1:] != piece[:-1])[:len(piece)]

    def __len__(self):
        return len(self.place)

    def phrases(self, at, length):
        """Different phrases of ``length`` words that begin at the places ``at``, as texts, and how often each occurs."""
        rows = np.column_stack([self.place[at + i] for i in range(length)])
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1))[:len(rows)])
        words = [self.words.take(pa.array(rows[first, i])) for i in range(length)]
        return pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())), np.diff(np.append(first, len(rows)))


def _by_lang(batches):
    """(lang, tokens) in slices of bounded bytes; one longer text is a slice of its own."""
    for batch in batches:
        held, sizes = {}, {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if text:
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] > SLICE_BYTES:
                    yield lang, Tokens(held.pop(lang))
                    del sizes[lang]
        for lang, texts in held.items():
            yield lang, Tokens(texts)


def _source(docs):
    return docs.select(
        F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text")
    )


def _rows(lang, **columns):
    """Record batches of the columns, all of one language and of bounded length."""
    n = len(next(iter(columns.values())))
    for start in range(0, n, BATCH_ROWS):
        own = [column[start:start + BATCH_ROWS] for column in columns.values()]
        own = [column if isinstance(column, pa.Array) else pa.array(column) for column in own]
        langs = pa.array([lang]).take(pa.array(np.zeros(len(own[0]), np.int32)))
        yield pa.RecordBatch.from_arrays([langs, *own], names=["lang", *columns])


def count_words(docs, least):
    """``(lang, word, f)`` of words found ``least`` times or more; the row with a null word counts all words."""
    def run(batches):
        for lang, tokens in _by_lang(batches):
            counts = np.bincount(tokens.place, minlength=len(tokens.words))
            yield from _rows(lang, word=tokens.words.cast(pa.binary()), f=counts)
            yield from _rows(lang, word=pa.nulls(1, pa.binary()), f=[len(tokens)])

    part = _source(docs).mapInArrow(released(run), "lang string, word binary, f long")
    total = part.groupBy("lang", "word").agg(F.sum("f").alias("f"))
    return total.where(F.col("word").isNull() | (F.col("f") >= least)).withColumn("word", F.col("word").cast("string"))


def head_of(table, columns, count, bound):
    """The most frequent rows, at most ``bound``, as lists of ``columns`` and ``count``; and the others, None if none.

    The least count of the head is a power of two, found from the number of rows of each bit length: no order over
    the whole table is needed, and what reaches the driver is bounded.
    """
    level = F.length(F.bin(count))
    found = table.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()  # <= 64 rows
    taken, least = 0, 65
    for one, n in sorted(((row.level, row.n) for row in found), reverse=True):
        if taken + n > bound:
            break
        taken, least = taken + n, one
    head = table.where(level >= least).select(*columns, count).toArrow()
    others = None if taken == sum(row.n for row in found) else table.where(level < least)
    return [column.to_pylist() for column in head.columns], others


class Bloom:
    """A set of 64-bit keys of each language in a bitmap of fixed size; it may hold more than was put in, never less."""

    def __init__(self, slots=(), words=()):
        self.table = np.zeros(1 << (BLOOM_BITS - 6), np.uint64)
        self.table[np.asarray(slots, np.int64)] = np.asarray(words, np.int64).view(np.uint64)

    @staticmethod
    def bits(lang, keys):
        """Four places for each key, as the slots of 64 bits and the bits in them."""
        with np.errstate(over="ignore"):
            h = keys.astype(np.uint64) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
            step = (h >> np.uint64(32)) | np.uint64(1)
            places = (h[:, None] + step[:, None] * np.arange(4, dtype=np.uint64)) & np.uint64((1 << BLOOM_BITS) - 1)
        return (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63))

    def has(self, lang, keys):
        slots, bits = self.bits(lang, keys)
        return ((self.table[slots] & bits) != 0).all(axis=1)


def word_keys(words):
    """64-bit keys of words (bytes)."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def bloom_of(table, key):
    """The Bloom filter of a table's ``lang`` and ``key``, a word or a number; of nothing if there is no table.

    Tasks set bits in words of 64, which are joined by ``bit_or``; as many words as the bitmap has reach the driver.
    """
    if table is None:
        return None

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            column = batch.column("key")
            keys = column.to_numpy() if pa.types.is_int64(column.type) else word_keys(column.to_pylist())
            for lang in set(langs):
                slots, bits = Bloom.bits(lang, keys[langs == lang])
                met, where = np.unique(slots.ravel(), return_inverse=True)
                words = np.zeros(len(met), np.uint64)
                np.bitwise_or.at(words, where.ravel(), bits.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(words.view(np.int64))], names=["slot", "bits"])

    own = F.col(key) if key == "key" else F.col(key).cast("binary")
    set_bits = table.select("lang", own.alias("key")).mapInArrow(released(run), "slot long, bits long")
    words = set_bits.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    return Bloom(words.column("slot").to_numpy(), words.column("bits").to_numpy())


class Numbers:
    """Word numbers of each language; ``others`` holds the frequent words without one."""

    def __init__(self, langs, words, counts, others):
        self.others = others
        held = {}
        for lang, _, word in sorted(zip(langs, (-f for f in counts), (word.encode() for word in words))):
            held.setdefault(lang, []).append(word)
        self.words = {lang: pa.array(own, pa.large_binary()) for lang, own in held.items()}

    def of(self, lang, tokens):
        """The number of each token: OTHER for a frequent word without one, RARE for a word that is not frequent."""
        own = self.words.get(lang)
        if own is None:
            numbers = np.full(len(tokens.words), RARE)
        else:
            numbers = pc.fill_null(pc.index_in(tokens.words, value_set=own), RARE).to_numpy(zero_copy_only=False).astype(np.int64)
        if self.others is not None:
            unknown = np.flatnonzero(numbers == RARE)
            keys = word_keys(tokens.words.take(pa.array(unknown)).to_pylist())
            numbers[unknown[self.others.has(lang, keys)]] = OTHER
        return numbers[tokens.place]


def count_tiles(left, right, bits=TILE_BITS):
    """Different pairs of numbers, in order of tiles, and how often each occurs."""
    if not len(left):
        return left, right, np.zeros(0, np.int64)
    side = 1 << bits
    width = int(right.max() >> bits) + 1
    tile = (left >> bits) * width + (right >> bits)
    within = (left & (side - 1)) * side + (right & (side - 1))
    order = np.argsort(tile, kind="stable")
    tile, within = tile[order], within[order]
    begins = np.flatnonzero(np.diff(tile, prepend=-1))
    sizes = np.diff(np.append(begins, len(tile)))
    tiles, cells, counts = [], [], []
    for begin, size in zip(begins[sizes >= DENSE].tolist(), sizes[sizes >= DENSE].tolist()):
        table = np.bincount(within[begin:begin + size], minlength=side * side)
        met = np.flatnonzero(table)
        tiles.append(np.full(len(met), tile[begin]))
        cells.append(met)
        counts.append(table[met])
    sparse = np.repeat(sizes < DENSE, sizes)
    keys, n = np.unique(tile[sparse] * (side * side) + within[sparse], return_counts=True)
    tiles.append(keys >> (2 * bits))
    cells.append(keys & (side * side - 1))
    counts.append(n)
    tile, cell = np.concatenate(tiles), np.concatenate(cells)
    return (tile // width << bits) + (cell >> bits), (tile % width << bits) + (cell & (side - 1)), np.concatenate(counts)


PHRASES = "lang string, key long, phrase binary, a long"


class _Tally:
    """Pairs of numbers for the tiles, and further keys, of one language in a task."""

    def __init__(self):
        self.left, self.right, self.keys, self.held = [], [], [], 0

    def rows(self, lang, key_of):
        left, right, counts = count_tiles(*(np.concatenate([np.zeros(0, np.int64), *x]) for x in (self.left, self.right)))
        keys, more = np.unique(np.concatenate([np.zeros(0, np.int64), *self.keys]), return_counts=True)
        keys, counts = np.append(key_of(left, right), keys), np.append(counts, more)
        yield from _rows(lang, key=keys, phrase=pa.nulls(len(keys), pa.binary()), a=counts)


def _count_phrases(docs, length, put, key_of):
    """Counts of phrases: ``put(tally, lang, tokens)`` notes those of numbers and returns where the others begin."""
    def run(batches):
        tallies = {}
        for lang, tokens in _by_lang(batches):
            tally = tallies.setdefault(lang, _Tally())
            at = put(tally, lang, tokens)
            if at is not None and len(at):
                phrases, counts = tokens.phrases(at, length)
                yield from _rows(lang, key=pa.nulls(len(counts), pa.int64()), phrase=phrases.cast(pa.binary()), a=counts)
            if sum(one.held for one in tallies.values()) > FLUSH_TOKENS:
                for other, one in tallies.items():
                    yield from one.rows(other, key_of(other))
                tallies.clear()
        for lang, tally in tallies.items():
            yield from tally.rows(lang, key_of(lang))

    part = _source(docs).mapInArrow(released(run), PHRASES)
    return part.groupBy("lang", "key", "phrase").agg(F.sum("a").alias("a"))


def _as_words(counted, numbers, length):
    """Phrases with their words as columns w1, w2, ...: numbered ones by the broadcast words."""
    names = [f"w{i + 1}" for i in range(length)]

    def run(batches):
        for batch in batches:
            columns = [[] for _ in names]
            for lang, key, phrase in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "phrase"))):
                if key is None:
                    words = phrase.split(b" ")
                else:
                    own = numbers.value.words[lang]
                    mask = (1 << WORD_BITS) - 1
                    words = [own[key >> WORD_BITS * (length - 1 - i) & mask].as_py() for i in range(length)]
                for column, word in zip(columns, words):
                    column.append(word.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), *(pa.array(c, pa.string()) for c in columns), batch.column("key"), batch.column("a")],
                names=["lang", *names, "key", "a"],
            )

    return counted.mapInArrow(released(run), f"lang string, {', '.join(f'{n} string' for n in names)}, key long, a long")


def _others(numbers, opens, length):
    """Where phrases begin that hold a frequent word without a number, and no rare one or border."""
    n = len(numbers) - length + 1
    if n < 1:
        return np.zeros(0, np.int64)
    parts = [numbers[i:n + i] for i in range(length)]
    fits = np.logical_and.reduce([part != RARE for part in parts])
    fits &= ~np.logical_or.reduce([opens[i:n + i] for i in range(1, length)])
    return np.flatnonzero(fits & np.logical_or.reduce([part == OTHER for part in parts]))


def _numbered(numbers, opens, length):
    """Where phrases of numbered words begin within a piece."""
    n = len(numbers) - length + 1
    if n < 1:
        return np.zeros(0, np.int64)
    fits = np.logical_and.reduce([numbers[i:n + i] >= 0 for i in range(length)])
    return np.flatnonzero(fits & ~np.logical_or.reduce([opens[i:n + i] for i in range(1, length)]))


def count_pairs(docs, numbers, least):
    """``(lang, w1, w2, key, a)`` of pairs found ``least`` times or more. The key of a pair with another word is null."""
    def put(tally, lang, tokens):
        n = numbers.value.of(lang, tokens)
        at = _numbered(n, tokens.opens, 2)
        tally.left.append(n[at])
        tally.right.append(n[at + 1])
        tally.held += len(at)
        return _others(n, tokens.opens, 2) if numbers.value.others is not None else None

    counted = _count_phrases(docs, 2, put, lambda lang: lambda left, right: (left << WORD_BITS) + right)
    return _as_words(counted.where(F.col("a") >= least), numbers, 2)


class PairRanks:
    """Frequent pairs of each language by frequency rank, found by their keys; ``others`` holds those without a rank."""

    def __init__(self, langs, keys, counts, others):
        self.others = others
        held = {}
        for lang, key, a in zip(langs, keys, counts):
            held.setdefault(lang, []).append((-a, key))
        self.by_rank = {lang: np.array([key for _, key in sorted(own)], np.int64) for lang, own in held.items()}
        self.order = {lang: np.argsort(keys) for lang, keys in self.by_rank.items()}
        self.sorted = {lang: keys[self.order[lang]] for lang, keys in self.by_rank.items()}

    def of(self, lang, keys):
        """The rank of each pair: OTHER for a frequent pair without one, RARE for a pair that is not frequent."""
        known = self.sorted.get(lang)
        ranks = np.full(len(keys), RARE)
        if known is not None:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            ranks = np.where(known[at] == keys, self.order[lang][at], RARE)
        if self.others is not None:
            unknown = np.flatnonzero(ranks == RARE)
            ranks[unknown[self.others.has(lang, keys[unknown])]] = OTHER
        return ranks


def count_triples(docs, numbers, pairs, least):
    """``(lang, w1, w2, w3, key, a)`` of triples found ``least`` times or more.

    Both pairs of such a triple are as frequent. A ranked pair makes a tile's row; a triple of numbered words whose first
    pair has no rank is counted by its key, one with another word by its text.
    """
    def put(tally, lang, tokens):
        n = numbers.value.of(lang, tokens)
        at = _numbered(n, tokens.opens, 3)
        one, two, three = n[at], n[at + 1], n[at + 2]
        first = pairs.value.of(lang, (one << WORD_BITS) + two)
        second = pairs.value.of(lang, (two << WORD_BITS) + three)
        fits = second != RARE
        ranked, rest = fits & (first >= 0), fits & (first == OTHER)
        tally.left.append(first[ranked])
        tally.right.append(three[ranked])
        tally.keys.append((((one << WORD_BITS) + two << WORD_BITS) + three)[rest])
        tally.held += int(ranked.sum()) + int(rest.sum())
        return _others(n, tokens.opens, 3) if numbers.value.others is not None else None

    def key_of(lang):
        return lambda left, right: (pairs.value.by_rank.get(lang, left)[left] << WORD_BITS) + right

    return _as_words(_count_phrases(docs, 3, put, key_of).where(F.col("a") >= least), numbers, 3)


def collocations(docs, least=10, inside_percent=50, top=2000, head_words=HEAD_WORDS, head_pairs=HEAD_PAIRS):
    """The ``top`` phrases of two and three words of each language by their weakest cut.

    Per lang (null: ``und``): lang, rank, phrase, a, l, r, n, score. Ties go by ``a`` descending, then by the phrase's
    bytes. Texts are whole; a null or empty text has no words; repeated rows count each; an empty table gives no
    rows. A phrase inside a longer candidate with at least ``inside_percent`` of its count is left out. Other columns of
    ``docs`` are not read. At most ``head_words`` words and ``head_pairs`` pairs are numbered and broadcast.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast
    counted = write_shared(count_words(docs, least), "words")
    words = counted.where(F.col("word").isNotNull())
    totals = counted.where(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    short = F.octet_length("word") <= HEAD_BYTES
    head, others = head_of(words.where(short), ["lang", "word"], "f", min(head_words, HEAD_WORDS))
    long = words.where(~short)
    others = long.unionByName(others) if others is not None else None if long.isEmpty() else long
    numbers = broadcast(Numbers(*head, bloom_of(others, "word")))
    pairs = write_shared(count_pairs(docs, numbers, least), "pairs")
    head, others = head_of(pairs.where(F.col("key").isNotNull()), ["lang", "key"], "a", head_pairs)
    ranks = broadcast(PairRanks(*head, bloom_of(others, "key")))
    triples = write_shared(count_triples(docs, numbers, ranks, least), "triples")
    return _ranked(words, totals, pairs.drop("key"), triples.drop("key"), inside_percent, top)


def _ranked(words, totals, pairs, triples, inside_percent, top):
    def word(name, f):
        return words.select("lang", F.col("word").alias(name), F.col("f").alias(f))

    def pair(first, second, a):
        return pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(a))

    def score(l, r):  # noqa: E741
        return F.expr(
            f"cast(cast({MILLION} as decimal(38,0)) * cast(a as decimal(38,0)) * cast(a as decimal(38,0)) "
            f"div (cast({l} as decimal(38,0)) * cast({r} as decimal(38,0))) as bigint)"
        )

    # The largest count of a triple around each pair.
    around = (
        triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
        .groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2"))
        .agg(F.max("a").alias("longer"))
    )
    free = pairs.join(around, ["lang", "w1", "w2"], "left").where(
        F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True))
    )
    twos = free.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    twos = twos.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", score("l", "r").alias("score"))
    cuts = (
        triples.join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"])
        .join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
        .join(word("w1", "l1"), ["lang", "w1"])
        .join(word("w3", "r2"), ["lang", "w3"])
        .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l1", "r1", "l2", "r2",
                score("l1", "r1").alias("s1"), score("l2", "r2").alias("s2"))
    )
    first = F.col("s1") <= F.col("s2")
    threes = cuts.select(
        "lang", "phrase", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    both = twos.unionByName(threes)
    ranked = top_k_per_group(both, "lang", [F.col("score").desc(), F.col("a").desc()], key="phrase", k=top, rank="rank")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least=10, inside_percent=50, top=2000):
    return f"""
with pieces as materialized (
  select coalesce(lang, 'und') lang, row_number() over () piece, p from (
    select lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) p
    from documents)
), spelled as (
  select lang, piece, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda w: w <> '') ws from pieces
), tokens as materialized (
  select lang, piece, unnest(ws) w, generate_subscripts(ws, 1) i from spelled
), runs as materialized (
  select lang, w w1, lead(w) over row w2, lead(w, 2) over row w3 from tokens window row as (partition by piece order by i)
), f1 as materialized (select lang, w1 w, count(*) f from runs group by lang, w1),
f2 as materialized (select lang, w1, w2, count(*) f from runs where w2 is not null group by lang, w1, w2),
f3 as materialized (
  select lang, w1, w2, w3, count(*) f from runs where w3 is not null group by lang, w1, w2, w3 having count(*) >= {least}
), totals as (select lang, sum(f)::bigint n from f1 group by lang
), scored as (
  select p.lang, p.w1 || ' ' || p.w2 phrase, p.f a, x.f l, y.f r, 1 k
  from f2 p join f1 x on x.lang = p.lang and x.w = p.w1 join f1 y on y.lang = p.lang and y.w = p.w2
  where p.f >= {least} and not exists (
    select 1 from f3 t where t.lang = p.lang and 100 * t.f >= {inside_percent} * p.f
      and ((t.w1 = p.w1 and t.w2 = p.w2) or (t.w2 = p.w1 and t.w3 = p.w2)))
  union all
  select t.lang, concat_ws(' ', t.w1, t.w2, t.w3), t.f, x.f, y.f, 1
  from f3 t join f1 x on x.lang = t.lang and x.w = t.w1 join f2 y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
  union all
  select t.lang, concat_ws(' ', t.w1, t.w2, t.w3), t.f, x.f, y.f, 2
  from f3 t join f2 x on x.lang = t.lang and x.w1 = t.w1 and x.w2 = t.w2 join f1 y on y.lang = t.lang and y.w = t.w3
), weakest as (
  select *, ({MILLION}::hugeint * a * a // (l::hugeint * r))::bigint score from scored
  qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase)::int rank from weakest
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= {top}
"""
