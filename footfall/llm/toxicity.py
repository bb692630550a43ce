"""Toxicity by class-conditional Kneser-Ney models of the characters of words.

Each class has a model of its words, letter by letter with up to five letters before: discounted counts, backing off to
continuation counts of shorter contexts and at last to letter counts that both classes share. So inflected and rare
forms of an expression are known by the letters they share with others. A word speaks for toxicity by the difference
of its two log-likelihoods; a text by the mean over its words, and over the best window of each of a few lengths, as a
long text may hold a few toxic lines. A logistic curve, fitted on labelled texts by models that have not seen them, turns
these into a score.
"""

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import nested, parts_of, release, released
from footfall.session import write_shared

# Labelled texts of each class, at most and on average, that the models are fitted on.
SAMPLE = 2_000
ORDER = 6
DISCOUNT = 0.75
WINDOWS = (1, 3, 12)
FOLDS = 3
START, END = 1, 2
PART_ROWS, PART_WORDS = 2000, 300_000  # of texts that are scored together; one longer text is a part of its own
GAIN_WORDS = 20_000  # different words whose grams are held at a time
HASHED = 1 << 18  # letters that are hashed at a time
STEP = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id):
    """The evaluation fold: no label of it is learnt from."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0


def _words(text):
    """Runs of letters and digits, in lower case."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(split, lambda word: word != "")


class Grams:
    """The letters of words, with a start and an end sign, and hashes of the last 1 to ORDER of them.

    ``letters`` are the places of all letters but the start sign, ``at`` their places in their words, ``bounds`` the
    bounds of the words among them. Two lengths of hashes are held at a time: ``ends`` of the last n letters at each
    place (0 where the word has fewer), ``before`` of the last n - 1. The hash of n letters without the last is that of
    n - 1 letters one place before.
    """

    def __init__(self, words):
        lengths = np.array([len(word) for word in words], np.int64) + 2
        ends = np.cumsum(lengths)
        starts = ends - lengths
        self.codes = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
        inner = np.ones(len(self.codes), bool)
        self.codes[starts], self.codes[ends - 1] = START, END
        inner[starts] = inner[ends - 1] = False
        self.codes[inner] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.place = (np.arange(len(self.codes)) - np.repeat(starts, lengths)).astype(np.int32)
        self.letters = np.flatnonzero(self.place > 0)  # the start sign is given
        self.at = self.place[self.letters]
        self.bounds = np.append(0, np.cumsum(lengths - 1))
        self.before, self.ends = None, np.full(len(self.codes), STEP)

    def longer(self):
        """Go on to hashes of one letter more."""
        n = 1 if self.before is None else self.n + 1
        self.n, self.before = n, self.ends
        self.ends = np.zeros(len(self.codes), np.uint64)
        with np.errstate(over="ignore"):
            for start in range(0, len(self.codes), HASHED):
                reach = start + np.flatnonzero(self.place[start:start + HASHED] >= n - 1)
                x = self.before[reach] * STEP + self.codes[reach - (n - 1)].astype(np.uint64) + np.uint64(n)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                self.ends[reach] = x ^ (x >> np.uint64(31))


class Models:
    """Both models, from the words of each class and the number of texts that hold each (columns toxic, ordinary)."""

    def __init__(self, words, counts):
        grams = Grams(words)
        word = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(grams.bounds))
        # Of each length: the grams, whether they begin a word, their texts, their contexts, and what they are without the
        # first letter. The table of a length needs that of one letter more, so two lengths are held at a time.
        self.tables, held = {}, None
        for n in range(1, ORDER + 1):
            grams.longer()
            own = np.flatnonzero(grams.at >= n - 1)
            keys = grams.ends[grams.letters[own]]
            order = np.argsort(keys, kind="stable")
            keys, own = keys[order], own[order]
            del order
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            starts = np.flatnonzero(new)
            found, first, of = keys[starts], own[starts], word[own]
            del keys, new, own
            # Sums of whole numbers, so their order does not matter.
            totals = np.stack([np.add.reduceat(counts[:, c][of], starts) if len(starts) else np.zeros(0) for c in (0, 1)], 1)
            there = grams.letters[first]
            one = found, grams.at[first] == n - 1, totals, grams.before[there - 1], grams.before[there]
            del of, first, there, starts
            if n == 2:
                self.letters = held[0]
                either = np.bincount(np.searchsorted(self.letters, one[4]), minlength=len(self.letters)) + 1.0
                self.shared = np.append(either, 1.0) / (either.sum() + 1)
            elif n > 2:
                self.tables[n - 1] = self._table(held, one)
            held = one
        self.tables[ORDER] = self._table(held, None)

    @staticmethod
    def _table(raw, longer):
        """Grams with their shares, and contexts with their back-off weights, of both classes."""
        found, whole, totals, context, _ = raw
        if longer is not None:
            # How many letters come before: continuation counts. Grams at a word's start have none before them.
            _, _, seen, _, shorter = longer
            which = np.searchsorted(found, shorter)
            extended = np.stack([np.bincount(which, seen[:, c] > 0, len(found)) for c in (0, 1)], 1)
            totals = np.where(whole[:, None], totals, extended)
        contexts, of = np.unique(context, return_inverse=True)
        sums = np.stack([np.bincount(of, totals[:, c], len(contexts)) for c in (0, 1)], 1)
        kinds = np.stack([np.bincount(of, totals[:, c] > 0, len(contexts)) for c in (0, 1)], 1)
        share = np.maximum(totals - DISCOUNT, 0) / np.maximum(sums[of], 1)
        back = np.where(sums > 0, DISCOUNT * kinds / np.maximum(sums, 1), 1.0)
        return found, _padded(share, 0.0), contexts, _padded(back, 1.0)

    def gains(self, words):
        """Log-likelihood ratio of each word."""
        parts = [self._gains(words[at:at + GAIN_WORDS]) for at in range(0, len(words), GAIN_WORDS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _gains(self, words):
        grams = Grams(words)
        grams.longer()
        likely = np.repeat(self.shared[_find(self.letters, grams.ends[grams.letters])][:, None], 2, axis=1)
        for n in range(2, ORDER + 1):
            grams.longer()
            own = np.flatnonzero(grams.at >= n - 1)
            there = grams.letters[own]
            known, share, contexts, back = self.tables[n]
            likely[own] = share[_find(known, grams.ends[there])] + back[_find(contexts, grams.before[there - 1])] * likely[own]
        ratio = np.log(likely[:, 0]) - np.log(likely[:, 1])
        return np.add.reduceat(ratio, grams.bounds[:-1])

    def features(self, lists):
        """A row for each text of an Arrow column of word lists: the mean gain of its words, the best mean of each
        window length, and the logarithm of the number of words."""
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        coded = lists.flatten().dictionary_encode()
        gain = self.gains(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(coded) else np.zeros(0)
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = np.append(0, np.cumsum(n))
        sums = np.append(0, np.cumsum(gain))
        full = n > 0
        rows = np.zeros((len(n), len(WINDOWS) + 2))
        rows[full, 0] = (sums[bounds[1:]] - sums[bounds[:-1]])[full] / n[full]
        for i, width in enumerate(WINDOWS):
            # The mean of the window that starts at each word, as if words without gain followed the text.
            end = np.minimum(np.arange(len(gain)) + width, np.repeat(bounds[1:], n))
            means = (sums[end] - sums[:-1]) / width
            if full.any():
                rows[full, 1 + i] = np.maximum.reduceat(means, bounds[:-1][full])
        rows[:, -1] = np.log1p(n)
        return rows


def _padded(values, last):
    return np.vstack([values, np.full((1, values.shape[1]), last)])


def _find(table, keys):
    """Places of keys in a sorted table; its length for unknown ones."""
    at = np.searchsorted(table, keys)
    found = np.zeros(len(keys), bool)
    inside = at < len(table)
    found[inside] = table[at[inside]] == keys[inside]
    return np.where(found, at, len(table))


def _logistic(x, y):
    """Weights of a logistic curve on standardised features, by Newton steps with a small ridge."""
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    weights = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], 1.0)
    ridge[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * weights)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return mean, spread, weights


def train(docs, labels, sample=SAMPLE):
    """The fitted scorer, or None without labels of both classes.

    Labels of the evaluation fold and null labels take no part. Where a class has more than ``sample`` labels, a hash
    of doc_id chooses about as many. The logistic curve is fitted on each chosen text's features by models of the
    other folds; the final models are of all folds.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct()
    sizes = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("toxic") == 1, sample / sizes[1]).otherwise(sample / sizes[0])
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < share * (1 << 30))
    chosen = write_shared(chosen, "toxic-sample")
    # At most about twice ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS))
    rows = write_shared(rows.select(_words(F.col("text")).alias("words"), "toxic", fold.alias("fold")), "toxic-words")
    each = rows.select("toxic", "fold", F.explode(F.array_distinct("words")).alias("word"))
    texts = [F.count_if((F.col("toxic") == toxic) & (F.col("fold") == fold)) for fold in range(FOLDS) for toxic in (1, 0)]
    named = [column.alias(f"n{i}") for i, column in enumerate(texts)]
    # The different words of the bounded sample. The driver only passes on their counts, and the final model that one task
    # makes of them: making a model takes twenty times its own size, which not every scoring worker should need.
    table = each.groupBy("word").agg(*named).orderBy("word").toArrow()
    if not table.num_rows:
        return None
    counts = np.column_stack([table.column(f"n{i}").to_numpy() for i in range(2 * FOLDS)]).astype(float).reshape(-1, FOLDS, 2)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((table.column("word").combine_chunks(), counts))

    def run(of_fold):
        fold = of_fold.column("fold")[0].as_py()
        found = _model(shared, fold).features(of_fold.column("words"))
        rows = pa.array(list(found), pa.list_(pa.float64()))
        release()
        return pa.table({"toxic": of_fold.column("toxic").cast(pa.int32()), "x": rows})

    def make(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_model(shared))], pa.binary())], names=["model"])

    # A group is a fold of the bounded sample, and each needs one model.
    found = rows.select("words", "toxic", "fold").groupBy("fold").applyInArrow(run, "toxic int, x array<double>").collect()
    found = sorted(found, key=lambda row: (row.toxic, row.x))
    curve = _logistic(np.array([row.x for row in found]), np.array([row.toxic for row in found], float))
    made = spark.range(0, 1, 1, 1).mapInArrow(released(make), "model binary").head().model
    shared.unpersist()
    return spark.sparkContext.broadcast(pickle.loads(made)), curve


def _model(shared, fold=None):
    """The model of all folds but one, or of all, from the broadcast words and counts."""
    words, counts = shared.value
    texts = counts.sum(axis=1) - (0 if fold is None else counts[:, fold])
    held = texts.sum(axis=1) > 0
    model = Models(words.filter(pa.array(held)).to_pylist(), texts[held])
    release()
    return model


def score(docs, scorer, name="score"):
    """``docs`` (with text) and their scores from 0 to 1. Without a scorer every score is 0.

    A null or empty text has no words, and the score of features 0.
    """
    if scorer is None:
        return docs.withColumn(name, F.lit(0.0))
    model, (mean, spread, weights) = scorer

    def run(batches):
        for batch in batches:
            words = batch.column("_words")
            parts = parts_of(pc.list_value_length(words).to_numpy(zero_copy_only=False), PART_ROWS, PART_WORDS)
            for start, end in zip(parts, parts[1:]):
                x = (model.value.features(words.slice(start, end - start)) - mean) / spread
                found = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column("_doc").slice(start, end - start), pa.array(found)], names=["_doc", "_found"])

    rows = nested(docs, _words=_words(F.col("text")))
    found = rows.mapInArrow(released(run), T.StructType([rows.schema["_doc"], T.StructField("_found", T.DoubleType())]))
    return found.select(*[F.col("_doc")[column].alias(column) for column in docs.columns if column != name], F.col("_found").alias(name))


def predictions(docs, labels):
    """A row for each document: doc_id, held_out, score, predicted. Labels, lang, source and doc_id enter no score."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep(docs, labels):
    """The documents that are not predicted toxic, with all their columns."""
    scored = score(nested(docs, text=F.col("text")), train(docs, labels))
    return scored.where(F.col("score") < 0.5).select("_doc.*")
