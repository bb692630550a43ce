"""The letter models of toxicity and the Markov models of secrets against plain counting, step by step."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import secret_scan, toxicity

START, END, ORDER, DISCOUNT = "\1", "\2", toxicity.ORDER, toxicity.DISCOUNT


class Letters:
    """Kneser-Ney models of two classes, from {word: (texts of class 0, texts of class 1)}."""

    def __init__(self, words):
        raw = defaultdict(lambda: [0, 0])
        for word, counts in words.items():
            signs = START + word + END
            for p in range(1, len(signs)):
                for n in range(1, min(ORDER, p + 1) + 1):
                    for c in (0, 1):
                        raw[signs[p - n + 1:p + 1]][c] += counts[c]
        follow = defaultdict(lambda: [0, 0])  # how many letters come before a gram, in each class
        before = Counter()  # and in either
        for gram, counts in raw.items():
            before[gram[1:]] += 1
            for c in (0, 1):
                follow[gram[1:]][c] += counts[c] > 0
        self.total = {gram: follow[gram] if 1 < len(gram) < ORDER and gram[0] != START else counts for gram, counts in raw.items()}
        self.sums, self.kinds = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for gram, counts in self.total.items():
            for c in (0, 1):
                self.sums[gram[:-1]][c] += counts[c]
                self.kinds[gram[:-1]][c] += counts[c] > 0
        self.letters = {gram: 1 + before[gram] for gram in raw if len(gram) == 1}

    def gain(self, word):
        signs, logs = START + word + END, [0.0, 0.0]
        whole = sum(self.letters.values()) + 1
        for p in range(1, len(signs)):
            for c in (0, 1):
                likely = self.letters.get(signs[p], 1) / whole
                for n in range(2, min(ORDER, p + 1) + 1):
                    gram = signs[p - n + 1:p + 1]
                    context = self.sums.get(gram[:-1], [0, 0])[c]
                    share = max(self.total.get(gram, [0, 0])[c] - DISCOUNT, 0) / max(context, 1)
                    back = DISCOUNT * self.kinds[gram[:-1]][c] / context if context else 1.0
                    likely = share + back * likely
                logs[c] += math.log(likely)
        return logs[0] - logs[1]


WORD = st.text("abcé", min_size=1, max_size=9)


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(WORD, st.tuples(st.integers(0, 4), st.integers(0, 4)).filter(any), min_size=1, max_size=12),
    st.lists(WORD, min_size=1, max_size=6),
)
def test_letter_models(words, asked):
    if not all(any(counts[c] for counts in words.values()) for c in (0, 1)):
        return
    models = toxicity.Models(list(words), np.array(list(words.values()), float))
    plain = Letters(words)
    asked = [*asked, *words, "zz"]
    assert np.allclose(models.gains(asked), [plain.gain(word) for word in asked])


def test_features_of_texts():
    words = {"good": (1, 5), "bad": (6, 1), "word": (3, 3)}
    models = toxicity.Models(list(words), np.array(list(words.values()), float))
    dice = random.Random(1)
    texts = [[dice.choice(["good", "bad", "word", "other"]) for _ in range(n)] for n in (0, 1, 2, 5, 30)]
    rows = models.features(pa.array(texts, pa.list_(pa.string())))
    for text, row in zip(texts, rows):
        gains = models.gains(text).tolist()
        best = [max((sum(gains[i:i + width]) / width for i in range(len(gains))), default=0) for width in toxicity.WINDOWS]
        assert np.allclose(row, [np.mean(gains) if gains else 0, *best, math.log1p(len(text))])


# Secrets


def _free(text, spans):
    """What of each run lies in no span, twelve characters or more."""
    covered = {i for _, start, end in spans for i in range(start, end)}
    out = []
    for match in re.finditer("[A-Za-z0-9+/_=-]+", text):
        if len(match[0]) >= 12:
            start = None
            for i in range(match.start(), match.end() + 1):
                inside = i < match.end() and i not in covered
                if inside and start is None:
                    start = i
                if not inside and start is not None:
                    if i - start >= 12:
                        out.append((start, i))
                    start = None
    return out


def _transitions(run):
    codes = ["^", *(c if c in secret_scan.LETTERS else "^" for c in run)]
    return list(zip(codes, codes[1:]))


def _markov(texts):
    scanned = [(text, *secret_scan.base_spans(text)) for text in texts]
    values = {value for _, _, found in scanned for value in found}
    runs = {text[a:b] for text, spans, _ in scanned for a, b in _free(text, spans)}
    counts = [Counter(pair for one in own for pair in _transitions(one)) for own in (values, runs)]

    def gain(run, own):
        logs = []
        for number, table in enumerate(counts):
            seen = table - Counter(_transitions(run)) if number == own else table
            rows = Counter()
            for (first, _), n in seen.items():
                rows[first] += n
            size = len(secret_scan.LETTERS) + 1
            logs.append(sum(math.log((seen[a, b] + 0.5) / (rows[a] + 0.5 * size)) for a, b in _transitions(run)))
        return (logs[0] - logs[1]) / len(run)

    def shares(own, of):
        bins = Counter(min(max(math.ceil(gain(one, of) / 0.02), 0), 400) for one in own)
        return [bins[i] / len(own) for i in range(401)]

    plain, rand = shares(runs, 1), shares(values, 0)
    few = next(i for i in range(401) if sum(plain[i + 1:]) <= 1e-4)
    most = max((i for i in range(401) if sum(rand[:i + 1]) <= 0.05), default=-1)
    threshold = max(0.5, 0.02 * min(few, most))
    found = []
    for text, spans, _ in scanned:
        hits = [("markov", a, b) for a, b in _free(text, spans) if gain(text[a:b], 1) > threshold]
        found.append(sorted([*spans, *hits], key=lambda span: (span[1], secret_scan.KINDS.index(span[0]))))
    return found


def _texts():
    dice = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = lambda n: "".join(dice.choices(letters, k=n))
    words = "read write open close table index value config user group error message buffer stream window".split()
    name = lambda: dice.choice("_-/").join(dice.choices(words, k=3))
    texts = []
    for i in range(120):
        parts = [name() for _ in range(12)] + [f"token = '{secret(20)}'", "plain words here"]
        if i % 10 == 0:
            parts.append(secret(14))
        if i % 10 == 1:
            parts.append("sk-" + "".join(dice.choices("0123456789abcdef", k=16)) + "-" + secret(24))
        dice.shuffle(parts)
        texts.append(" ".join(parts))
    return [*texts, "", "é" * 20, "x" * 5000]


def test_markov_spans(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row.doc_id: [tuple(span) for span in row.spans] for row in secret_scan.find(docs).collect()}
    expected = _markov(texts)
    assert [found[i] for i in range(len(texts))] == expected
    assert sum(span[0] == "markov" for spans in expected for span in spans) >= 15


def test_the_rest_of_a_run_is_masked(spark):
    rest = "Zq8XvP2mLk9RtY7wBn4Jd6Hs3Fg5"
    texts = [*_texts(), f"key sk-0123456789abcdef-{rest} end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    last = secret_scan.redact(docs).orderBy("doc_id").collect()[-1]
    assert rest not in last.text and "0123456789abcdef" not in last.text and last.text.endswith("end")
