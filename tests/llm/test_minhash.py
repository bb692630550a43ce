"""Near-duplicates against the classes of all pairs."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np

from footfall.llm import minhash
from footfall.llm.common import parts_of


def _weights(text):
    found = [word for word in re.split(r"[\x20\t-\r]+", text or "") if word]
    return Counter(tuple(found[i:i + 5]) for i in range(max(len(found) - 4, min(len(found), 1))))


def _similarity(x, y):
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x | y) for i in x.keys() & y.keys())


def _classes(rows):
    """The smallest doc_id (nulls last) of each row's class, by comparing all pairs of different texts."""
    texts = sorted({text or "" for _, text in rows})
    parent = {text: text for text in texts}

    def root(text):
        while parent[text] != text:
            text = parent[text]
        return text

    weights = {text: _weights(text) for text in texts}
    for a, b in combinations(texts, 2):
        if weights[a].keys() & weights[b].keys() and _similarity(weights[a], weights[b]) >= 0.8:
            parent[root(a)] = root(b)
    least = {}
    for doc_id, text in rows:
        own = least.setdefault(root(text or ""), doc_id)
        least[root(text or "")] = doc_id if own is None else own if doc_id is None else min(own, doc_id)
    return Counter((doc_id, least[root(text or "")]) for doc_id, text in rows)


def _found(docs):
    return Counter((row.doc_id, row.class_id) for row in minhash.dedup_classes(docs).collect())


def test_documents(docs):
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    assert _found(docs) == _classes(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(row.doc_id, row.text) for row in odd_docs.select("doc_id", "text").collect()]
    assert _found(odd_docs) == _classes(rows)
    kept = minhash.keep(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(row.doc_id for row in kept.where("doc_id is not null").collect()) == [1, 2, 4, 5]
    assert _found(no_docs) == Counter() and minhash.keep(no_docs).count() == 0


def test_large_buckets(spark):
    """Many texts about one passage, some near copies of each other: buckets beyond the pairwise ones."""
    random.seed(5)
    word = lambda: "".join(random.choices("abcdefgh", k=6))
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(150):
        rows.append((i, " ".join(passage + [word() for _ in range(25)])))
    for i in range(150, 190):
        words = rows[i - 150][1].split()
        words[random.randrange(62, len(words))] = word()
        rows.append((i, " ".join(words)))
    base = [word() for _ in range(120)]
    for i in range(190, 290):  # near copies of one text, not all of each other
        words = list(base)
        for _ in range(2):
            words[random.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(docs) == _classes(rows)


def test_similarity_and_signatures():
    random.seed(2)
    for _ in range(100):
        x, y = (Counter({random.randrange(15): random.randrange(1, 5) for _ in range(10)}) for _ in range(2))
        arrays = [f for c in (x, y) for f in (np.array(sorted(c), np.uint64), np.array([c[i] for i in sorted(c)]))]
        assert abs(minhash.similarity(*arrays) - _similarity(x, y)) < 1e-12
    shares = []
    for seed in range(8):
        x = Counter({seed * 1000 + i: 1 + i % 3 for i in range(100)})
        y = Counter({i: n for i, n in x.items() if i % 5} | {-seed * 1000 - i - 1: 2 for i in range(20)})
        values = minhash.mix(np.array([*x, *y], np.int64).view(np.uint64))
        of = np.repeat([0, 1], [len(x), len(y)])
        one, two = minhash.signatures(of, values, np.array([*x.values(), *y.values()]), 2, 1024)
        shares.append((one == two).mean() - _similarity(x, y))
    assert abs(np.mean(shares)) < 0.02


def test_bound_at_the_first_shared_shingle():
    """No pair is more similar than its first shared shingle lets it be, in any order of the shingles."""
    dice = random.Random(4)
    for _ in range(3000):
        x, y = (Counter({dice.randrange(12): dice.choice([1, 1, 2, 7]) for _ in range(dice.randint(1, 9))}) for _ in range(2))
        shared = sorted(x.keys() & y.keys())
        if shared:
            u, v = (sum(n for i, n in c.items() if i < shared[0]) / sum(c.values()) for c in (x, y))
            assert _similarity(x, y) <= (1 - u) * (1 - v) / (1 - u * v) + 1e-12
            x, y = Counter(x.keys()), Counter(y.keys())
            most = min(sum(i >= shared[0] for i in c) for c in (x, y))
            assert _similarity(x, y) <= most / (len(x) + len(y) - most) + 1e-12


def test_parts_are_bounded():
    lengths = np.array([3, 2000, 5, 900, 200, 0], np.int64)
    assert parts_of(lengths, 500, 1000) == [0, 1, 2, 4, 6]
    assert parts_of(np.zeros(1200, np.int64), 500, 1000) == [0, 500, 1000, 1200]
    assert parts_of(np.zeros(0, np.int64), 500, 1000) == [0]


def test_many_texts_with_one_passage(spark):
    """5,000 texts share a passage that puts them into common buckets; every tenth has a near copy."""
    dice = random.Random(6)
    word = lambda: "".join(dice.choices("abcdefgh", k=7))
    passage = [word() for _ in range(60)]
    rows, expected = [], Counter()
    for i in range(5000):
        own = [word() for _ in range(20)]
        rows.append((i, " ".join(passage + own)))
        expected[(i, i)] += 1
        if i % 10 == 0:
            rows.append((10_000 + i, " ".join(passage + own[:-1] + [word()])))
            expected[(10_000 + i, i)] += 1
    assert _found(spark.createDataFrame(rows, "doc_id long, text string")) == expected


def test_classes_grow_by_further_links(spark):
    dice = random.Random(9)
    ids = list(range(60))
    parent = {i: i for i in ids}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    classes = spark.createDataFrame([(i, i) for i in ids], "id long, class long")
    for links in ([(i, i + 1) for i in range(20)], [(dice.choice(ids), dice.choice(ids)) for _ in range(12)], [], [(59, 0), (0, 59)]):
        for a, b in links:
            parent[max(root(a), root(b))] = min(root(a), root(b))
        classes = minhash.joined(classes, spark.createDataFrame(links, "a long, b long"))
        assert {row.id: row["class"] for row in classes.collect()} == {i: root(i) for i in ids}


def test_rounds_end_when_nothing_joins(spark, monkeypatch):
    """Texts that only share a passage: their first round joins none, so there is no second."""
    dice = random.Random(7)
    word = lambda: "".join(dice.choices("abcdefgh", k=7))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join(passage + [word() for _ in range(25)])) for i in range(40)]
    seeds, met = [], minhash._met
    monkeypatch.setattr(minhash, "_met", lambda held, seed: seeds.append(seed) or met(held, seed))
    assert _found(spark.createDataFrame(rows, "doc_id long, text string")) == _classes(rows)
    assert seeds == [0]


def test_one_step_reaches_only_what_links_reach(spark):
    links = [(i, i + 1) for i in range(9)] + [(20, 22), (21, 22), (30, 31)]
    found = {row.id: row.to for row in minhash._hooked(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found.keys() == {i for link in links for i in link}
    assert all(to <= id and to // 10 == id // 10 for id, to in found.items())
    assert found[2] == 0 and found[22] == found[20] == 20 and found[31] == 30


def test_copies_of_one_text_meet_at_a_hub(spark, monkeypatch):
    """Near copies of one text that are not near to each other: pairs in proportion to the texts, not to their square."""
    dice = random.Random(11)
    word = lambda: "".join(dice.choices("abcdefgh", k=7))
    base = [word() for _ in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 181):
        words = list(base)
        for _ in range(1 + (i > 140)):
            words[dice.randrange(5, 55)] = word()
        rows.append((i, " ".join(words)))
    crossed, crossing = [], minhash._crossing

    def counted(rows, key, more=()):
        pairs = crossing(rows, key, more)
        if more:
            crossed.append(pairs.count())
        return pairs

    monkeypatch.setattr(minhash, "_crossing", counted)
    assert _found(spark.createDataFrame(rows, "doc_id long, text string")) == _classes(rows)
    assert len(crossed) == 1 and crossed[0] < 10 * len(rows), crossed


def test_viable_rows_keep_every_pair(spark):
    dice = random.Random(12)
    rows = []
    for id in range(150):
        whole, plain, own = dice.randint(5, 60), dice.random() < 0.7, dice.randrange(40)
        rows += [(id, own, shingle, dice.choice([0.0, dice.random() * 0.2]), whole, plain) for shingle in dice.sample(range(60), 4)]
    rare = spark.createDataFrame(rows, "id long, class long, shingle long, share double, whole long, plain boolean")
    viable = minhash._viable(rare, 0.8)
    pairs = lambda rows: Counter(minhash._crossing(rows, "shingle", ("share", "whole", "plain")).where(minhash._within(0.8)).collect())
    assert pairs(viable) == pairs(rare) and pairs(rare)
    assert viable.count() < rare.count()


def test_copies_of_a_hub(spark, monkeypatch):
    """A hub of many texts is copied; each text meets one copy, whatever the number."""
    rows = [(id, id, 1, 0.0 if id == 3 else 0.05, 60, True) for id in range(50)]
    rare = spark.createDataFrame(rows, "id long, class long, shingle long, share double, whole long, plain boolean")
    monkeypatch.setattr(minhash, "STRETCH", 10)
    pairs, copies = minhash._hubs(rare, 0.8)
    found = pairs.collect()
    assert sorted(row.a for row in found) == list(range(50)) and all(row.b == 3 for row in found if row.a != 3)
    assert {row.copy for row in found if row.b == 3} == set(range(5))
    assert {(row.b, row.copy) for row in found} == {tuple(row) for row in copies.collect()}


def test_buckets_follow_the_words():
    """Few texts get few buckets, whatever the number of partitions; many get one for each partition."""
    assert minhash._bucket_count(0, 211, 6) == 6
    assert minhash._bucket_count(20 * minhash.BUCKET_WORDS - 1, 211, 6) == 20
    assert minhash._bucket_count(106 * minhash.BUCKET_WORDS, 211, 6) == 211
    assert minhash._bucket_count(10**12, 211, 6) == 211
    assert minhash._bucket_count(5, 8, 6) == 8 and minhash._bucket_count(5, 4, 64) == 4


def test_narrow_shuffles_end_in_few_tasks(spark):
    """Between the shuffles that pair texts there are as many tasks as cores; only the last result has all partitions."""
    many = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in many}
    context = spark.sparkContext
    rows = [(id, id % 5, 10, id) for id in range(50)]
    try:
        for key, value in many.items():
            spark.conf.set(key, value)
        context.setJobGroup("minhash-tasks", "")
        met = minhash._met(spark.createDataFrame(rows, "id long, band long, n long, class long"), 0).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    assert met
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(id) for id in tracker.getJobIdsForGroup("minhash-tasks")]
    stages = [tracker.getStageInfo(id) for id in sorted({id for job in jobs for id in job.stageIds})]
    sizes = [stage.numTasks for stage in stages if stage is not None and stage.numCompletedTasks]
    assert len(sizes) >= 4 and sum(n >= 61 for n in sizes) == 1, sizes
