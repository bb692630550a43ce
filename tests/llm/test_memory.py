"""Python workers keep little between tasks, and hold little at a time."""

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import collocations, common, toxicity
from footfall.llm.queries import BATCH_ROWS, ship


def test_tasks_release_memory(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    task = common.released(lambda batches: (batch + 1 for batch in batches))
    assert list(task(iter([1, 2]))) == [2, 3] and calls == [1]
    begun = task(iter([1, 2]))
    next(begun)
    begun.close()
    assert calls == [1, 1]

    def fails(batches):
        yield from batches
        raise ValueError

    with pytest.raises(ValueError):
        list(common.released(fails)(iter([1])))
    assert calls == [1, 1, 1]


def test_free_memory_goes_back():
    """What is freed between what stays in use: such holes stay with the process unless it gives them back."""
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    held = [np.ones(2000, np.int64) for _ in range(20_000)]
    del held[::2]
    full = resident()
    common.release()
    assert resident() < full - 100e6
    assert len(held) == 10_000


def test_batches_are_small(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["id"])

    ship(spark)
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS
    rows = spark.range(3 * BATCH_ROWS).coalesce(1).mapInArrow(sizes, "id long")
    assert max(row.id for row in rows.collect()) <= BATCH_ROWS


def test_gains_in_parts(monkeypatch):
    words = sorted({f"{a}{b}" for a in ("ab", "ba", "cad", "x", "žlu") for b in ("", "c", "dd", "abc", "漢")})
    counts = np.random.default_rng(3).integers(0, 4, (len(words), 2)).astype(float)
    models = toxicity.Models(words, counts)
    asked = [*words, "unknown", "abab", "q"]
    whole = models.gains(asked)
    monkeypatch.setattr(toxicity, "GAIN_WORDS", 4)
    assert (models.gains(asked) == whole).all() and len(models.gains([])) == 0


def test_hashes_in_parts(monkeypatch):
    words = ["ab", "", "abcdefgh", "žluťoučký", "漢字"]
    found = []
    for part in (1 << 18, 3):
        monkeypatch.setattr(toxicity, "HASHED", part)
        grams = toxicity.Grams(words)
        found.append([])
        for _ in range(toxicity.ORDER):
            grams.longer()
            found[-1].append(grams.ends.tolist())
    assert found[0] == found[1]


def test_scoring_workers_get_the_finished_model(docs, labels, monkeypatch):
    """One task makes the model that scores; no scoring worker needs the memory for making it."""
    (model, _) = scorer = toxicity.train(docs, labels)
    assert isinstance(model.value, toxicity.Models)

    def refused(*args):
        raise AssertionError("made again")

    monkeypatch.setattr(toxicity, "_model", refused)
    assert toxicity.score(docs, scorer).where("score between 0 and 1").count() == docs.count()


def test_phrase_tasks_release(spark, docs, monkeypatch):
    wrapped = []
    monkeypatch.setattr(collocations, "released", lambda run: wrapped.append(run) or run)
    collocations.count_words(docs, 10)
    assert len(wrapped) == 1
