"""The stages one after another, each held against what its operator says of its input."""

from collections import Counter

import corpus_pipeline
from footfall.llm import minhash, quality, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark, docs, labels):
    at = docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "near_copies", "secrets", "packing"]
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        at = _stored(spark, stage(spark, at, SF))
        results[name] = at
        if name != "packing":
            assert at.columns == docs.columns
    ids = {name: {row.doc_id for row in df.select("doc_id").collect()} for name, df in results.items()}
    assert ids["quality"] == {row.doc_id for row in quality.verdicts(docs, labels).where("kept").collect()}
    toxic = {row.doc_id for row in toxicity.predictions(results["quality"], labels).where("predicted = 1").collect()}
    assert ids["toxicity"] == ids["quality"] - toxic
    assert ids["near_copies"] == {row.doc_id for row in minhash.dedup_classes(results["toxicity"]).where("is_kept").collect()}
    assert ids["secrets"] == ids["near_copies"] == ids["packing"]
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(whole.columns) == sorted(results["packing"].columns) and whole.count() == results["packing"].count()


def test_empty(spark, no_docs):
    at = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        at = _stored(spark, stage(spark, at, SF))
        assert at.count() == 0


def _stored(spark, df):
    from footfall.session import write_shared

    return write_shared(df, "stage")


CLASHING = "_stats kept base_failed stratum cutoffs _cutoffs _stratum _text _words _score score _found _doc class id leader _kept_id _kept_text last base runs spans"


def test_odd_tables_and_names_that_stages_use(spark, odd_docs, docs, labels):
    """Each of the filtering stages gives back rows of its input as they were, whatever the columns are called."""
    from pyspark.sql import functions as F

    own = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    wide = own.unionByName(docs.limit(60).select(own.columns))
    for i, name in enumerate(CLASHING.split()):
        wide = wide.withColumn(name, F.lit(f"{name} {i}"))
    wide = _stored(spark, wide)
    given = Counter(map(tuple, wide.collect()))
    sizes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, wide, SF)
        assert found.columns == wide.columns and [f.dataType for f in found.schema] == [f.dataType for f in wide.schema]
        rows = Counter(map(tuple, found.collect()))
        if name == "secrets":
            index = wide.columns.index
            strip = lambda row: tuple(v for i, v in enumerate(row) if i not in (index("text"), index("n_chars")))
            assert Counter(map(strip, rows.elements())) == Counter(map(strip, given.elements()))
        else:
            assert rows <= given
        sizes[name] = sum(rows.values())
    assert 0 < sizes["quality"] < sizes["near_copies"] < sizes["secrets"] == sum(given.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, wide, SF)
    whole = pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert whole.where("n % doc_tokens <> 0").isEmpty() and whole.agg(F.sum("n")).first()[0] > 30_000
