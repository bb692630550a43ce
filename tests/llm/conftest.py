import pytest

from footfall.llm.queries import BYTE_BPE

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000 + "end"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, slot int, _stats int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and very long texts, repeated rows, and columns whose names the operators use."""
    rows = [
        (1, "One two three four five six. One two three.", "en", "a", 5, "x", 1, 1),
        (1, "One two three four five six. One two three.", "en", "a", 5, "x", 1, 1),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, "x", 1, 1),
        (None, " \t\n ", "de", "b", 4, "x", 1, 1),
        (None, None, "de", "b", 4, "x", 1, 1),
        (4, LONG, "fr", "b", 4, "x", 1, 1),
        (5, "password = 'abcdef0123456789' <|endoftext|>  two  spaces\n\nŽluťoučký 漢字 🙂", "fr", "b", 4, "x", 1, 1),
        (6, "One two three four five six. One two three.", "en", "b", 4, "x", 1, 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)
