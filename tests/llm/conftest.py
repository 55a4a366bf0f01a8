import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, spans string, kept string"


def frame(spark, texts, ids=None):
    """Documents with extra columns, some of whose names clash with results."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None, None if t is None else len(t), "x", "y", "z") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def long_text(words=30000):
    return " ".join(f"w{i * 7919 % 10007}" for i in range(words))


ODD = ["", None, " ", "\n\n", "a", "a\nb\na\nb", "é ñ ü", "tab\tand\x0bmore", "same text here", "same text here", long_text(),
       "x" * 50000, "a  b   c ", "日本語 😀"]


@pytest.fixture(scope="session")
def documents():
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
