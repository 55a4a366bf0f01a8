import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from strata.llm.token_counts import token_counts

from .conftest import ODD, SF, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts_are_the_library_s(spark, library, documents):
    got = {r.doc_id: r for r in E.queries()["op2_token_counts"](spark, SF).collect()}
    assert set(got) == set(documents)
    for i, t in documents.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 1024)


def test_odd_texts(spark, library):
    texts = ODD + ["a<|endoftext|> b", "end \n start", "  lead", "trail  ", "don't 12 34's", "\x1c a \x1d b", "a　 b"]
    rows = token_counts(frame(spark, texts, [None] * len(texts)), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert r.lang == "en" and r.spans == "y"


def test_empty_table(spark):
    out = token_counts(frame(spark, []), PATH)
    assert out.count() == 0 and out.schema["n_tokens"].dataType.typeName() == "long"
