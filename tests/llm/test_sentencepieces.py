import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.llm import sentencepieces as S

from .conftest import ODD, SF, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


HARD = [" ", "  a  b ", "▁", "a▁b ▁▁ c", " " * 15 + "x", " " * 16, " " * 33 + "y", "\n\n\t x", "<s> </s> <0x0A> <unk>",
        "aaaaaaaaaaaaaaaaaaaa hellohello", "\x00 a", "= = == ==== ======== //////// -----------------"]


def test_query_is_the_library_s(spark, library, documents):
    rows = E.queries()["op8_sentencepieces"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents)
    for r in rows:
        want = library.encode(documents[r.doc_id])
        assert list(r.ids) == want and r.n_tokens == len(want) and r.round_trip
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())


def test_odd_texts_and_decoding(spark, library):
    texts = ODD + HARD
    coded = S.encode_pieces(frame(spark, texts), PATH)
    rows = S.decode_pieces(coded, PATH, text_col="back").collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id] or "")
        assert list(r.ids) == want
        assert r.back == library.decode(want)
        assert r.round_trip
    assert S.encode_pieces(frame(spark, []), PATH).count() == 0
    none = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert S.decode_pieces(none, PATH).first().text is None


def test_order_of_words_does_not_matter():
    """States shared between words give what each word gives alone."""
    words = ["▁hello", "▁help", "▁helping", "▁hell", "▁helpé日", "▁he", "▁", "▁日本", "▁日"]
    together = S.PieceModel(PATH)
    together.learn(words)
    for w in words:
        alone = S.PieceModel(PATH)
        alone.learn([w])
        assert alone.known[w] == together.known[w]
