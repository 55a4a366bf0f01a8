"""Token counts: batch encoding inside Arrow functions that returns lengths only.

Texts are cut at *safe boundaries*: a single space between two characters that
are not white space.  The byte-level pre-tokeniser never joins across such a
space (a token may only begin with it), so the counts of the cut pieces add up
to the count of the whole text.  All pieces of a batch are dictionary encoded,
each distinct piece is encoded once, in calls of a bounded number of bytes, and
the lengths are summed back by text.  A text of any length is therefore handled
in small calls, and nothing is truncated.

Null text counts as empty.  Repeated rows and null ids keep their own row.
Columns of the input with the names of the results are replaced.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import register, table
from .textkern import Remembered

CALL_BYTES = 1 << 20  # bytes handed to the encoder in one call
LIMIT = 1024

_SAFE = re.compile(r"(?<=\S) (?=\S)")
# White space next to a space, or a space at an end: such a text is cut by the exact pattern above.
_UNSAFE = r"^ | $| [\s\p{Z}\x1c-\x1f\x{85}]|[\s\p{Z}\x1c-\x1f\x{85}] "


class PieceCounter:
    """Token counts of texts by way of their distinct pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = Remembered()

    def encode_lengths(self, pieces: list[str]) -> None:
        """Count pieces that are new, in calls balanced by bytes."""
        call, size = [], 0
        for p in pieces:
            call.append(p)
            size += len(p) if p.isascii() else len(p.encode())
            if size >= CALL_BYTES:
                self._call(call)
                call, size = [], 0
        self._call(call)

    def _call(self, call: list[str]) -> None:
        if call:
            got = self.tokenizer.encode_batch_fast(call, add_special_tokens=False)
            for p, e in zip(call, got):
                self.known.learn(p, len(e))

    def lengths(self, distinct: list[str]) -> np.ndarray:
        self.encode_lengths(self.known.unknown(dict.fromkeys(distinct)))
        out = np.fromiter((self.known[p] for p in distinct), np.int64, len(distinct))
        self.known.settle()
        return out

    def counts(self, texts: pa.Array) -> np.ndarray:
        texts = pc.fill_null(texts, "")
        out = np.zeros(len(texts), np.int64)
        odd = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False).astype(bool)
        plain = np.flatnonzero(~odd)
        if len(plain):
            lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
            offs = np.asarray(lists.offsets, np.int64)
            flat = lists.values
            heads = np.zeros(len(flat), bool)
            heads[offs[:-1]] = True  # the first piece of a text has no space before it
            total = np.zeros(len(flat), np.int64)
            for mask, prefix in ((heads, ""), (~heads, " ")):
                at = np.flatnonzero(mask)
                if len(at):
                    coded = flat.take(pa.array(at)).dictionary_encode()
                    n = self.lengths([prefix + p for p in coded.dictionary.to_pylist()])
                    total[at] = n[coded.indices.to_numpy(zero_copy_only=False)]
            sums = np.concatenate(([0], np.cumsum(total)))
            out[plain] = sums[offs[1:]] - sums[offs[:-1]]
        for i in np.flatnonzero(odd):
            text = texts[int(i)].as_py()
            parts = _SAFE.split(text)
            parts[1:] = [" " + p for p in parts[1:]]
            out[i] = int(self.lengths(parts).sum())
        return out


def counter(path: str):
    """Arrow function: text -> number of tokens."""

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = PieceCounter(path)
        for texts in batches:
            yield pa.array(pieces.counts(texts), pa.int64())

    return n_tokens


def token_counts(docs: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit); no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumn("n_tokens", counter(path)(text))
    return counted.withColumns({
        "n_bytes": F.octet_length(text).cast("long"),
        "over_limit": F.col("n_tokens") > F.lit(limit),
    })


@register("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")
