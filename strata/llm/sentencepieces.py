"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

The distinct marked words of a batch (a space is the mark, U+2581) are sorted,
which lays them out as the depth-first order of their trie.  The forward pass
walks that order: the states of the prefix a word shares with the one before it
are kept, only the rest is extended.

The model file is a byte-pair model, whose result is not the path with the
highest sum of piece scores, so a plain Viterbi over scores would not return
what the library returns.  The forward state used here is the one that does: for
every prefix the last piece of its merge result.  It is unique, and it is found
from shorter prefixes: a piece may follow another only if merging the two texts
together gives back exactly these two pieces.  Backtracking the states gives the
word's pieces.  Characters without a piece become byte pieces.

Words are cut before a mark that follows another character; no piece of the
model crosses such a place.  Decoding joins the pieces, turns byte pieces back
into bytes (bytes that are no UTF-8 into U+FFFD), marks into spaces, and drops
the one mark that encoding puts before the text.

Null and empty texts have no ids.  Repeated rows and null ids keep their own row.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .registry import register, table
from .shared import boxed, other_columns, quoted, unboxed
from .textkern import Remembered, giving_back

MARK = "▁"
CACHE_PAIRS = 1 << 18
SLICE_ROWS = 2048  # texts whose ids are held together
UNKNOWN = -2  # forward state after a character that has no piece
START = -1

_RUN = re.compile(" +[^ ]*")


class PieceModel:
    """Pieces of a byte-pair model and the trie pass over words."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.score = {}
        self.ids = {}
        self.bytes = {}
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.ids[p] = i
                self.score[p] = sp.get_score(i)
        self.unk = sp.unk_id()
        self.longest = max(map(len, self.ids), default=0)
        self.known = Remembered()
        self.follows: dict[tuple[int, int], bool] = {}
        # bytes each id stands for when decoding
        raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in self.bytes.items():
            raw[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                raw[i] = b""
            elif sp.is_unknown(i):
                raw[i] = " ⁇ ".encode()
        self.raw = pa.array(raw, pa.large_binary())

    def merged(self, text: str) -> list[str]:
        """Byte-pair result of a short text: best score first, then leftmost."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``right`` directly after the state ``left`` is what merging gives."""
        got = self.follows.get((left, right))
        if got is None:
            b = self.pieces[right]
            a = "" if left < 0 else self.pieces[left]
            got = self.merged(a + b) == ([a, b] if a else [b])
            if len(self.follows) > CACHE_PAIRS:
                self.follows.clear()
            self.follows[(left, right)] = got
        return got

    def learn(self, words: list[str]) -> None:
        """Ids of new words: one depth-first pass over their sorted order."""
        last, size = [START], [0]  # forward states by prefix length
        before = ""
        ids, may_follow, longest = self.ids, self.may_follow, self.longest
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1:], size[shared + 1:]
            for j in range(shared + 1, len(word) + 1):
                for k in range(max(0, j - longest), j):
                    piece = ids.get(word[k:j])
                    if piece is not None and may_follow(last[k], piece):
                        last.append(piece)
                        size.append(j - k)
                        break
                else:
                    last.append(UNKNOWN)
                    size.append(1)
            out, j = [], len(word)
            while j > 0:
                if last[j] == UNKNOWN:
                    out += [self.bytes.get(b, self.unk) for b in reversed(word[j - 1].encode())]
                else:
                    out.append(last[j])
                j -= size[j]
            self.known.learn(word, np.array(out[::-1], np.uint32).tobytes())
            before = word

    def ids_of(self, words: list[str]) -> list[bytes]:
        self.learn(self.known.unknown(dict.fromkeys(words)))
        out = [self.known[w] for w in words]
        self.known.settle()
        return out

    def words_of(self, text: str) -> list[str]:
        """Marked words of a text, runs of marks kept together with what follows."""
        if not text:
            return []
        return [w.replace(" ", MARK) for w in _RUN.findall(" " + text.replace(MARK, " "))]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and offsets of the texts."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, f"^ | $|  |{MARK}|^$").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(~odd), texts, "")
        lists = pc.split_pattern(plain, " ")
        at = np.asarray(lists.offsets, np.int64)
        coded = lists.values.dictionary_encode()
        ids = self.ids_of([MARK + w for w in coded.dictionary.to_pylist()])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), np.uint32)
        first = np.cumsum(size) - size
        word = coded.indices.to_numpy(zero_copy_only=False)
        counts = size[word]
        # the one empty piece that stands for an odd text counts nothing here
        row = np.repeat(np.arange(len(texts)), np.diff(at))
        counts[odd[row]] = 0
        run = np.concatenate(([0], np.cumsum(counts)))
        out = pool[np.repeat(first[word] - run[:-1], counts) + np.arange(run[-1])]
        offs = run[at]
        if odd.any():
            parts, lengths = [], np.diff(offs)
            for i in range(len(texts)):
                mine = out[offs[i]:offs[i + 1]]
                if odd[i]:
                    mine = np.frombuffer(b"".join(self.ids_of(self.words_of(texts[i].as_py()))), np.uint32)
                    lengths[i] = len(mine)
                parts.append(mine)
            out, offs = np.concatenate(parts), np.concatenate(([0], np.cumsum(lengths)))
        return out, offs

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[str]:
        joined = self.raw.take(pa.array(ids, pa.uint32()))
        bounds = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(ids) + 1] if len(
            ids) else np.zeros(1, np.int64)
        data = memoryview(joined.buffers()[2]) if len(ids) else memoryview(b"")
        cut = bounds[offs].tolist()
        return [bytes(data[a:b]).decode("utf-8", "replace").removeprefix(" ") for a, b in zip(cut[:-1], cut[1:])]


@functools.lru_cache(maxsize=1)
def model_of(path: str) -> PieceModel:
    """The model of a Python worker; the words it remembers are bounded by bytes, whatever the number of tasks."""
    return PieceModel(path)


_CODED = pa.struct([("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                    ("round_trip", pa.bool_())])


def encoder(path: str):
    """Arrow function: text -> ids, their number and checksum, and whether decoding gives the text back."""

    @F.arrow_udf(from_arrow_type(_CODED))
    @giving_back
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(path)
        for texts in batches:
            parts = []
            for lo in range(0, len(texts), SLICE_ROWS):
                some = texts.slice(lo, SLICE_ROWS)
                ids, offs = model.encode(some)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                back = model.decode(ids, offs)
                same = [(t or "").replace(MARK, " ") == b for t, b in zip(some.to_pylist(), back)]
                listed = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids.astype(np.int32)))
                parts.append(pa.StructArray.from_arrays(
                    [listed, pa.array(np.diff(offs)), pa.array(sums, pa.int64()), pa.array(same)], fields=list(_CODED)))
            yield pa.concat_arrays(parts) if parts else pa.array([], _CODED)

    return encode


def decoder(path: str):
    """Arrow function: ids -> text; ids that the model lacks are an error, null ids decode to null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(path)
        for lists in batches:
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.uint32)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = model.decode(flat, np.concatenate(([0], np.cumsum(counts, dtype=np.int64))))
            yield pa.array([None if not v.is_valid else t for v, t in zip(lists, texts)], pa.string())

    return decode


def encode_pieces(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ids, n_tokens, ids_crc32 (32-bit little-endian ids) and round_trip; clashing names are replaced."""
    names = [f.name for f in _CODED]
    own = other_columns(docs, *names)
    coded = docs.select(boxed(own), encoder(path)(F.col(quoted(text_col))).alias("__coded"))
    return coded.select(*unboxed(own), "__coded.*")


def decode_pieces(coded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``coded`` with the text of its ids."""
    return coded.withColumn(text_col, decoder(path)(F.col(ids_col)))


@register("op8_sentencepieces")
def op8_sentencepieces(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
