"""Spelling variants by pivotal grams.

1. Words are maximal runs of letters, counted over all texts where they lie;
   only distinct words cross a shuffle.
2. A word's bigrams are ordered from rare to frequent (how many words hold
   them; the letters allowed bound this table).  Its prefix is the first
   2 * EDITS + 1 of them, with all places of the last one.  Two that do not
   overlap and have the least sum of counts, found by dynamic programming over
   their places, are its pivots.
3. One edit spoils at most one of two disjoint pivots.  So of two near words, the
   one whose prefix ends earlier in the order has a pivot in the prefix of the
   other, and not any place will do: a bigram before the edit keeps its place, one
   behind it moves with the change in length, and what lies on the other side of it is
   the same in both words.  Pivots, copied to the six cases of (change in length,
   side of the edit), join the prefixes by bigram, place, length and that other side.
4. Pairs are verified inside the join, so no candidate that fails becomes a row:
   first by the sets of their letters (one edit changes at most two letters), then by
   the distance itself.

A word's form is its near word with the largest count, if that is at least
RATIO times its own; the root follows forms to the last one by doubling the steps
(counts grow with every step, so there are few).

Null texts have no words; a null id is written as an empty string in the hash.
Repeated rows count as often as they occur.  Ties go to the smaller word in
code-point order.  Only the id and the text of the input are read, so other
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import register, table
from .shared import landed

LETTERS = "A-Za-z\\u00C0-\\u00FF"
MIN_LENGTH = 7  # code points of a word; seven bigrams or more hold a prefix with two disjoint ones
MIN_COUNT = 2
RATIO = 10  # a form is this many times as frequent
EDITS = 1
DELETE_EVERY = 31  # occurrences whose hash this divides lose a code point
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """(doc, run): every maximal run of letters with ``min_length`` code points or more, A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("doc"), F.explode(runs).alias("run")).select(
        "doc", F.translate("run", UPPER, LOWER).alias("run"))


def noisy(doc: Column, run: Column, every: int = DELETE_EVERY) -> Column:
    """``run`` without the code point that the crc32 of "<doc>:<run>" names, where ``every`` divides the crc32."""
    h = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def prefix_and_pivots(word: str, count: dict[str, int]) -> tuple[str, list[int], list[int]]:
    """Last bigram of the prefix, places of the prefix and places of the two pivots.

    ``count`` has the words of each bigram; the order is by (count, bigram).
    """
    grams = [word[i:i + 2] for i in range(len(word) - 1)]
    order = sorted(range(len(grams)), key=lambda i: (count[grams[i]], grams[i], i))
    last = grams[order[2 * EDITS]]
    end = 2 * EDITS + 1
    while end < len(order) and grams[order[end]] == last:
        end += 1
    places = sorted(order[:end])
    # best[k]: least cost of k pivots among the places that do not overlap the next one
    cost = {p: count[grams[p]] for p in places}
    best: list[tuple | None] = [(0, ())] + [None] * (EDITS + 1)
    ready = list(best)
    held: list[tuple[int, list]] = []  # places seen, not yet usable as predecessors
    for p in places:
        while held and held[0][0] <= p - 2:
            ready = [min((o for o in pair if o is not None), default=None) for pair in zip(ready, held.pop(0)[1])]
        now: list[tuple | None] = [None] * (EDITS + 2)
        for k in range(EDITS + 1):
            if ready[k] is not None:
                now[k + 1] = (ready[k][0] + cost[p], (*ready[k][1], p))
        held.append((p, now))
    for _, now in held:
        ready = [min((o for o in pair if o is not None), default=None) for pair in zip(ready, now)]
    return last, places, list(ready[EDITS + 1][1])


def letter_set(word: str) -> int:
    """63 bits; a letter sets the one of its code point modulo 63."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 63
    return bits


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) with a < b in code-point order: distinct words exactly one edit apart.  ``words`` has a column word."""
    grams = words.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))).alias("g"))
    # letters allowed bound this table (under 100 * 100 bigrams), whatever the number of words
    count = {r["g"]: r["count"] for r in grams.groupBy("g").count().collect()}
    rank = {g: k for k, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast((count, rank))
    kind = pa.struct([("last", pa.int32()), ("places", pa.list_(pa.int32())), ("grams", pa.list_(pa.int32())),
                      ("pivots", pa.list_(pa.int32())), ("letters", pa.int64())])

    @F.arrow_udf("struct<last: int, places: array<int>, grams: array<int>, pivots: array<int>, letters: long>")
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count, rank = shared.value
        for batch in batches:
            out = []
            for word in batch.to_pylist():
                last, places, pivots = prefix_and_pivots(word, count)
                out.append((rank[last], places, [rank[word[p:p + 2]] for p in places], pivots, letter_set(word)))
            yield pa.StructArray.from_arrays([pa.array([o[c] for o in out], kind[c].type) for c in range(5)], fields=list(kind))

    signed = landed(words.select("word", F.length("word").alias("n"), keys("word").alias("k")).select("word", "n", "k.*"), "spelling-keys")
    gram, at = F.col("e.grams"), F.col("e.places")
    whole = {"before": F.expr("substring(word, 1, e.places)"), "behind": F.expr("substring(word, e.places + 3)")}

    def key(place: Column, length: Column, side: str) -> Column:
        """Bigram, place and length in the other word, and the side of the word that is the same; pairs are verified later."""
        return F.xxhash64(gram, place, length, F.lit(side), whole[side])

    prefix = signed.select("word", "n", "last", "letters", F.explode(F.arrays_zip("places", "grams")).alias("e")).select(
        F.col("word").alias("theirs"), F.col("last").alias("their_last"), F.col("letters").alias("their_letters"),
        F.explode(F.array(*(key(at, F.col("n"), side) for side in whole))).alias("key"))
    # one edit: the other word is as long, a letter longer or a letter shorter, and the edit lies on one side
    cases = [key(at + (d if side == "behind" else 0), F.col("n") + d, side) for d in (0, 1, -1) for side in whole]
    pivots = signed.select("word", "n", "last", "letters", F.explode(F.filter(
        F.arrays_zip("places", "grams"), lambda e: F.array_contains("pivots", e["places"]))).alias("e"))
    pivots = pivots.select("word", "last", "letters", F.explode(F.array(*cases)).alias("key"))
    found = pivots.join(prefix, "key").filter(
        # the pivot's word has the earlier end; of equal ends either way finds the pair
        (F.col("last") <= F.col("their_last")) & (F.col("word") != F.col("theirs"))
        & (F.bit_count(F.col("letters").bitwiseXOR(F.col("their_letters"))) <= 2 * EDITS)
        & (F.levenshtein("word", "theirs", EDITS) == EDITS))
    return found.select(F.least("word", "theirs").alias("a"), F.greatest("word", "theirs").alias("b")).distinct()


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words with their counts (word, n)."""
    pairs = landed(near_pairs(words), "spelling-pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    known = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # the largest count, then the smallest word: a struct's minimum
    best = known.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    own = words.join(best, "word", "left")
    fit = -F.col("best.order") >= ratio * F.col("n")
    own = landed(own.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fit, F.col("best.near")).alias("form"), F.when(fit, -F.col("best.order")).alias("form_n")), "spelling-forms")
    # steps from a word with a form; they double until all end at a word without one
    steps = landed(own.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not steps.join(onward, "root", "left_semi").limit(1).count():
            break
        steps = landed(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-steps")
    return own.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, delete_every: int = DELETE_EVERY) -> DataFrame:
    """Variants of the words of all texts; ``delete_every`` None leaves the runs as they are."""
    runs = occurrences(docs, id_col, text_col, min_length)
    word = F.col("run") if delete_every is None else noisy(F.col("doc"), F.col("run"), delete_every)
    words = runs.select(word.alias("word")).filter(F.length("word") >= min_length).groupBy("word").agg(
        F.count("*").alias("n")).filter(F.col("n") >= min_count)
    return variants(landed(words, "spelling-words"))


@register("op12_spelling_variants")
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
