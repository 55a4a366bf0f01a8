"""Personal data: fixed kinds plus bootstrapped contextual extraction.

1. One scan extracts the base kinds (email, ip, card, phone) and, for every
   identifier-like token, its lexical context: the two words before it, lower
   case, digits folded.  The start of a line counts as a word, so one label is a
   context; a line that begins with the entity takes the last words of the last
   line before it that has any.  A base entity is a *seed* instance of its context, an
   unclaimed token a *candidate* instance.  Groups of one identifier (a phone, a
   card, a bank account), each a single space apart, are one token.  The result, without texts, is
   landed in the shared folder.
2. The distinct (pattern, instance) edges form a bipartite graph.  Spark scores
   it iteratively: seeds have confidence 1; a pattern's confidence is the mean
   confidence of its instances, with one imaginary instance of confidence 0
   added; an unseen instance takes the best of its patterns.  All sums are
   grouped aggregations with map-side combine.
3. Patterns with confidence >= MIN_CONFIDENCE and at least MIN_SEEDS distinct
   seed instances extract their candidates as spans of kind ``context``.
4. Instances of such patterns become seeds, with the confidence of their best
   pattern, and steps 2 and 3 are made again, until no pattern is added or
   ``HOPS`` times.

Null and empty texts have no spans.  Offsets are code points, end exclusive.
Every row keeps its own result, repeated rows and null ids included.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from .registry import register, table
from .shared import boxed, landed, other_columns, quoted, text_digest, unboxed

ROUNDS = 3
MIN_CONFIDENCE = 0.8
MIN_SEEDS = 8
MIN_TOKEN = 6  # characters of an identifier-like token

# The base kinds, in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# An identifier-like token holds a digit or an at sign; white space ends it.
TOKEN = re.compile(r"(?<!\S)\S*[0-9@]\S*")
_STRIP = ".,;:!?\"'()[]{}<>"

# Groups of one identifier stand a single space apart; the first and the last hold a digit.
_PIECE = r"(?:[0-9]+|[A-Za-z0-9]{1,4})(?![A-Za-z0-9])"
GROUP = re.compile(r"[(\[]*" + _PIECE + r"(?:[-./()\[\]]+" + _PIECE + r")*[)\]]*[-.,;:!?\"'>}]*")
LETTERS = re.compile(r"[A-Z]{2,4}(?!\S)")  # a bank's letters between the groups
_CLOSES = {"(": ")", "[": "]"}


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from the at signs so that long runs are read once."""
    out, done, at = [], 0, text.find("@")
    local = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in local:
            start -= 1
        m = EMAIL_HOST.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind and then start."""
    out = [(0, s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def words_before(text: str, end: int, n: int = 2) -> tuple[list[str], int]:
    """The last ``n`` words before ``end`` on its line, whatever their length, and where the search stopped."""
    words: list[str] = []
    while len(words) < n:
        while end > 0 and text[end - 1].isspace() and text[end - 1] != "\n":
            end -= 1
        if end == 0 or text[end - 1] == "\n":
            break
        last = end
        while end > 0 and not text[end - 1].isspace():
            end -= 1
        words.insert(0, text[end:last])
    return words, end


def context(text: str, start: int) -> int | None:
    """Pattern before ``start``: the last two words, lower case, digits folded; None where nothing is before it.

    A line end stands for the start of the line that follows it.
    """
    words, at = words_before(text, start)
    if len(words) == 1:
        words = ["\n", *words]
    elif not words:
        while at > 0 and text[at - 1].isspace():
            at -= 1
        words, _ = words_before(text, at)
        if not words:
            return None
        words = [*["\n"][:2 - len(words)], *words, "\n"]
    key = re.sub("[0-9]", "0", " ".join(words).lower())
    return xxhash.xxh64_intdigest(key) - (1 << 63)


def bare(text: str, s: int, e: int) -> tuple[int, int]:
    """A span without the punctuation around it; a bracket stays where its partner lies inside."""
    first, last = s, e
    while s < e and text[s] in _STRIP:
        s += 1
    while s < e and text[e - 1] in _STRIP:
        e -= 1
    if s > first and (close := _CLOSES.get(text[s - 1])) and text.count(close, s, e) > text.count(text[s - 1], s, e):
        s -= 1
    if e < last and (head := {v: k for k, v in _CLOSES.items()}.get(text[e])) and text.count(head, s, e) > text.count(text[e], s, e):
        e += 1
    return s, e


def runs(text: str, claimed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of identifier-like tokens outside the sorted ``claimed`` spans; groups of one identifier are one span."""
    out: list[tuple[int, int]] = []
    begin, open_until = 0, -1  # where the last run begins, and where its next group may start
    k, reach = 0, 0
    for m in TOKEN.finditer(text):
        s, e = m.span()
        a, b = bare(text, s, e)
        while k < len(claimed) and claimed[k][0] < e:
            reach = max(reach, claimed[k][1])
            k += 1
        if a >= b or reach > s:
            open_until = -1
            continue
        group = GROUP.fullmatch(text, s, e)
        if group and s == open_until:
            out[-1] = bare(text, begin, e)
        else:
            begin = s
            out.append((a, b))
        open_until = -1
        if group and text[e:e + 1] == " " and (text[e - 1].isalnum() or text[e - 1] in ")]"):
            open_until = e + 1
            if (letters := LETTERS.match(text, e + 1)) and text[letters.end():letters.end() + 1] == " ":
                open_until = letters.end() + 1
    return out


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool, int, int]]:
    """(pattern, instance, seed, start, end) of base entities and of unclaimed identifier-like tokens."""
    out = []
    claimed = sorted((s, e) for _, s, e in base)
    for s, e in claimed:
        if (p := context(text, s)) is not None:
            out.append((p, xxhash.xxh64_intdigest(text[s:e]) - (1 << 63), True, s, e))
    for s, e in runs(text, claimed):
        if e - s - text.count(" ", s, e) >= MIN_TOKEN and (p := context(text, s)) is not None:
            out.append((p, xxhash.xxh64_intdigest(text[s:e]) - (1 << 63), False, s, e))
    return out


_INSTANCE = pa.struct([("pattern", pa.int64()), ("instance", pa.int64()), ("seed", pa.bool_()), ("start", pa.int32()),
                       ("end", pa.int32())])
_FIELDS = pa.struct([*((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("base", pa.string()),
                     ("found", pa.list_(_INSTANCE))])

def scan(texts: pa.Array) -> pa.StructArray:
    texts = pc.fill_null(texts, "")
    may = pc.match_substring_regex(texts, "[0-9@]").to_numpy(zero_copy_only=False)
    rows = []
    for i, some in enumerate(may):
        text = texts[i].as_py() if some else ""
        base = base_spans(text) if some else []
        said = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
        rows.append({f"n_{k}": sum(1 for x in base if x[0] == j) for j, k in enumerate(KINDS)} | {
            "base_sha256": hashlib.sha256(said.encode()).hexdigest(), "base": said,
            "found": [dict(zip(("pattern", "instance", "seed", "start", "end"), x)) for x in instances(text, base)]})
    return pa.array(rows, _FIELDS)


@F.arrow_udf(from_arrow_type(_FIELDS))
def pii_scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield scan(texts)


def _accepted(edges: DataFrame, rounds: int, min_confidence: float, min_seeds: int) -> DataFrame:
    """(pattern, p_conf) with high confidence, from edges (pattern, instance, seed, weight); a seed's confidence is its weight."""
    score = edges.groupBy("instance").agg(F.max("weight").alias("conf"))
    for k in range(rounds):
        joined = edges.join(score, "instance")
        pats = joined.groupBy("pattern").agg(
            (F.sum("conf") / (F.count("*") + 1)).alias("p_conf"), F.sum(F.col("seed").cast("long")).alias("seeds"))
        pats = landed(pats, "pii-patterns")
        if k + 1 < rounds:
            best = edges.join(pats.filter("p_conf > 0"), "pattern").groupBy("instance").agg(
                F.max(F.when(F.col("seed"), F.col("weight")).otherwise(F.col("p_conf"))).alias("conf"))
            score = best
    good = pats.filter((F.col("p_conf") >= min_confidence) & (F.col("seeds") >= min_seeds))
    return landed(good.select("pattern", "p_conf"), "pii-good")


def _edges(found: DataFrame) -> DataFrame:
    # copies of a text add nothing: an edge counts once, as a seed if it is one anywhere
    edges = found.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    # a pattern without any seed can only reach confidence through instances seen under other patterns
    return landed(edges.withColumn("weight", F.col("seed").cast("double")), "pii-edges")


def good_patterns(found: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE,
                  min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(pattern) with high confidence and base seeds, from rows (pattern, instance, seed)."""
    return _accepted(_edges(found), rounds, min_confidence, min_seeds).select("pattern")


def bootstrapped(found: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE,
                 min_seeds: int = MIN_SEEDS, hops: int | None = None) -> DataFrame:
    """``good_patterns``, and those that instances of good patterns bring in, until there are no more (or ``hops`` are made).

    Every hop adds a pattern, and each pattern is added once, so this ends.
    """
    edges = _edges(found)
    good = _accepted(edges, rounds, min_confidence, min_seeds)
    fresh = good
    for _ in itertools.count() if hops is None else range(hops):
        # candidates of the patterns found last become seeds; their confidence is that of the best such pattern
        new = edges.filter("not seed").join(fresh, "pattern").groupBy("instance").agg(F.max("p_conf").alias("w"))
        new = landed(new, "pii-promoted")
        if not edges.join(new, "instance", "left_semi").join(good, "pattern", "left_anti").limit(1).count():
            break  # no other pattern has any of them
        edges = landed(edges.join(new, "instance", "left").select(
            "pattern", "instance", (F.col("seed") | F.col("w").isNotNull()).alias("seed"),
            F.greatest("weight", F.coalesce("w", F.lit(0.0))).alias("weight")), "pii-edges")
        fresh = landed(_accepted(edges, rounds, min_confidence, min_seeds).join(good, "pattern", "left_anti"), "pii-good")
        if not fresh.limit(1).count():
            break
        good = landed(good.union(fresh), "pii-good")
    return good.select("pattern")


def pii_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus n_email .. n_phone, base_sha256, spans, n_context.

    ``spans`` holds the base spans and the contextual ones as kind:start:end.
    Columns with these names are replaced.
    """
    results = [f.name for f in _FIELDS if f.name not in ("base", "found")] + ["spans", "n_context"]
    own = other_columns(docs, *results, text_col)
    scanned = docs.select(boxed(own), F.monotonically_increasing_id().alias("__row"), pii_scan(F.col(quoted(text_col))).alias("__f"))
    scanned = landed(scanned.select("__own", "__row", "__f.*"), "pii-scan")
    found = scanned.select("__row", F.explode("found").alias("x")).select("__row", "x.*")
    good = bootstrapped(found.select("pattern", "instance", "seed"))
    more = found.filter("not seed").join(good, "pattern", "left_semi").groupBy("__row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("more"))
    out = scanned.drop("found").join(more, "__row", "left")
    listed = F.array_join(F.transform("more", lambda x: F.concat(
        F.lit("context:"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), listed)
    return out.withColumns({
        "spans": spans,
        "n_context": F.when(F.col("more").isNull(), 0).otherwise(F.size("more")).cast("long"),
    }).select(*unboxed(own), *results)


def redact_text(text: str, spans: str) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    parts = []
    for item in filter(None, spans.split(",")):
        kind, s, e = item.split(":")
        parts.append((int(s), int(e), kind))
    for s, e, kind in sorted(parts, key=lambda x: (x[0], -x[1])):
        if s >= done:
            out += [text[done:s], f"[{kind.upper()}]"]
        done = max(done, e)
    return "".join([*out, text[done:]])


@F.arrow_udf(T.StringType())
def redacted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        yield pa.array([t if not s else redact_text(t or "", s) for t, s in zip(texts.to_pylist(), spans.to_pylist())],
                       pa.string())


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind."""
    keyed = docs.select(boxed(docs.columns), F.col(quoted(text_col)).alias("__t"), text_digest(id_col, text_col).alias("__key"))
    spans = pii_spans(keyed.select("__key", "__t"), "__t").filter("spans <> ''")
    spans = spans.groupBy("__key").agg(F.max("spans").alias("__spans"))  # equal texts have equal spans
    joined = keyed.join(spans, "__key", "left")
    text = F.when(F.col("__spans").isNull(), F.col("__t")).otherwise(redacted(F.col("__t"), F.col("__spans")))
    return joined.withColumn("__t", text).select(
        *(F.col("__t").alias(c) if c == text_col else F.col("__own").getField(c).alias(c) for c in docs.columns))


@register("op10_pii")
def op10_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_spans(docs).select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_context")
