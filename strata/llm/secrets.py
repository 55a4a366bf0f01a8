"""Secret scans with multipart credential linking.

Strong kinds (assign, access, hex) follow fixed patterns.  Beside them, weak
parts are collected: access identifiers (user names, client or key ids),
secrets that are too short or too plain to stand alone, and endpoints (URLs,
hosts).  A weak part says little by itself; it is reported only when its
complements occur near it.  Parts are linked by an interval join: the interval
of a weak part is its scope, a paragraph (text between blank lines) of any length,
and is joined with the starts of the complementary parts of the same text and
scope.  The join is one sorted ``searchsorted`` over a whole Arrow batch, so its
cost is n log n in the parts and no pairs are written out.

A URL with user information (``scheme://user:secret@host``) is an endpoint that
holds an access identifier and a secret.

A keyword may stand behind a prefix (``aws_``, ``DB_``) and before one of a few
suffixes (``_id``, ``_url``); the span begins at the keyword.

* a weak secret is reported when an access identifier and an endpoint fall in
  its interval;
* an access identifier is reported when such a linked secret, or a strong
  secret, and an endpoint fall in its interval.

A base span of kind access is an access identifier too: it completes weak
secrets, is no strong secret, and is not reported a second time.

Null and empty texts have no spans.  Offsets are code points, end exclusive.
Repeated rows are scanned row by row; every row keeps its own result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .registry import register, table
from .shared import boxed, other_columns, quoted, unboxed
from .textkern import utf8


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base kinds, in their order, and their patterns.
BASE_KINDS = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile(
    "(" + "|".join(_either(k) for k in KEYWORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Weak parts; the value is group 1 where there is one.  An underscore may precede a keyword, a letter or digit may not.
_HEAD = r"(?<![^\W_])"
_ID_WORDS = r"(?:access_?key_?id|access_?id|client_?id|key_?id|user_?name|user|uid|login|account)(?:[\x20_-](?:id|name|e?mail|[0-9]+))*"
_SECRET_WORDS = (r"(?:pass|pwd|passphrase|passcode|key|auth|credential|cred|pin|signature)"
                 r"(?:[_-](?:value|string|data|b64|base64|[0-9]+))*")
_END_WORDS = (r"(?:host|hostname|endpoint|server|url|uri|database)"
              r"(?:[_-](?:url|uri|host|hostname|name|addr|address|endpoint|server|[0-9]+))*")
IDENTIFIER = re.compile(
    _HEAD + "(?i:" + _ID_WORDS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""")
WEAK_SECRET = re.compile(
    _HEAD + "(?i:" + _SECRET_WORDS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{4,})""")
ENDPOINT = re.compile(
    r"""\b[a-z][a-z0-9+.-]{1,10}://[^\s"'<>]+|""" + _HEAD + "(?i:" + _END_WORDS
    + r""")["']?\x20*[:=]\x20*["']?[A-Za-z0-9./:_-]{3,}""")
USER_INFO = re.compile(r"""\b[a-z][a-z0-9+.-]{1,10}://([^\s:/@?#"'<>]+):([^\s/@?#"'<>]+)@""")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")

# One automaton pass tells which texts can hold an assignment or weak part at all.
_MAYBE_ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]"
_MAYBE_WEAK = "(?i)" + _ID_WORDS + r"[\"']? *[:=]|://[^\s:/@]+:[^\s/@]+@"

_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True


def hex_runs(data: np.ndarray, offs: np.ndarray, least: int = MIN_HEX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end byte) of maximal runs of [0-9a-f] with ``least`` bytes or more."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = _IS_HEX[data]
    heads = np.zeros(n + 1, bool)
    heads[offs] = True  # a run never crosses from one text into the next
    first = inside.copy()
    first[1:] &= ~inside[:-1] | heads[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | heads[1:n]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    keep = e - s >= least
    s, e = s[keep], e[keep]
    row = np.searchsorted(offs, s, "right") - 1
    return row, s - offs[row], e - offs[row]


def within(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Interval join: whether any of the sorted ``keys`` lies in [lo, hi)."""
    return np.searchsorted(keys, hi, "left") > np.searchsorted(keys, lo, "left")


_PART = np.dtype([("row", np.int64), ("start", np.int64), ("end", np.int64), ("lo", np.int64), ("hi", np.int64)])


def weak_parts(row: int, text: str) -> tuple[list, list, list]:
    """Identifiers, weak secrets and endpoints of a text, each with its scope as its interval."""
    ids, secrets, ends = [], [], []
    cuts = [0, *(m.end() for m in PARAGRAPH.finditer(text)), len(text)]
    for pattern, *to in ((IDENTIFIER, (0, ids)), (WEAK_SECRET, (0, secrets)), (ENDPOINT, (0, ends)),
                         (USER_INFO, (1, ids), (2, secrets))):
        at = 0
        for m in pattern.finditer(text):
            while cuts[at + 1] <= m.start() and at + 2 < len(cuts):
                at += 1
            for group, parts in to:
                parts.append((row, *m.span(group), cuts[at], cuts[at + 1]))
    return ids, secrets, ends


def link(ids: list, weak: list, strong: list, ends: list) -> tuple[np.ndarray, np.ndarray]:
    """Masks over ``weak`` secrets and ``ids``: those whose complements occur in their intervals."""
    i, w, s, e = (np.array(x, _PART) for x in (ids, weak, strong, ends))
    stride = 1 + max([max(int(x["hi"].max()), int(x["start"].max())) for x in (i, w, s, e) if len(x)], default=0)
    key = lambda x: np.sort(x["row"] * stride + x["start"])
    near = lambda x, keys: within(keys, x["row"] * stride + x["lo"], x["row"] * stride + x["hi"])
    linked = near(w, key(i)) & near(w, key(e))
    holders = key(np.concatenate([w[linked], s]))
    return linked, near(i, holders) & near(i, key(e))


def uncovered(parts: list, spans: list) -> list:
    """Those of ``parts`` (start, kind, end) that lie in none of the sorted ``spans``."""
    if not parts or not spans:
        return parts
    starts = [x[0] for x in spans]
    reach = np.maximum.accumulate([x[2] for x in spans])
    at = np.searchsorted(starts, [x[0] for x in parts], "right") - 1
    return [x for x, k in zip(parts, at) if k < 0 or reach[k] < x[2]]


def scan(texts: pa.Array) -> dict[str, list]:
    """Spans of each text: counts of the base kinds, digest of the base spans, all spans."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    base: list[list[tuple[int, int, str]]] = [[] for _ in range(n)]
    has = lambda p: np.flatnonzero(pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False))
    for r in has(_MAYBE_ASSIGN):
        for m in ASSIGN.finditer(texts[int(r)].as_py()):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                base[r].append((m.start(), 0, m.end()))
    for r in np.flatnonzero(pc.match_substring(texts, "AKIA").to_numpy(zero_copy_only=False)):
        for m in ACCESS.finditer(texts[int(r)].as_py()):
            if m.end() - m.start() >= MIN_ACCESS:
                base[r].append((m.start(), 1, m.end()))
    data, offs = utf8(texts)
    rows, s, e = hex_runs(data, offs)
    for r in np.unique(rows):
        mine = slice(*np.searchsorted(rows, (r, r + 1)))
        later = np.cumsum((data[offs[r]:offs[r + 1]] & 0xC0) == 0x80)  # bytes that begin no code point
        p = s[mine] - later[s[mine]]
        base[r] += [(int(a), 2, int(b)) for a, b in zip(p, p + (e - s)[mine])]

    ids, weak, ends, strong, access = [], [], [], [], []
    for r in sorted({*has(_MAYBE_WEAK).tolist(), *(r for r in range(n) if any(k == 1 for _, k, _ in base[r]))}):
        a, b, c = weak_parts(r, texts[r].as_py())
        ids += a
        weak += b
        ends += c
        strong += [(r, s, e, s, e) for s, k, e in base[r] if k != 1]
        access += [(r, s, e, s, e) for s, k, e in base[r] if k == 1]
    taken: dict[int, list] = {}
    linked, named = link(ids + access, weak, strong, ends)  # ids come first: only they are reported below
    for kind, parts, mask in (("weak_secret", weak, linked), ("weak_id", ids, named)):
        for k in np.flatnonzero(mask[:len(parts)]):
            r, s, e = parts[k][:3]
            taken.setdefault(r, []).append((s, kind, e))

    out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": [], "n_weak": []}
    for r in range(n):
        spans = sorted(base[r])
        named_spans = [f"{BASE_KINDS[k]}:{s}:{e}" for s, k, e in spans]
        for k, col in enumerate(("n_assign", "n_access", "n_hex")):
            out[col].append(sum(1 for x in spans if x[1] == k))
        out["base_sha256"].append(hashlib.sha256(",".join(named_spans).encode()).hexdigest())
        # a weak part that a base span covers is already reported
        extra = uncovered(taken.get(r, []), spans)
        every = sorted([(s, k, BASE_KINDS[k], e) for s, k, e in spans]
                       + [(s, 3 if kind == "weak_secret" else 4, kind, e) for s, kind, e in extra])
        out["spans"].append(",".join(f"{kind}:{s}:{e}" for s, _, kind, e in every))
        out["n_weak"].append(len(extra))
    return out


_FIELDS = pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                     ("base_sha256", pa.string()), ("spans", pa.string()), ("n_weak", pa.int64())])


@F.arrow_udf(from_arrow_type(_FIELDS))
def secret_spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        found = scan(texts)
        yield pa.StructArray.from_arrays([pa.array(found[f.name], f.type) for f in _FIELDS], fields=list(_FIELDS))


def secret_scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256, spans and n_weak (clashing names are replaced); no shuffle."""
    names = [f.name for f in _FIELDS]
    own = other_columns(docs, *names)
    found = docs.select(boxed(own), secret_spans(F.col(quoted(text_col))).alias("__found"))
    return found.select(*unboxed(own), *[F.col("__found")[c].alias(c) for c in names])


@register("op9_secret_scan")
def op9_secret_scan(spark, sf_dir):
    return secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
