import hashlib
import random

import duckdb

import __spark_entry__ as E
from strata.llm import line_dedup as L

from .conftest import ODD, SF, frame


def chunks(text):
    lines = (text or "").split("\n")
    out, now, before = [], [], 0
    for k, line in enumerate(lines):
        h = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
        now.append(line)
        if (h + 31 * before) % L.MODULUS == 0 or k == len(lines) - 1:
            out.append(now)
            now = []
        before = h
    return out


def brute(texts):
    seen, out = set(), []
    for t in texts:
        kept, gone = [], 0
        for c in chunks(t):
            body = "\n".join(c)
            if len(c) >= L.MIN_LINES and body.strip(" \n\r\t\x0b\x0c"):
                if body in seen:
                    gone += len(c)
                    continue
                seen.add(body)
            kept.append(body)
        out.append((t if gone == 0 else "\n".join(kept), gone))
    return out


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(E.oracle_sql()["op1_line_dedup"]).fetchall())
    assert sorted(map(tuple, E.queries()["op1_line_dedup"](spark, SF).collect())) == want


def test_shifted_passages(spark):
    rng = random.Random(3)
    line = lambda: " ".join(rng.choice("abcdefghij") * 3 for _ in range(6))
    passage = [line() for _ in range(40)]
    texts = []
    for _ in range(20):
        own = [line() for _ in range(rng.randrange(6))]
        texts.append("\n".join(own + passage + [line() for _ in range(rng.randrange(6))]))
    texts += ["\n\n\n\n\n", "\n\n\n\n\n", "a\nb\na\nb\na\nb\na\nb\na\nb", None, ""]
    got = {r.doc_id: (r.text, r.n_removed_lines) for r in L.line_dedup(frame(spark, texts)).collect()}
    want = brute(texts)
    assert got == dict(enumerate(want))
    assert all(gone > 25 for _, gone in want[1:20])  # boundaries fall together again after a shift


def test_odd_texts_and_repeated_rows(spark):
    many = "\n".join(f"line {k % 500} of many" for k in range(20000))
    texts = [*ODD, many]
    got = {r.doc_id: (r.text, r.n_removed_lines) for r in L.line_dedup(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute(texts)))
    pair = "\n".join(f"row {k}" for k in range(30))
    rows = L.line_dedup(frame(spark, [pair, pair, pair], [5, 5, None])).collect()
    assert sorted((r.doc_id or -1, r.n_removed_lines > 0) for r in rows) == [(-1, False), (5, True), (5, True)]
    assert rows[0].lang == "en"
    assert L.line_dedup(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = L.line_dedup(frame(spark, ["a\nb"]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
