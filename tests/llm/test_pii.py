import hashlib
import re

import __spark_entry__ as E
from strata.llm import pii as P

from .conftest import ODD, SF, frame


def luhn(x):
    total = 0
    for k, c in enumerate(x[::-1]):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(t):
    t = t or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    spans = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    spans += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
              if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split("."))]
    spans += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
              if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]
    return [f"{P.KINDS[k]}:{s}:{e}" for k, s, e in spans]


HARD = ["a@b.c@d.e x@y z@@q.r.s -@-.-", "1.2.3.4.5 256.1.1.1 01.002.3.255 1.1.1.1.1.1.1.1", "4111 1111 1111 1111",
        "4111-1111-1111-1112 4111111111111111 4111 1111  1111 1111", "+1 (372) 555-7739 +12 +1((( 5 +49.30.123456789012345",
        " \x1fé foo@bar.com.", "+4915112345678x", "é 10.0.0.1é", "@a.b", "a.b@c..d a@b.c.", "0" * 5000 + ".1.1.1"]


def check(row, text):
    want = base(text)
    assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert [row[f"n_{k}"] for k in P.KINDS] == [sum(w.startswith(k) for w in want) for k in P.KINDS]
    every = row.spans.split(",") if row.spans else []
    assert every[:len(want)] == want and len(every) == len(want) + row.n_context


def test_query(spark, documents):
    rows = E.queries()["op10_pii"](spark, SF).collect()
    assert len(rows) == len(documents)
    for r in rows:
        check(r, documents[r.doc_id])


def test_odd_texts(spark):
    texts = ODD + HARD + ["7" * 20000, "a@" * 20000, "+1" + "(" * 20000]
    rows = P.pii_spans(frame(spark, texts, range(len(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        check(r, texts[r.doc_id])
    again = P.pii_spans(frame(spark, ["x 10.0.0.1", "x 10.0.0.1"], [None, None])).collect()
    assert [r.n_ip for r in again] == [1, 1]
    assert P.pii_spans(frame(spark, [])).count() == 0


def contexts():
    seeds = [f"please write mail to user{i}@site{i}.org today" for i in range(20)]
    hidden = ["please write mail to handle_77@intranet today", "please write mail to acct-990817 now"]
    plain = [f"the lot number is B-{i}00{i}77 here" for i in range(20)] + ["please write mail to someone soon"]
    return seeds, hidden, plain


def test_patterns_discover_unseen_identifiers(spark):
    seeds, hidden, plain = contexts()
    texts = seeds + hidden + plain
    got = {r.doc_id: r.spans for r in P.pii_spans(frame(spark, texts)).collect()}
    k = len(seeds)
    assert got[k] == "context:21:39" and got[k + 1] == "context:21:32"
    assert all(got[i] == "" for i in range(k + 2, len(texts)))


def test_copies_do_not_make_a_pattern(spark):
    seeds, hidden, _ = contexts()
    texts = [seeds[0]] * 20 + hidden  # one seed instance, however often it is copied
    assert all(r.n_context == 0 for r in P.pii_spans(frame(spark, texts)).collect())


def score_by_hand(edges, rounds):
    conf = {i: max(float(s) for _, j, s in edges if j == i) for _, i, _ in edges}
    for k in range(rounds):
        pats = {}
        for p in {e[0] for e in edges}:
            mine = [conf.get(i) for q, i, _ in edges if q == p and i in conf]
            if mine:
                pats[p] = (sum(mine) / (len(mine) + 1), sum(s for q, i, s in edges if q == p and i in conf))
        conf = {}
        for p, i, s in edges:
            if pats.get(p, (0, 0))[0] > 0:
                conf[i] = max(conf.get(i, 0), 1.0 if s else pats[p][0])
    return {p for p, (c, n) in pats.items() if c >= 0.5 and n >= 2}


def test_graph_scores_against_a_plain_loop(spark):
    import random
    rng = random.Random(8)
    edges = sorted({(p, i): (p, i, rng.random() < 0.5) for p, i in
                    ((rng.randrange(8), rng.randrange(30)) for _ in range(90))}.values())
    rows = spark.createDataFrame(edges * 2, "pattern long, instance long, seed boolean")
    got = {r.pattern for r in P.good_patterns(rows, 3, 0.5, 2).collect()}
    assert got == score_by_hand(edges, 3)


def test_redaction(spark):
    texts = ["mail a@b.co and +1 (372) 555-7739.", None, "none", "1.2.3.4"]
    got = {r.doc_id: r.text for r in P.redact(frame(spark, texts)).collect()}
    assert got == {0: "mail [EMAIL] and [PHONE].", 1: None, 2: "none", 3: "[IP]"}


def found(text):
    return [text[s:e] for *_, s, e in P.instances(text, P.base_spans(text))]


def test_groups_of_one_identifier_are_one_instance():
    for x in ("(555) 010-4477", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "123 45 6789",
              "4111 1111 1111 1112", "[555]010 4477", "12 34 56", "acct-990817", "(555)010-4477"):
        for text in (f"please call at {x} today", f"please call at {x}", f"please call at ({x}), or", f"please call at {x}. 12"):
            assert found(text) == [x], text
    assert found("call me at 12 34") == [] and found("in the year 2019 3 times") == []
    assert found("a b 1234567, 7654321 c") == ["1234567", "7654321"]
    assert found("a b AB123456 2 of these") == ["AB123456"]
    assert found("a b handle_77@intranet 55 c") == ["handle_77@intranet"]
    assert found("a b 123 45\n6789 c") == [] and found("a b 123  45  6789") == []
    assert found("mail to x@y.org 12 34 56 now") == ["x@y.org", "12 34 56"]
    assert len(found("a b " + "(1 2 " * 20000)) <= 20000


def test_a_phone_without_plus_is_found(spark):
    seeds = [f"for help please call +1 ({200 + i}) 555-77{10 + i} today" for i in range(20)]
    hidden = ["for help please call (555) 010-4477 today", "for help please call 123 45 6789."]
    got = {r.doc_id: r.spans for r in P.pii_spans(frame(spark, seeds + hidden)).collect()}
    assert [got[20], got[21]] == ["context:21:35", "context:21:32"]


def test_a_label_on_a_line_is_a_context():
    at = lambda text: P.context(text, text.index("X"))
    assert at("Phone: X") == at("name: bob\n  phone:  X") == at("9 lines\r\nPhone: X") is not None
    assert at("Phone: X") not in (at("the Phone: X"), at("Fax: X"), at("Phone:\nX"))
    assert at("E-mail\nX") == at("name\ne-mail\r\n\r\n  X") is not None
    assert at("your work mail\nX") == at("a b\nthe work mail\nX") != at("work mail X")
    assert at("X") is None and at("\n \nX") is None
    assert at("a" * 200 + " X") == at("b\n" + "a" * 200 + " X") is not None and at("a" * 200 + "\nphone: X") == at("phone: X")


def test_fields_of_forms_are_found(spark):
    seeds = [f"Name: someone\nPhone: +1 ({200 + i}) 555-77{10 + i}\nContact\nuser{i}@site{i}.org\n" for i in range(20)]
    hidden = ["Phone: 555-010-4477\nStreet: none", "Contact\nhandle_77@intranet", "Lot: B-1001077"]
    got = {r.doc_id: r.spans for r in P.pii_spans(frame(spark, seeds + hidden)).collect()}
    assert [got[20], got[21], got[22]] == ["context:7:19", "context:8:26", ""]


def test_instances_of_good_patterns_induce_others(spark):
    seeds, _, plain = contexts()
    first = [f"please write mail to acct-99{i}081 today" for i in range(10)]
    second = [f"his member number was acct-99{i}081 then" for i in range(10)]
    second += [f"his member number was mem-{i}4407 then" for i in range(2)]
    third = [f"we refer to mem-{i}4407 here" for i in range(2)] + ["we refer to ref-77120 here"]  # two seeds are too few
    texts = seeds + first + second + third + plain
    got = {r.doc_id: r.n_context for r in P.pii_spans(frame(spark, texts)).collect()}
    at = len(seeds)
    assert [got[i] for i in range(at, len(texts))] == [1] * (len(first) + len(second)) + [0] * (len(third) + len(plain))


def test_hops_go_on_until_no_pattern_is_added(spark):
    edges = [(0, 50000 + i, True) for i in range(100)]
    for p in range(4):  # every pattern shares 40 instances with the one before it
        edges += [(p, 1000 * p + k, False) for k in range(40)] + [(p + 1, 1000 * p + k, False) for k in range(40)]
    edges += [(p, 9000 + 10 * p + k, False) for p in (8, 9) for k in range(10)]
    rows = spark.createDataFrame(edges, "pattern long, instance long, seed boolean")
    assert {r.pattern for r in P.good_patterns(rows).collect()} == {0}
    hop = [{r.pattern for r in P.bootstrapped(rows, min_confidence=0.5, hops=h).collect()} for h in (0, 1, None)]
    assert hop[0] == {0} and hop[1] == {0, 1} and hop[2] >= {0, 1, 2} and not hop[2] & {8, 9}


def test_context_has_no_reach():
    word = "w" * 5000
    for gap in (" ", " " * 400, "\t \t"):
        assert P.context(f"{word}{gap}before it 1", len(word + gap + "before it ")) == P.context("x before it 1", 12)
        assert P.context(f"a {word}{gap}1", len(f"a {word}{gap}")) == P.context(f"b a {word} 1", len(f"b a {word} "))
        assert P.context(f"Label:\n{gap}1", 7 + len(gap)) == P.context("Label:\n1", 7)
    assert P.context("\n \n 1", 4) is None and P.context("1", 0) is None


def test_recall_of_unseen_identifiers(spark):
    """Identifiers that no base pattern catches, in contexts that seeds have shown; and clean texts of the same words."""
    import random
    rng = random.Random(4)
    leads = ["please write mail to", "you can reach me at", "my personal contact is", "send the invoice to"]
    seeds = [f"{rng.choice(leads)} user{i}@site{i}.org before noon" for i in range(120)]
    unseen = [f"{rng.choice(leads)} {rng.choice('abcdefgh')}handle_{rng.randrange(10**6)}@intranet before noon" for i in range(60)]
    clean = [f"the {rng.choice(['part', 'order', 'page'])} number {rng.randrange(10**7, 10**8)} was found in the list" for i in range(60)]
    got = {r.doc_id: r.n_context for r in P.pii_spans(frame(spark, seeds + unseen + clean)).collect()}
    found = [got[120 + i] for i in range(60)]
    assert sum(found) >= 0.9 * len(found) and sum(got[180 + i] for i in range(60)) == 0
