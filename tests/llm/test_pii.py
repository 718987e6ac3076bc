import math
import random
import re

import pytest
from pyspark.sql import functions as F

from stockwave.llm import pii
from stockwave.llm.common import table

from samples import SF

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def brute(text):
    tests = (
        lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")),
        lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15,
    )
    return [(k, m.start(), m.end()) for k in range(4) for m in re.finditer(PATTERNS[k], text) if tests[k](m.group())]


TEXTS = [
    "", "a@b.c", "x a@b.c@d.e y", "a@b@c.d", "@b.c a@.b a@b. a.b@c-d.e.f.", "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 001.2.3.255",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "41111111111111112", "4111  1111 1111 1111", "+1 (017) 555-7713 and +49 30 1234",
    "+1 (017) 555-7713+1 (018) 555-7714 +++12345678", "é +1 22 33 44 5 ü@x.y ü.z@x.y", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+1((((((((9 1.2.3.4@x.y",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_of_planted_documents(spark):
    rows = table(spark, SF, "documents").collect()
    assert all(pii.base_spans(r.text) == brute(r.text) for r in rows)


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "a@" * 200_000, "+1" + " (" * 200_000, "x1" * 200_000, "@" * 400_000, "1 " * 200_000):
        found = pii.base_spans(text)
        list(pii.candidates(text, found))


def contacts(n):
    rows = [(i, f"please write to our desk at user{i}@mail{i}.example.org for help {i}" if i % 2 else f"my number is +1 (0{10 + i % 89}) 555-{1000 + i} so call") for i in range(n)]
    hidden = [(1000, "so my number is 017 555 7713 so call me"), (1001, "the price of 017 555 7714 was too much"), (1002, "please write to our desk at user9(at)mail for help"), (1003, "please write to our desk at j.doe@localhost for help")]
    return [(i, t, "x", 0) for i, t in rows + hidden]


def test_contexts_find_unseen_identifiers(spark):
    docs = spark.createDataFrame(contacts(120), "doc_id long, text string, spans string, kind int").repartition(3)
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert [(pii.KINDS[s.kind], text[1000][s.start : s.end]) for s in found[1000].spans] == [("phone", "017 555 7713")]
    assert [(pii.KINDS[s.kind], text[1003][s.start : s.end]) for s in found[1003].spans] == [("email", "j.doe@localhost")]
    assert not found[1001].spans and not found[1002].spans
    assert all(len(found[i].spans) == 1 == len(found[i].base) for i in range(120))
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert masked[1000] == "so my number is <phone> so call me" and masked[1001] == text[1001]
    assert masked[1] == "please write to our desk at <email> for help 1"


def test_odd_rows(odd_docs, no_docs):
    rows = pii.find(odd_docs).collect()
    assert len(rows) == odd_docs.count() and not any(r.spans for r in rows)
    kept = pii.redact(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd_docs.collect()))
    assert pii.find(no_docs).count() == 0 and pii.redact(no_docs).count() == 0


def test_repeated_rows_with_spans(spark):
    docs = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"), (1, "x")], "doc_id long, text string")
    assert sorted(r.text for r in pii.redact(docs).collect()) == ["<email>", "<email>", "<email>", "x"]


def test_overlapping_spans_are_masked_once():
    spans = [{"kind": 2, "start": 0, "end": 19}, {"kind": 3, "start": 10, "end": 25}]
    assert pii.masked("4111 1111 1111 1111 22 33 z", spans) == "<card> z"


def test_query_columns(spark):
    rows = pii.op7_contexts(spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == pii.digest_of(base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert set(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base) <= set(r.spans.split(",")) | {""}


@pytest.mark.parametrize("text, parts", [
    ("so 0175557713 0175557714 0175557715 it", ["0175557713", "0175557714", "0175557715"]),
    ("so 0175557713. 0175557714. 0175557715 it", ["0175557713", "0175557714", "0175557715"]),
    ("at 017 555 7713. 24 hours", ["017 555 7713"]),
    ("at (017) 555-7713 now", ["(017) 555-7713"[1:]]),
])
def test_numbers_side_by_side(text, parts):
    assert [text[a:b] for a, b in pii.candidates(text, [])] == parts


@pytest.mark.parametrize("hidden, found", [("1234567890123456789012345", True), ("012345", True), ("a" * 200 + "@localhost", False), ("the most", False)])
def test_candidates_of_any_length(spark, hidden, found):
    rows = [*contacts(120), (2000, f"so my number is {hidden} so call me", "x", 0)]
    spans = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int")).collect()}
    assert [(pii.KINDS[s.kind], s.end - s.start) for s in spans[2000]] == ([("phone", len(hidden))] if found else [])


def test_long_words_are_known_by_their_digest(spark):
    word = "b" * 300 + "@localhost"
    rows = [*contacts(120), (2000, f"please write to our desk at {word} for help", "x", 0), (2001, f"and {word.upper()} again", "x", 0)]
    spans = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int")).collect()}
    assert [len(spans[i]) for i in (2000, 2001)] == [1, 1] and spans[2001][0].end - spans[2001][0].start == 310


def planted(n_seeds=200, n_unseen=30):
    """(texts, {doc_id: the unseen identifier}): the words around an identifier are drawn, but for one before it, after it or at the line's start."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(4))
    forms = (("{a} telephone {x} {b}", "phone"), ("{a} {b}\nfax {x} {c}", "phone"), ("{a} {x} extension {b}", "phone"), ("{a} mailbox {x} {b}", "email"))
    texts, hidden = [], {}

    def add(form, x):
        texts.append(form.format(a=f"{word()} {word()}", b=f"{word()} {word()}", c=word(), x=x))
        return len(texts) - 1

    for form, kind in forms:
        for i in range(n_seeds):
            add(form, f"{word()}{i}@{word()}.org" if kind == "email" else f"+49 {draw.randrange(100, 999)} {draw.randrange(10**5, 10**6)}")
        for _ in range(n_unseen):
            x = f"{word()}.{word()}@{word()}" if kind == "email" else f"0{draw.randrange(100, 999)} {draw.randrange(10**5, 10**6)}"
            hidden[add(form, x)] = x
    for i in range(300):  # numbers that are no identifiers
        add(draw.choice(("{a} invoice {x} {b}", "{a} {x} pieces {b}", "{a} {x} {b}")), str(draw.randrange(10**6, 10**9)))
    return texts, hidden


def brute_bootstrap(texts):
    """The beliefs by plain loops over all patterns and instances."""
    kinds, shapes, edges = {}, {}, set()
    for text in texts:
        found = pii.base_spans(text)
        for k, s, e in found + [(-1, s, e) for s, e in pii.candidates(text, found)]:
            x = text[s:e].lower()
            kinds[x], shapes[x] = max(k, kinds.get(x, -1)), pii.shape_of(x)
            edges |= {(x, p) for p in pii.patterns_at(text, s, e)}
    of_pattern, of_instance = {}, {}
    for x, p in edges:
        of_pattern.setdefault(p, set()).add(x)
        of_instance.setdefault(x, set()).add(p)
    allowed = {(k, shapes[x]) for x, k in kinds.items() if k >= 0}
    belief = {(x, k): 1.0 for x, k in kinds.items() if k >= 0}
    seeds, total = set(belief), -1.0
    while True:
        trust = {}
        for p, members in of_pattern.items():
            for k in range(4):
                votes = [belief[x, k] for x in members if (x, k) in belief]
                if len(votes) >= 3 and sum(votes) / (len(members) + 1) >= 0.8:
                    trust[p, k] = sum(votes) / (len(members) + 1)
        told = {}
        for x, own in of_instance.items():
            if kinds[x] >= 0:
                continue
            longer = [p for p in own if p[0] in "LM"]
            known = any(len(of_pattern[p]) >= 4 for p in longer)
            for k in range(4):
                spoken = [p for p in longer if (p, k) in trust] or ([] if known else [p for p in own if (p, k) in trust])
                if spoken and (k, shapes[x]) in allowed:
                    told[x, k] = 1 - math.prod(1 - trust[p, k] for p in spoken)
        belief = {**{s: 1.0 for s in seeds}, **told}
        if sum(told.values()) - total <= 1e-3 * sum(told.values()):
            return {x: k for (x, k), b in told.items() if b >= 0.9}
        total = sum(told.values())


def test_unseen_identifiers_in_varying_contexts(spark):
    texts, hidden = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute_bootstrap(texts)
    added = {}
    for r in pii.find(docs).collect():
        assert [s for s in r.spans if s in r.base] == r.base
        for s in r.spans:
            if s not in r.base:
                added.setdefault(r.doc_id, []).append((texts[r.doc_id][s.start : s.end], s.kind))
    assert {x: k for spans in added.values() for x, k in spans} == want
    caught = sum([x for x, _ in added.get(i, [])] == [own] for i, own in hidden.items())
    assert caught >= 0.9 * len(hidden)
    assert set(added) <= set(hidden)  # no span in any text without an identifier


def test_no_back_off_from_a_known_context(spark):
    """"order line" is known to hold no phones, though "line" mostly does."""
    rows = [f"x{i} call{i} line +49 30 {1000 + i} s{i}" for i in range(150)] + [f"our order line 0{2000 + i}44 u{i}" for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert pii.find(docs).where(F.size("spans") > F.size("base")).count() == 0
