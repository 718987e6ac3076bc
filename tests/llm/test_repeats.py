import re

import pytest

from stockwave.llm import repeats
from stockwave.llm.common import table

from samples import SF, sentence


def brute(rows, min_words=repeats.MIN_WORDS, ends=r"\n+|(?<=[.!?])[ \t]+"):
    seen, out = {}, set()
    order = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows})
    places = []
    for unknown, doc_id, text in order:
        at = 0
        for part in re.split(f"({ends})", text):
            words = part.lower().split()
            if len(words) >= min_words and not re.fullmatch(ends, part):
                start = at + len(part) - len(part.lstrip())
                places.append((unknown, doc_id, start, start + len(part.strip()), len(words), " ".join(words)))
            at += len(part)
    for unknown, doc_id, start, end, n, normal in sorted(places):
        first = seen.setdefault(normal, (unknown, doc_id, start))
        if first != (unknown, doc_id, start):
            out.add((None if unknown else doc_id, start, end, n, None if first[0] else first[1], first[2]))
    return out


def compare(docs):
    found = [tuple(r) for r in repeats.repeated_units(docs).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(docs.collect())


def test_equals_brute_force(spark):
    compare(table(spark, SF, "documents"))


def test_odd_rows(odd_docs, no_docs):
    compare(odd_docs)
    assert repeats.repeated_units(no_docs).count() == 0 and repeats.without_repeats(no_docs).count() == 0
    assert repeats.without_repeats(odd_docs).columns == odd_docs.columns
    assert repeats.without_repeats(odd_docs).count() == odd_docs.count()


def test_passage_within_lines(spark):
    passage = ". ".join(sentence(100 + i, 14) for i in range(4)) + "."
    rows = [(i, f"{sentence(i, 30)}. {passage} {sentence(50 + i, 30)}.\n{sentence(80 + i, 12)}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.repeated_units(docs).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 4, 5} and {r.kept_doc_id for r in found} == {0}
    clean = {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()}
    assert clean[0] == rows[0][1]
    for i in range(1, 6):
        assert len(clean[i].split()) == 72 and all(clean[i].count(w) for w in rows[i][1].split("\n")[1].split())


@pytest.mark.parametrize("unit", sorted(repeats.ENDS))
def test_other_units(spark, unit):
    text = "One two three four. Five six seven eight.\nNine ten eleven twelve thirteen.\n\nLast one of the four words here."
    docs = spark.createDataFrame([(2, text), (1, text.upper()), (3, text)], "doc_id long, text string")
    found = repeats.repeated_units(docs, unit, 2).collect()
    assert {r.doc_id for r in found} == {2, 3}
    n = {"paragraph": 2, "line": 3, "sentence": 4}[unit]
    assert len(found) == 2 * n and {r.kept_doc_id for r in found} == {1}


def shared(kind):
    words = sentence(900, 56).split()
    pieces = [words[i : i + 4] for i in range(0, 56, 4)]
    if kind == "sentences":
        return ". ".join(map(" ".join, pieces)) + "."
    if kind == "lines":
        return "\n".join(map(" ".join, pieces))
    if kind == "unmarked":
        return " ".join(words)
    return "".join(chr(0x4E00 + i * 37 % 5000) + "。" * (i % 9 == 8) for i in range(110))  # without blanks


@pytest.mark.parametrize("kind", ["sentences", "lines", "unmarked", "unspaced"])
def test_passages_of_any_form(spark, kind):
    passage = shared(kind)
    rows = [(i, f"{sentence(i, 30)}{' ' if kind != 'lines' else chr(10)}{passage} {sentence(50 + i, 30)}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 4} and {r.kept_doc_id for r in found} == {0}
    texts = dict(rows)
    for r in found:
        own, kept = texts[r.doc_id][r.start : r.end], texts[r.kept_doc_id][r.kept_start :]
        assert kept.startswith(own) and own in passage
        assert kind == "unspaced" or r.n_words == len(own.split())
        assert len(own) >= 0.6 * len(passage)
    clean = {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()}
    assert clean[0] == texts[0]
    assert all(clean[i].startswith(sentence(i, 30)) and clean[i].endswith(sentence(50 + i, 30)) for i in clean)


def brute_passages(rows):
    """The spans of ``repeated_passages`` from the units of every text, in plain Python."""
    kinds, powers = repeats.kinds_of_characters(), repeats.Powers()
    units, firsts, groups = [], {}, {}
    for doc_id, text in {(r.doc_id, r.text) for r in rows if r.text}:
        found = repeats.passages(text, kinds, powers)
        for place, tokens, high, low in found if found is not None else []:
            units.append(((doc_id is None, doc_id or 0, text), int(place), int(tokens), (int(high), int(low))))
    ranks = {key: n for n, key in enumerate(sorted({u[0] for u in units}, key=lambda k: (k[0], k[1], hash_of[k[2]])))}
    for doc, place, tokens, digest in units:
        firsts[digest] = min(firsts.get(digest, (1 << 62,)), (ranks[doc], place, tokens, doc))
    for doc, place, tokens, digest in units:
        rank, first_place, first_tokens, first_doc = firsts[digest]
        if ranks[doc] != rank or place >> 32 >= first_place & 0xFFFFFFFF:
            groups.setdefault((doc, first_doc, (tokens >> 32) - (first_tokens >> 32)), []).append((tokens >> 32, tokens & 0xFFFFFFFF, place, first_place))
    out = []
    for (doc, first_doc, _), found in groups.items():
        until = -1
        for a, b, place, first_place in sorted(found):
            if a > until:
                out.append([doc, place >> 32, place & 0xFFFFFFFF, a, b, first_doc, first_place >> 32])
            span = out[-1]
            span[2], span[4], until = max(span[2], place & 0xFFFFFFFF), max(span[4], b), max(until, b)
    ids = [(None if d[0] else d[1], s, e, b - a, None if f[0] else f[1], k) for d, s, e, a, b, f, k in out]
    return sorted(set(ids), key=repr)


hash_of = {}


def compare_passages(docs):
    hash_of.update({r.text: r.copy for r in docs.select("text", repeats.copy_of("text").alias("copy")).collect()})
    found = [tuple(r) for r in repeats.repeated_passages(docs).collect()]
    assert sorted(found, key=repr) == brute_passages(docs.select("doc_id", "text").collect()) and len(found) == len(set(found))


@pytest.mark.parametrize("hot", [50_000, 3])
def test_passages_equal_brute_force(spark, odd_docs, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_UNITS", hot)
    compare_passages(table(spark, SF, "documents").limit(120))
    compare_passages(odd_docs)
    passage = sentence(70, 60)
    rows = [(i, f"{sentence(n, 20)} {passage} {sentence(40 + n, 20)}") for n, i in enumerate((1, 1, 2, None, None))] + [(2, f"{passage}.\n{passage}"), (2, f"{passage}.\n{passage}")]
    compare_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


@pytest.mark.parametrize("ids", [(7, 7), (None, None), (7, 8)])
def test_two_texts_of_one_id(spark, ids):
    """A passage that two texts of one doc_id share is as repeated as that of two documents."""
    passage = sentence(70, 60)
    docs = spark.createDataFrame([(i, f"{sentence(n, 20)}. {passage}. {sentence(40 + n, 20)}") for n, i in enumerate(ids)], "doc_id long, text string")
    assert sum(r.n_words for r in repeats.repeated_passages(docs).collect()) == 60
    texts = [r.text for r in repeats.without_repeats(docs).collect()]
    assert sorted(t.count(passage) for t in texts) == [0, 1]


def test_a_whole_line_of_short_sentences(spark):
    docs = spark.createDataFrame([(i, f"{sentence(i, 9)}\nOne two. Three four. Five six. Seven eight.\n{sentence(20 + i, 9)}") for i in range(2)], "doc_id long, text string")
    assert [(r.doc_id, r.n_words, r.kept_doc_id) for r in repeats.repeated_passages(docs).collect()] == [(1, 8, 0)]


def test_passages_hold_all_repeated_units(spark):
    docs = table(spark, SF, "documents")
    covered = {}
    for r in repeats.repeated_passages(docs).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    assert all(set(range(start, end)) <= covered[doc_id] for doc_id, start, end, *_ in brute(docs.collect()))


def test_a_run_that_overlaps_itself_stays(spark):
    docs = spark.createDataFrame([(1, " ".join(["ha."] * 40))], "doc_id long, text string")
    assert repeats.without_repeats(docs).collect()[0].text.split() == ["ha."] * 8
