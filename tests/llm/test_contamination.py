import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from stockwave.llm import contamination, fm_index
from stockwave.llm.contamination import Words, find_leaks, remove_leaks

from samples import sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, window):
    """(number of words, spans, ids) of one text."""
    places = [(m.start(), m.end()) for m in WORD.finditer(lower(text))]
    words, hit, ids = [lower(text)[a:b] for a, b in places], set(), set()
    for item, other in items:
        theirs = WORD.findall(lower(other))
        size = min(window, len(theirs))
        for i in range(len(theirs) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == theirs[i : i + size]:
                    hit |= set(range(j, j + size))
                    ids |= {item} - {None}
    spans = [(places[i][0], i) for i in sorted(hit) if i - 1 not in hit]
    spans = [(a, next(places[j][1] for j in range(i, len(words)) if j + 1 not in hit)) for a, i in spans]
    return len(words), len(hit), spans, ids


def compare(spark, docs, items, window=4):
    frame = spark.createDataFrame([(i, t, "x", {"a": [{"k": 1}]}) for i, t in docs], "doc_id long, text string, items string, _hit_words map<string,array<map<string,int>>>")
    found = find_leaks(frame.repartition(3), spark.createDataFrame(items, ITEMS), window)
    assert found.columns == ["doc_id", "text", "_hit_words", "n_words", "n_hit", "spans", "items"]
    key = lambda r: repr(r)
    got = [(r.doc_id, r.text, r.n_words, r.n_hit, [tuple(s) for s in r.spans], sorted(r["items"])) for r in found.collect()]
    assert all(len(set(r[5])) == len(r[5]) for r in got)
    want = [(i, t, n, h, s, sorted(x)) for i, t in docs for n, h, s, x in [brute(t, items, window)]]
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("seed", range(5))
def test_index_equals_a_scan(seed):
    draw = np.random.default_rng(seed)
    for _ in range(30):
        lengths = draw.integers(0, 40, draw.integers(1, 8))
        words = draw.integers(0, draw.integers(1, 5), lengths.sum()).astype(np.uint64) * np.uint64(7919)
        index, texts = fm_index.FMIndex(words, lengths), np.split(words, np.cumsum(lengths)[:-1])
        for size in (1, 2, 5):
            phrases = draw.integers(0, 6, (20, size)).astype(np.uint64) * np.uint64(7919)
            for phrase, lo, hi in zip(phrases, *index.search(phrases)):
                found = sorted(zip(*(x.tolist() for x in index.text_of(index.locate(np.arange(lo, hi))))))
                assert found == [(t, i) for t, w in enumerate(texts) for i in range(len(w) - size + 1) if (w[i : i + size] == phrase).all()]


def test_suffix_order_of_copies():
    own = np.random.default_rng(1).integers(10, 14, 300)
    symbols = np.concatenate([np.append(own, i) for i in range(9)])
    order = fm_index.suffix_order(symbols, 14)
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())


def test_words_and_hashes():
    texts = ["", "Ab-cd  é1x", None, "a" * 5000 + " b", "AB", "中文 Ａ"]
    words = Words(pa.array(texts))
    assert words.counts.tolist() == [len(WORD.findall(lower(t))) for t in texts]
    assert words.hashes[words.before[4]] == words.hashes[0] and len(set(words.hashes.tolist())) == len(words.hashes) - 1


@pytest.mark.parametrize("block_bytes, shard_bytes", [(1 << 30, 1 << 30), (300, 700)])
def test_equals_brute_force(spark, monkeypatch, block_bytes, shard_bytes):
    """With one index and one block of items, and with many of both."""
    monkeypatch.setattr(contamination, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(contamination, "SHARD_BYTES", shard_bytes)
    draw = random.Random(3)
    items = [(i, sentence(i, draw.randrange(1, 30))) for i in range(12)]
    items += [(20, "short one"), (21, ""), (22, None), (23, "?!"), (None, sentence(90, 9)), (3, items[4][1]), (25, items[5][1]), (25, items[5][1])]
    docs = []
    for i in range(60):
        words = sentence(1000 + i, draw.randrange(0, 60)).split()
        own = (draw.choice(items)[1] or "").split()
        at, cut = draw.randrange(len(words) + 1), draw.randrange(len(own) + 1)
        docs.append((i, draw.choice([" ", " \n", " é-"]).join(words[:at] + own[cut : cut + 8] + words[at:])))
    docs += [(61, items[5][1].upper()), (61, items[5][1]), (61, items[5][1]), (None, f"É {items[6][1]} ü"), (62, None), (63, ""), (64, "Short, one. short one")]
    docs += [(65, f"{items[7][1]} {items[7][1]}"), (66, " ".join([sentence(7, 3000), items[8][1], sentence(8, 3000)]))]
    compare(spark, docs, items)


def test_very_common_words(spark):
    compare(spark, [(i, "a " * (5 * i)) for i in range(30)], [(1, "a a a a a a"), (2, "a"), (3, "a b")])


def test_no_items_and_no_texts(spark, no_docs):
    empty = spark.createDataFrame([], ITEMS)
    compare(spark, [(1, "some words"), (2, None)], [])
    assert find_leaks(no_docs, empty).count() == 0 and find_leaks(no_docs, spark.createDataFrame([(1, "a b")], ITEMS)).count() == 0


def test_odd_documents(spark, odd_docs):
    items = spark.createDataFrame([(1, sentence(3, 300)), (2, sentence(1, 60))], ITEMS)
    rows = find_leaks(odd_docs, items).collect()
    assert len(rows) == odd_docs.count() and sum(r.n_hit == r.n_words == 300 for r in rows) == 3


def test_removal(spark):
    items = spark.createDataFrame([("q1", "one two three four five")], "item_id string, text string")
    docs = [(1, "Ä One two, three four five! end", 1, [1]), (2, None, 2, None), (3, "two three", 3, []), (4, "x one two three four five", None, [2])]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_hit int, items array<int>")
    got = {r.doc_id: tuple(r) for r in remove_leaks(frame, items, window=3).collect()}
    assert got == {1: (1, "Ä ! end", 1, [1]), 2: (2, None, 2, None), 3: (3, "two three", 3, []), 4: (4, "x ", None, [2])}


def test_query(spark, tmp_path):
    """The contract's columns on a small fixture, item ids sorted as strings."""
    items = [(i, sentence(i, 15)) for i in (9, 10, 2)]
    docs = [(1, " . ".join(t for _, t in items)), (2, sentence(50, 30)), (3, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in contamination.op11_fm_index(spark, str(tmp_path)).collect()}
    assert tuple(got[1]) == (1, 45, 45, 3, hashlib.sha256(b"10,2,9").hexdigest(), True)
    assert tuple(got[2]) == (2, 30, 0, 0, hashlib.sha256(b"").hexdigest(), False) and got[3].n_words == 0
