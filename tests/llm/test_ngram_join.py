import random

import numpy as np
import pytest

from stockwave.llm import ngram_join
from stockwave.llm.common import table
from stockwave.llm.components import components

from samples import SF, sentence


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingle_set(r.text) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    up[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if sets[i] and r.doc_id is not None:
            low[root(i)] = min(low.get(root(i), r.doc_id), r.doc_id)
    return [(r.doc_id, len(sets[i]), low.get(root(i)) if sets[i] else r.doc_id) for i, r in enumerate(rows)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def compare(docs):
    found = ngram_join.groups(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, found)) == order(brute(docs.collect()))


def edited(text, n, draw):
    words = text.split()
    for _ in range(n):
        at = draw.randrange(len(words))
        how = draw.randrange(3)
        if how == 0:
            words[at] = f"new{draw.randrange(10**6)}"
        elif how == 1:
            words.insert(at, f"more{draw.randrange(10**6)}")
        elif len(words) > 1:
            words.pop(at)
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    """Near copies on both sides of the limit, of all sizes, and shared passages."""
    draw = random.Random(seed)
    passage = sentence(999, 60)
    rows = []
    for base in range(60):
        text = sentence(1000 * seed + base, draw.choice([1, 3, 5, 6, 8, 9, 12, 20, 35, 60, 90, 150, 400]))
        if base % 4 == 0:
            text = f"{passage} {text}"
        rows += [edited(text, draw.choice([0, 0, 1, 1, 2, 3, 5, 8]), draw) for _ in range(draw.choice([1, 2, 6, 15]))]
    draw.shuffle(rows)
    compare(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4))


def test_chain_of_copies(spark):
    """Each text is linked to the next only, and small changes add up along the chain."""
    draw, texts = random.Random(5), [sentence(7, 120)]
    for _ in range(40):
        texts.append(edited(texts[-1], 1, draw))
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_many_texts_in_one_entry(spark, monkeypatch):
    """Open classes of a leader in more than one block."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 300)
    draw = random.Random(6)
    passage = sentence(12, 40)
    texts = [f"{passage} {sentence(100 + i // 2, 12)}" for i in range(60)]
    texts = [edited(t, draw.choice([0, 1, 2]), draw) for t in texts]
    compare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_planted_documents(spark):
    compare(table(spark, SF, "documents"))


def test_odd_rows(odd_docs, no_docs):
    compare(odd_docs)
    assert ngram_join.groups(no_docs).count() == 0 and ngram_join.deduplicate(no_docs).count() == 0


def test_one_row_of_each_group_stays(odd_docs):
    kept = ngram_join.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    sets = {}
    for r in odd_docs.collect():
        if shingle_set(r.text):
            sets.setdefault(shingle_set(r.text), []).append(r.doc_id)
    empty = [r for r in odd_docs.collect() if not shingle_set(r.text)]
    rows = kept.collect()
    assert len(rows) == len(sets) + len(empty)
    assert {r.doc_id for r in rows if shingle_set(r.text)} == {min((i for i in ids if i is not None), default=None) for ids in sets.values()}


@pytest.mark.parametrize("seed", range(200))
def test_linked_sets_share_entries(seed):
    """The pigeonhole guarantee itself, on sets at the limit."""
    draw = np.random.default_rng(seed)
    n = int(draw.choice([4, 5, 6, 9, 10, 17, 31, 64, 65, 200, 1000]))
    x = np.unique(draw.integers(0, 1 << 64, n, np.uint64))
    n = len(x)
    grow = int(draw.integers(0, n // 4 + 1))  # y has up to a quarter more, and swaps as far as the limit allows
    swaps = 0
    while 100 * (n - swaps - 1) >= 80 * (n + grow + swaps + 1):
        swaps += 1
    drop = draw.permutation(n)[swaps:]
    y = np.unique(np.concatenate([x[drop], draw.integers(0, 1 << 64, grow + swaps, np.uint64)]))
    common = len(np.intersect1d(x, y))
    assert 100 * common >= 80 * (n + len(y) - common)
    at_least = min(ngram_join.band_plan(b)[2] for b, _ in ngram_join.places(n) + ngram_join.places(len(y))) if n >= 4 else 0
    assert len(np.intersect1d(ngram_join.entries(x), ngram_join.entries(y))) >= at_least or np.array_equal(x, y)


def test_cost_model_uses_both_kinds_of_segments():
    plans = [ngram_join.band_plan(b) for b in range(12)]
    assert any(p[1] for p in plans) and any(not p[1] for p in plans)
    for band, (equal, deletion, common) in enumerate(plans):
        assert equal + 2 * deletion >= (2 * (4 << band) - 1) // 4 + common


def test_shared_entries_by_size(spark):
    sizes = list(range(1, 700))
    found = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", ngram_join.shared_entries().alias("k")).collect()
    for r in found:
        assert r.k == min([ngram_join.band_plan(b)[2] for b, _ in ngram_join.places(r.n)], default=1)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 9), (5, 5)] + [(100 + i, 101 + i) for i in range(60)] + [(1000, 1001 + i) for i in range(50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {100 + i: 100 for i in range(61)} | {1000 + i: 1000 for i in range(51)}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_split_over_batches():
    import pyarrow as pa

    rows = [(1, 5), (1, 5), (2, 1), (2, 1), (2, 7), (3, 1), (4, 1), (4, 1), (4, 2), (4, 3), (5, 9)]
    for cut in range(1, 6):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i : i + cut]]), pa.array([r[1] for r in rows[i : i + cut]])], ["entry", "class"]) for i in range(0, len(rows), cut)]
        found = [r for b in ngram_join.met_twice(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert found == [(2, 1), (2, 7), (4, 1), (4, 2), (4, 3)]
