import collections
import math
import re

import pytest

from stockwave.llm import quality_rules
from stockwave.llm.common import table

from samples import SF


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def classes(text):
    counts = [len(re.findall(c, text)) for c in (r"[0-9]", r"[#*$%&|<>]", r"[.,;:!?]", r"[\x20\x09-\x0D]")]
    upper = sum(c.isupper() and c.istitle() or (c.isalpha() and c.isupper()) for c in text)
    return [upper, *counts, len(text) - upper - sum(counts)]


def js(p, q):
    total = sum((x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0) for x, y in zip(p, q))
    return math.sqrt(max(0, total / 2))


def brute(rows, common=quality_rules.COMMON_WORDS):
    chars, words = collections.defaultdict(lambda: [0] * 6), collections.defaultdict(collections.Counter)
    for r in rows:
        chars[r.lang] = [a + b for a, b in zip(chars[r.lang], classes(r.text or ""))]
        words[r.lang].update(WORD.findall(r.text or ""))
    out = []
    for r in rows:
        text, total = r.text or "", max(1, sum(chars[r.lang]))
        counted = words[r.lang]
        top = [w for w, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0].encode()))[:common]]
        n, n_lang = len(WORD.findall(text)), sum(counted.values())
        own = collections.Counter(WORD.findall(text))
        p, q = [own[w] / max(1, n) for w in top], [counted[w] / n_lang for w in top]
        by_class = js([c / max(1, len(text)) for c in classes(text)], [c / total for c in chars[r.lang]])
        by_word = js([*p, max(0, 1 - sum(p))], [*q, max(0, 1 - sum(q))]) if n >= quality_rules.GUARD_WORDS else None
        counts = base(text)
        failed = n < 20 or 100 * counts[4] > 30 * n
        far = n >= quality_rules.GUARD_WORDS and (by_class > quality_rules.MAX_CLASS_DISTANCE or by_word > quality_rules.MAX_WORD_DISTANCE)
        out.append((r.doc_id, *counts, by_class, by_word, failed, not failed and not far))
    return out


def compare(docs):
    found = quality_rules.judge(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[6] or 0)
    for a, b in zip(sorted(map(tuple, found), key=lambda r: key((r[0], r[1], r[2], r[3], r[4], r[5], r[6]))), sorted(brute(docs.collect()), key=key), strict=True):
        assert a[:6] == b[:6] and a[8:] == b[8:]
        assert a[6] == pytest.approx(b[6], abs=1e-6) and a[7] == pytest.approx(b[7], abs=1e-6)


def test_equals_brute_force(spark):
    compare(table(spark, SF, "documents"))


def test_odd_rows(odd_docs, no_docs):
    compare(odd_docs)
    assert quality_rules.judge(no_docs).count() == 0


@pytest.mark.parametrize(("text", "n"), [
    ("a b c d e f g h " * 3, 24), ("a b c d e f g h", 0), ("x " * 9, 9), ("a b c d e f g h i a b c d e f g h", 16), ("", 0),
])
def test_repeated_words(spark, text, n):
    row = quality_rules.judge(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).head()
    assert row.n_repeat_words == n == base(text)[4]


def test_clean_documents_are_kept(spark):
    folder = "/root/testdata/sf0.01"
    found = quality_rules.judge(table(spark, folder, "documents")).join(table(spark, folder, "labels"), "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in found if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) < 0.7 * len(bad)
