import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stockwave.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def check(pieces, capacity):
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def one_bin_at_a_time(lengths, capacity):
    """Best-two-fit on single documents, straight from its definition."""
    left, bins = sorted(lengths, reverse=True), 0
    while left:
        own, gap = [], capacity
        for x in list(left):
            if x <= gap:
                own.append(x)
                left.remove(x)
                gap -= x
        smallest = own[-1]
        if gap:
            room = gap + smallest
            pairs = [(left[i] + left[j], i, j) for i in range(len(left)) for j in range(i + 1, len(left)) if left[i] + left[j] <= room]
            if pairs and max(pairs)[0] > smallest:
                _, i, j = max(pairs)
                own = own[:-1] + [left[i], left[j]]
                left.pop(j)
                left.pop(i)
                left = sorted([*left, smallest], reverse=True)
        bins += 1
    return bins


@pytest.mark.parametrize("seed", range(8))
def test_plan_packs_every_document_as_single_steps_do(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 50, 128])
    lengths = [draw.randint(1, capacity) for _ in range(draw.choice([1, 30, 300]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.plan_bins(counts, capacity)
    used, placed = {}, dict.fromkeys(counts, 0)
    for length, first, n, first_bin, per_bin, offset in plan:
        assert first == placed[length]
        placed[length] += n
        for i in range(n):
            used.setdefault(first_bin + i // per_bin, []).append((offset + i % per_bin * length, length))
    assert placed == counts
    for content in used.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == one_bin_at_a_time(lengths, capacity)


def test_two_fit_better_than_the_smallest():
    assert packing.plan_bins({6: 1, 3: 1, 2: 2}, 10)[0][0] == 6 and len({r[3] for r in packing.plan_bins({6: 1, 3: 1, 2: 2}, 10)}) == 2


def test_plan_does_not_grow_with_the_documents():
    few = packing.plan_bins({n: 1000 for n in range(1, 129)}, 128)
    many = packing.plan_bins({n: 1_000_000_000 for n in range(1, 129)}, 128)
    assert len(many) < 4 * len(few)


def test_pieces_are_the_tokens(odd_docs):
    rows = packing.pack_documents(odd_docs, capacity=256, with_ids=True)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    pieces = rows.collect()
    want = sorted(
        (-1 if r.doc_id is None else r.doc_id, at // 256, ids[at : at + 256].tobytes())
        for r in odd_docs.collect()
        for ids in [np.array([*TOKENIZER.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")]
        for at in range(0, len(ids), 256)
    )
    assert want == sorted((-1 if p.doc_id is None else p.doc_id, p.piece, bytes(p.ids)) for p in pieces)
    assert all(p.start == 256 * p.piece and zlib.crc32(bytes(p.ids)) == p.ids_crc32 and 4 * p.length == len(p.ids) for p in pieces)
    n = check(pieces, 256)
    assert n == -(-sum(p.length for p in pieces) // 256)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(rows).collect()}
    for p in pieces:
        assert whole[p.sequence_id][4 * p.offset : 4 * (p.offset + p.length)] == bytes(p.ids)


def test_unusual_text(spark):
    texts = ["İstanbul ǅ ﬁ x ý z", "a<|endoftext|>b <|startoftext|>", "it's 12a'll \x1c\x1d q", "é ́ x", "日本 語\r\n\tword " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {p.doc_id: np.frombuffer(bytes(p.ids), "<u4").tolist() for p in packing.token_pieces(docs, with_ids=True).collect()}
    assert found == {i: [*TOKENIZER.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


RUN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
PIECES = ["'s", "'t", "'re", "'VE", "'m", "'ll", "'d", "'", "''", "l", "LL", "r", "s", "É", "ß", "À", "þ", "ÿ", "í", "à", "7", "42", ".", "!'", "<", "<|", "|", " ", "\n", "\t\r", "word", "don't"]


def cut_of(texts):
    """Which of the texts are cut into runs, and the runs of these."""
    sent = [t.encode() for t in texts]
    data, bounds = np.frombuffer(b"".join(sent), np.uint8), np.cumsum([0, *map(len, sent)])
    plain = packing.is_plain(data, packing.KIND_OF_BYTE[data], bounds)
    kept = [s for s, is_cut in zip(sent, plain) if is_cut]
    data, bounds = np.frombuffer(b"".join(kept), np.uint8), np.cumsum([0, *map(len, kept)])
    runs, at = packing.cut_runs(data, packing.KIND_OF_BYTE[data], bounds)
    return plain.tolist(), [runs.to_pylist()[i:j] for i, j in zip(at, at[1:])]


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_the_pattern(seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 12))) for _ in range(400)]
    plain, runs = cut_of(texts)
    assert plain == ["<|" not in t for t in texts] or all("<|" in t or t.endswith("<") for t, is_cut in zip(texts, plain) if not is_cut)
    assert runs == [RUN.findall(t.lower()) for t, is_cut in zip(texts, plain) if is_cut]


def test_other_characters_go_to_the_tokenizer_whole():
    texts = ["a", "×", "a÷b", "\x1c", "\x7f", "\x85", "ł", "日本", "e\u0301", "é", "\x00", "", "ã", "\u00a0", "Ÿ", "𝒳"]
    assert [t for t, is_cut in zip(texts, cut_of(texts)[0]) if is_cut] == ["a", "é", "", "ã"]


@pytest.mark.parametrize("limits", [(30, 40), (1000, 1)])
def test_what_is_remembered_does_not_change_the_ids(monkeypatch, limits):
    monkeypatch.setattr(packing, "CACHED_RUNS", limits[0])
    monkeypatch.setattr(packing, "WAITING_BYTES", limits[1])
    draw = random.Random(3)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 12))) for _ in range(300)] + [None, "naïve Ærøskøbing " * 20, "x×y"]
    runs = packing.RunIds(public_tokenizers.path(packing.TOKENIZER))
    for _ in range(2):
        found = [ids.tolist() for ids in packing.encoded(pa.array(["cut off", *texts])[1:], runs)]
        assert found == [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(runs.places) == len(runs.met) == len(runs.starts) - 1


def test_frequent_runs_stay_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_RUNS", 20)
    runs = packing.RunIds(public_tokenizers.path(packing.TOKENIZER))
    for i in range(30):
        list(packing.encoded(pa.array([f"the word {'abcdefghijklmnopqrstuvwxyzabcd'[i]}{'z' * i}"]), runs))
        assert len(runs.places) <= 20
    assert {"the", "word"} <= set(runs.places) and "a" not in runs.places


def test_empty_table(no_docs):
    assert packing.pack_documents(no_docs).count() == 0


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), (None, None), ("b", "one two"), ("", "x " * 600)], "doc_id string, text string")
    found = packing.pack_documents(docs, capacity=256)
    assert found.schema["doc_id"].dataType.simpleString() == "string"
    pieces = found.collect()
    assert sorted({str(p.doc_id) for p in pieces}) == ["", "None", "b"]
    check(pieces, 256)


def test_a_task_holds_few_texts_at_a_time():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": ["one two"] * 2999 + [None]})
    found = list(packing.cut(iter([batch]), public_tokenizers.path(packing.TOKENIZER), 256, 0, False))
    assert max(b.num_rows for b in found) < 1000
    assert [i for b in found for i in b.column("doc_id").to_pylist()] == list(range(3000))
