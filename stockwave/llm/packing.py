"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

A bin is filled greedily, longest first; then its smallest document is replaced by the two unpacked
documents that fill the expanded gap most tightly, where two do so better. The order in which that
rule takes documents depends on their lengths alone, so it runs on the counts per length (at most
one per token of a sequence, whatever the number of documents), and equal bins are made in one step.
Documents find their places from their rank among those of equal length.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from stockwave.llm.common import freed, running_sum, small_batches, table
from stockwave.session import stage

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
CACHED_RUNS = 140_000
WAITING_BYTES = 500_000  # of the texts that are cut into runs and looked up together
TOGETHER = 500
PIECE = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}


#: Kinds of bytes in texts that are cut into runs here as the tokenizer does it. Their characters are those of ASCII that are no
#: controls, blanks, and the letters from \xc0 to \xff (byte 0xc3 and one more); other texts go to the tokenizer whole.
BLANK, LETTER, DIGIT, MARK, OTHER = range(5)
KIND_OF_BYTE = np.full(256, OTHER, np.uint8)
KIND_OF_BYTE[0x20:0x7F] = MARK
KIND_OF_BYTE[list(b" \t\n\v\f\r")] = BLANK
KIND_OF_BYTE[list(b"0123456789")] = DIGIT
KIND_OF_BYTE[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), 0xC3]] = LETTER
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LOWER[0x80:0x9F] += 32  # the second bytes of capitals
ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")  # with the apostrophe in front a run of their own


def is_plain(data: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each text, ``data`` between two successive ``bounds``, can be cut into runs here."""
    odd = np.flatnonzero(kind == OTHER)
    high = np.flatnonzero(data >= 0x80)
    if len(high):
        second = data[high] != 0xC3
        before, after = data[np.maximum(high - 1, 0)], data[np.minimum(high + 1, len(data) - 1)]
        fits = np.where(second, (before == 0xC3) & (data[high] != 0x97) & (data[high] != 0xB7), (after >= 0x80) & (after < 0xC0))
        odd = np.concatenate([odd, high[~fits]])
    special = np.flatnonzero(data[:-1] == ord("<"))
    odd = np.concatenate([odd, special[data[special + 1] == ord("|")]])  # special tokens have that mark
    plain = np.ones(len(bounds) - 1, bool)
    plain[np.searchsorted(bounds, odd, side="right") - 1] = False
    return plain


def cut_runs(data: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The runs of plain texts in lower case, one after the other, and the number of runs before each text and in all.

    A run is an apostrophe with one of ``ENDINGS``, or letters, a digit, or other marks, as many as there are; the leftmost comes first.
    """
    data, n = LOWER[data], len(data)
    first = np.zeros(n + 3, bool)  # of a text; the last ones are beyond all
    first[bounds] = True
    first[n:] = True
    starts = first.copy()
    starts[1:n] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    marks = np.flatnonzero((data == ord("'")) & starts[:n])
    marks = marks[~first[marks + 1]]
    for ending in ENDINGS:
        of = marks
        for i, letter in enumerate(ending, 1):
            of = of[~first[of + i]]
            of = of[data[of + i] == letter]
        starts[of + 1] = False
        starts[of + 1 + len(ending)] = True
    word = kind != BLANK
    at = np.flatnonzero(starts[:n] & word)
    offsets = np.append(np.flatnonzero(starts[:n][word]), np.count_nonzero(word)).astype(np.int32)
    runs = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[word]))
    return runs, np.searchsorted(at, bounds)


class RunIds:
    """Token ids of runs of a tokenizer that cuts texts like word_bpe_49k.json, remembered in one array; keeps the half met most often when full.

    Byte pairs are merged within a run only, so a text's ids are those of its runs in a row. Unknown
    runs are looked up together; ``ends`` tells the ids that end a run.
    """

    def __init__(self, path: str):
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)  # for runs, which need no normal form, are cut at blanks and come as the characters of bytes
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        names = [(chr(byte), level.pre_tokenize_str(chr(0xC0 + byte - 0x80))[0][0][1]) for byte in range(0x80, 0xC0)]  # of the second bytes of letters
        self.names = [(byte, name) for byte, name in names if byte != name]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.places: dict[str, int] = {}
        self.starts, self.ids = np.zeros(1, np.int32), np.zeros(0, "<u4")  # run i has ids[starts[i]:starts[i + 1]]
        self.met = np.zeros(0, np.int32)  # in how many lookups, earlier ones counting less

    def find(self, runs: list[str]) -> np.ndarray:
        """Places of the runs, -1 where unknown."""
        return np.fromiter((self.places.get(run, -1) for run in runs), np.int32, len(runs))

    def make_room(self, n: int) -> bool:
        """Forgets runs if ``n`` more would be too many: those met once, and the rarest beyond half of what is remembered."""
        if len(self.places) + n <= CACHED_RUNS:
            return False
        order = np.argsort(-self.met, kind="stable")[: max(0, min(CACHED_RUNS // 2, CACHED_RUNS - n))]
        kept = np.sort(order[self.met[order] > 1])
        runs = list(self.places)
        self.places = {runs[old]: new for new, old in enumerate(kept.tolist())}
        size = self.starts[kept + 1] - self.starts[kept]
        self.ids, self.starts = self.gather(kept), np.concatenate([np.zeros(1, np.int32), np.cumsum(size, dtype=np.int32)])
        self.met = self.met[kept] // 2
        return True

    def gather(self, place: np.ndarray) -> np.ndarray:
        """The ids of the runs at these places in a row."""
        size = self.starts[place + 1] - self.starts[place]
        until = np.cumsum(size, dtype=np.int32)
        return self.ids[np.repeat(self.starts[place] - until + size, size) + np.arange(until[-1] if len(until) else 0, dtype=np.int32)]

    @functools.cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, runs: list[str]) -> None:
        found = []
        for at in range(0, len(runs), TOGETHER):
            some = runs[at : at + TOGETHER]
            line = " ".join(some)
            if not line.isascii():
                line = line.encode().decode("latin-1")
                for byte, name in self.names:
                    line = line.replace(byte, name)
            ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            if np.count_nonzero(self.ends[ids]) != len(some):
                raise ValueError("the tokenizer cuts runs otherwise")
            found.append(ids)
        ids = np.concatenate([np.zeros(0, "<u4"), *found])
        self.places.update(zip(runs, range(len(self.places), len(self.places) + len(runs))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + 1 + np.flatnonzero(self.ends[ids]).astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        self.met = np.concatenate([self.met, np.zeros(len(runs), np.int32)])

    def encode_all(self, runs: pa.StringArray, bounds: np.ndarray) -> list[np.ndarray]:
        """Ids of texts that are cut into runs, those between two successive ``bounds``."""
        found = runs.dictionary_encode()
        each, code = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
        place = self.find(each)
        new = np.flatnonzero(place < 0)
        if self.make_room(len(new)):
            place = self.find(each)
            new = np.flatnonzero(place < 0)
        place[new] = np.arange(len(self.places), len(self.places) + len(new))
        self.learn([each[i] for i in new.tolist()])
        self.met[place] += 1
        place = place[code]
        until = np.concatenate([np.zeros(1, np.int32), np.cumsum(self.starts[place + 1] - self.starts[place], dtype=np.int32)])
        ids, bounds = self.gather(place), until[bounds]
        return [ids[i:j] for i, j in zip(bounds, bounds[1:])]


@functools.cache
def run_ids(path: str) -> RunIds:
    """One per Python worker, so that its tasks share what is remembered."""
    return RunIds(path)


def encoded(texts: pa.Array, runs: RunIds) -> Iterator[np.ndarray]:
    """Ids of every text, some texts at a time; a null one is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, buffer = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):  # at least one text
        until = max(at + 1, int(np.searchsorted(bounds, bounds[at] + WAITING_BYTES, side="right")) - 1)
        own, part = bounds[at : until + 1] - bounds[at], data[bounds[at] : bounds[until]]
        kind = KIND_OF_BYTE[part]
        plain = is_plain(part, kind, own)
        size = np.diff(own)
        if not plain.all():
            kept = np.repeat(plain, size)
            part, kind = part[kept], kind[kept]
        known = iter(runs.encode_all(*cut_runs(part, kind, np.concatenate([np.zeros(1, np.int64), np.cumsum(size[plain])]))))
        for i, is_cut in enumerate(plain.tolist(), at):
            yield next(known) if is_cut else runs.encode(texts[i].as_py())
        at = until


def cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of the rows (doc_id, text) of ``batches``, a few hundred texts at a time, so that a task holds little text as Python objects."""
    names = [*PIECE, "ids"] if with_ids else list(PIECE)
    runs, end, step = run_ids(path), np.array([end_id], "<u4").tobytes(), 4 * capacity
    for batch in small_batches(batches):
        rows = []
        for row, own in enumerate(encoded(batch.column("text"), runs)):
            ids = own.tobytes() + end
            for piece, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                rows.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
        of, *numbers, parts = zip(*rows)
        columns = [batch.column("doc_id").take(pa.array(of)), *map(pa.array, numbers, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())] if with_ids else columns, names)


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token ids of every document (doc_id, text), cut into pieces of ``capacity`` where it is longer.

    Returns doc_id, piece, start, length, ids_crc32 and, ``with_ids``, the ids as little-endian bytes.
    A null or empty text is ``end_id`` alone. Whole-numbered ids become long, others keep their type. Rows are independent: null or repeated doc_ids and
    other columns of any name do no harm; an empty table gives no pieces.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    kind = docs.schema["doc_id"].dataType
    kept = "long" if isinstance(kind, T.IntegralType) else kind.simpleString()
    schema = ", ".join(f"{name} {kept if name == 'doc_id' else of}" for name, of in PIECE.items()) + (", ids binary" if with_ids else "")
    rows = docs.select(F.col("doc_id").cast(kept).alias("doc_id"), "text")
    return rows.mapInArrow(lambda batches: freed(cut(batches, path, capacity, end_id, with_ids)), schema)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Bins for ``counts`` documents of each length: rows (length, first rank, documents, first bin, per bin, offset).

    Each row places the documents of that length from ``first rank`` on: ``per bin`` of them in every
    bin from ``first bin`` on, the first at ``offset``. The number of rows depends on ``capacity`` alone.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    plan, first_bin = [], 0
    while left.any():
        content = fill(left, capacity)
        times = int(min(left[length] // n for length, n in content.items()))
        offset = 0
        for length, n in sorted(content.items(), reverse=True):
            plan.append((length, int(used[length]), n * times, first_bin, n, offset))
            offset += n * length
            used[length] += n * times
            left[length] -= n * times
        first_bin += times
    return plan


def fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """The next bin: document length to number of documents."""
    lengths = np.flatnonzero(left)
    content: dict[int, int] = {}
    gap = capacity
    for length in lengths[::-1].tolist():
        if length <= gap:
            content[length] = min(int(left[length]), gap // length)
            gap -= content[length] * length
    if gap and content:
        smallest = min(content)
        pair = best_two(left, content, smallest, gap + smallest)
        if pair:
            content[smallest] -= 1
            for length in pair:
                content[length] = content.get(length, 0) + 1
            content = {length: n for length, n in content.items() if n}
    return content


def best_two(left: np.ndarray, content: dict[int, int], smallest: int, room: int) -> tuple[int, int] | None:
    """The two unpacked documents with the largest sum above ``smallest`` that fit in ``room``."""
    free = left.copy()
    for length, n in content.items():
        free[length] -= n
    lengths = np.flatnonzero(free[: room + 1])
    if not len(lengths):
        return None
    # the longest partner of each length: the last one that still fits
    place = np.searchsorted(lengths, room - lengths, side="right") - 1
    alone = (place >= 0) & (lengths[place] == lengths) & (free[lengths] < 2)
    place = np.where(alone, place - 1, place)
    total = np.where(place >= 0, lengths + lengths[place], 0)
    best = int(np.argmax(total))
    return (int(lengths[best]), int(lengths[place[best]])) if total[best] > smallest else None


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ids_crc32 and more). ``pieces`` is a stored table.

    Null and repeated doc_ids are pieces like others; an empty table has no sequences; other columns stay. Only the number of pieces per length comes to the driver. Equal pieces are interchangeable.
    """
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}  # at most one row per length
    plan = np.array(sorted(plan_bins(counts, capacity)), np.int64).reshape(-1, 6)
    named = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("piece"), F.col("ids_crc32"))
    keyed = pieces.withColumn("_key", F.md5(named))
    ranked = running_sum(keyed, "length", "_key", F.lit(1), ["doc_id", "piece", "ids_crc32"], "_rank", sum(counts.values()))

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        row = plan[np.searchsorted((plan[:, 0] << 44) + plan[:, 1], (length.to_numpy() << 44) + rank.to_numpy(), side="right") - 1]
        nth = rank.to_numpy() - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + nth // row[:, 4], "offset": row[:, 5] + nth % row[:, 4] * length.to_numpy()})

    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences (sequence_id, ids as little-endian bytes) of pieces packed ``with_ids``."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one entry per token of a sequence
    parts = packed.groupBy("sequence_id").agg(in_order.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, part: F.concat(acc, part["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenises and packs ``docs`` (doc_id, text): one row per piece, with odd rows as in ``token_pieces`` and ``pack``."""
    return pack(stage(token_pieces(docs, path, capacity, end_id, with_ids), "pieces"), capacity)


def op9_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))
