"""Benchmark decontamination: an FM-index per shard of training texts, searched backwards for test phrases.

A shard is a run of successive rows of a scan task, so nothing is shuffled and no key can be hot. Its
equal texts are indexed once. Test phrases are the windows of the benchmark's items; blocks of items
of bounded size are sent to the tasks one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwave.llm.common import let, map_arrow, table
from stockwave.llm.fm_index import FMIndex
from stockwave.session import stage

WINDOW = 10  # words that give a leak away
SHARD_BYTES = 12_000_000  # of text to an index; a longer text has one of its own
BLOCK_BYTES = 4_000_000  # of benchmark text sent to the tasks at a time
HASHED_BYTES = 1 << 20  # hashed at a time
MARKED = 1 << 20  # occurrences marked at a time
RESULTS = ("n_words", "n_hit", "spans", "items")

#: Bytes of words: 0-9, a-z, A-Z as a-z, and all of characters beyond ASCII.
IN_WORD = np.array([48 <= b < 58 or 97 <= (b | 32) < 123 or b > 127 for b in range(256)])
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD1342543DE82EF95], np.uint64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    x = (x + _MIX[0]) * _MIX[1]
    x = (x ^ (x >> np.uint64(31))) * _MIX[2]
    return x ^ (x >> np.uint64(29))


BYTE_VALUES = _scrambled(np.array([b | 32 if 65 <= b < 91 else b for b in range(256)], np.uint64) * _MIX[0])


def hash_runs(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the successive runs of values; 0 for an empty one."""
    out = np.zeros(len(lengths), np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    lengths = lengths[full]
    powers = np.full(int(lengths.max()), _MIX[3])
    powers[0] = 1
    np.cumprod(powers, out=powers)
    ends = np.cumsum(lengths)
    at, done = 0, 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, done + HASHED_BYTES, "right")))
        starts = ends[at:to] - lengths[at:to] - done
        place = np.arange(int(ends[to - 1]) - done) - np.repeat(starts, lengths[at:to])
        out[full[at:to]] = _scrambled(np.add.reduceat(values[done : ends[to - 1]] * powers[place], starts))
        at, done = to, int(ends[to - 1])
    return out


class Words:
    """The words of some texts: hashes, and where they start and end among the texts' bytes."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.bytes = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        inside = IN_WORD[self.bytes]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]  # a word does not go on in the next text
        first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.hashes = hash_runs(BYTE_VALUES[self.bytes[inside]], self.ends - self.starts)
        before = np.searchsorted(self.starts, self.offsets)
        self.before, self.counts = before[:-1], np.diff(before)  # words before each text, and in it

    def code_points(self, text: int, byte_offsets: np.ndarray) -> np.ndarray:
        """Characters of a text before each of the byte offsets."""
        own = self.bytes[self.offsets[text] : self.offsets[text + 1]]
        return np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])[byte_offsets - self.offsets[text]]


class Phrases:
    """The distinct windows of some items, by length, and the items of each."""

    def __init__(self, texts: Sequence[str | None], window: int):
        words = Words(pa.array(texts, pa.large_string()))
        size = np.minimum(words.counts, window)
        n = np.where(size > 0, words.counts - size + 1, 0)
        item = np.repeat(np.arange(len(n)), n)
        at = words.before[item] + np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
        self.groups = []
        for length in np.unique(size[size > 0]).tolist():
            own = size[item] == length
            rows = words.hashes[at[own][:, None] + np.arange(length)]
            _, first, which = np.unique(hash_runs(rows.ravel(), np.full(len(rows), length)), return_index=True, return_inverse=True)
            by = np.argsort(which, kind="stable")
            ends = np.cumsum(np.bincount(which, minlength=len(first)))
            self.groups.append((rows[first], item[own][by], np.concatenate([[0], ends])))  # windows, items by window, where they start


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] times, for every i."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def occurrences(index: FMIndex, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, int, tuple[np.ndarray, np.ndarray]]]:
    """(text, word, window length, (text, item) pairs) of all occurrences, a bounded number at a time."""
    for windows, items, item_starts in phrases.groups:
        lo, hi = index.search(windows)
        found = np.flatnonzero(lo < hi)
        total = np.cumsum(hi[found] - lo[found])
        for part in range(0, int(total[-1]) if len(total) else 0, MARKED):
            wanted = np.arange(part, min(part + MARKED, int(total[-1])))
            which = np.searchsorted(total, wanted, "right")
            phrase = found[which]
            text, word = index.text_of(index.locate(hi[phrase] - (total[which] - wanted)))
            pair = np.unique(text * len(windows) + phrase)
            own_text, own_phrase = pair // len(windows), pair % len(windows)
            n = item_starts[own_phrase + 1] - item_starts[own_phrase]
            yield text, word, windows.shape[1], (np.repeat(own_text, n), items[expand(item_starts[own_phrase], n)])


def search_shard(texts: pa.Array, phrases: Phrases) -> tuple[Words, np.ndarray, list[np.ndarray]]:
    """The texts' words, which of them lie in an occurrence, and per text the items with any."""
    words = Words(texts)
    same = hash_runs(words.hashes, words.counts)
    _, first, which = np.unique(same, return_index=True, return_inverse=True)
    lengths, begins = words.counts[first], words.before[first]
    index = FMIndex(words.hashes[expand(begins, lengths)], lengths)
    edge = np.zeros(int(lengths.sum()) + 1, np.int64)  # +1 where an occurrence starts, -1 after its end
    starts, pairs, n_items = np.cumsum(lengths) - lengths, [], 1 + max((int(g[1].max()) for g in phrases.groups), default=0)
    for text, word, length, (own, item) in occurrences(index, phrases):
        at = starts[text] + word
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        pairs = [np.unique(np.concatenate([*pairs, own * n_items + item]))]
    hit = np.cumsum(edge[:-1]) > 0
    pair = pairs[0] if pairs else np.zeros(0, np.int64)
    found = np.split(pair % n_items, np.searchsorted(pair // n_items, np.arange(1, len(first))))
    return words, hit[expand(starts[which], words.counts)], [found[i] for i in which]


def runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shards(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.Table]:
    """Successive rows with about ``SHARD_BYTES`` of text; a longer text is alone."""
    held, size = [], 0
    for batch in batches:
        column = batch.column(text).cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + SHARD_BYTES - size, "right")) - 1)
            if held and size + ends[to] - ends[at] > SHARD_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                continue
            held.append(batch.slice(at, to - at))
            size += int(ends[to] - ends[at])
            at = to
    if held:
        yield pa.Table.from_batches(held)


def benchmark_blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[list, list]]:
    """(ids, texts) of blocks of items of about ``BLOCK_BYTES``; equal rows once, a longer item is alone.

    The texts pass the driver block by block.
    """
    items = benchmark.select(F.col(item).alias("id"), F.col(text).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    if blocks > 1:
        items = stage(items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))), "benchmark")
    for block in range(blocks):
        rows = (items.where(F.col("block") == block) if blocks > 1 else items).select("id", "text").collect()  # about BLOCK_BYTES
        yield [r.id for r in rows], [r.text for r in rows]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id", carry: Sequence[str] | None = None
) -> DataFrame:
    """Where texts hold windows of the benchmark's items: the columns of ``docs`` (or those of ``carry``) and four more.

    ``n_words`` long; ``n_hit`` long, the words inside an occurrence; ``spans``, merged runs of such words
    as (start, end) code points of the text, end exclusive; ``items``, the ids of the items with an
    occurrence, each once. Words are runs of 0-9, a-z (A-Z alike) and characters beyond ASCII. A window is ``window``
    successive words of an item; an item of fewer words is one window; without words it has none. Words
    are compared by 64-bit hashes.

    A null or empty text has no words. Very long texts get an index of their own. Repeated rows, equal
    texts and repeated ids each get their own row of the result; ties cannot occur. Items whose id is null mark
    words but are not listed. Empty tables give no rows, or no hits. Columns of ``docs`` that are called
    like the new ones are replaced, all others are passed on unseen. Rows of the result that were
    made for earlier blocks of the benchmark are stored in between.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    read = docs.select(*[f"`{c}`" for c in kept], *([] if text in kept else [f"`{text}`"]))
    hidden = "_" * (1 + max(map(len, read.columns))) + "hit_words"  # no column is called that
    items = T.ArrayType(benchmark.schema[item].dataType)
    none = F.array().cast("array<struct<start:int,end:int>>")
    found = read.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), none.alias("spans"), F.array().cast(items).alias("items"), none.alias(hidden))
    schema, context, n_kept, blocks = found.schema, docs.sparkSession.sparkContext, len(read.columns), 0

    def searched(rows: DataFrame, ids: list, texts: list) -> DataFrame:
        sent = context.broadcast((ids, texts))
        return map_arrow(rows, lambda batches: mark(batches, *sent.value, window, text, n_kept), schema)

    for ids, texts in benchmark_blocks(benchmark, item, text):
        found, blocks = searched(stage(found, "leaks") if blocks else found, ids, texts), blocks + 1
    return (found if blocks else searched(found, [], [])).select(*[f"`{c}`" for c in kept], *RESULTS)


def mark(batches: Iterator[pa.RecordBatch], ids: list, texts: list, window: int, text: str, n_kept: int) -> Iterator[pa.RecordBatch]:
    """Rows with the hits of these items added to what earlier blocks have found.

    The columns after the first ``n_kept`` are n_words, n_hit, spans, items and the hit words as (start, end).
    """
    phrases = Phrases(texts, window)
    for shard in shards(batches, text):
        words, hit, items = search_shard(shard.column(text).cast(pa.large_string()).combine_chunks(), phrases)
        n, known, earlier = shard.num_rows, shard.column(n_kept + 3), shard.column(n_kept + 4)
        n_hit, spans, listed, ranges = np.zeros(n, np.int64), [[]] * n, [[]] * n, [[]] * n
        sums = np.concatenate([[0], np.cumsum(hit)])
        some = (sums[words.before + words.counts] > sums[words.before]) | (pc.list_value_length(earlier).to_numpy() > 0)
        for i in np.flatnonzero(some):
            at, own = words.before[i], hit[words.before[i] : words.before[i] + words.counts[i]]
            for r in earlier[i].as_py():
                own[r["start"] : r["end"]] = True
            a, b = runs(own)
            chars = zip(words.code_points(i, words.starts[at + a]).tolist(), words.code_points(i, words.ends[at + b - 1]).tolist())
            spans[i] = [{"start": x, "end": y} for x, y in chars]
            ranges[i] = [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())]
            listed[i] = list(dict.fromkeys([*known[i].as_py(), *(ids[j] for j in items[i] if ids[j] is not None)]))
            n_hit[i] = np.count_nonzero(own)
        columns = [pa.array(v, f.type) for v, f in zip((words.counts, n_hit, spans, listed, ranges), list(shard.schema)[n_kept:])]
        yield from pa.Table.from_arrays([*shard.columns[:n_kept], *columns], schema=shard.schema).to_batches(max_chunksize=4096)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` with the spans of ``find_leaks`` cut out of the texts; other columns and their order stay. Null texts stay null."""
    clash = {c: f"{c}#" + "#" * max(map(len, docs.columns)) for c in RESULTS if c in docs.columns}
    found = find_leaks(docs.withColumnsRenamed(clash), benchmark, window, clash.get(text, text), item)
    spans, own = F.col("spans"), F.col(f"`{clash.get(text, text)}`")
    bounds = F.concat(F.array(F.lit(0)), F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["end"]))), F.array(F.char_length(own)))
    clean = let(bounds, lambda b: F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.substring(own, F.get(b, 2 * i) + 1, F.get(b, 2 * i + 1) - F.get(b, 2 * i))), ""))
    found = found.withColumn(clash.get(text, text), F.when(F.size(spans) == 0, own).otherwise(clean))
    return found.drop(*RESULTS).withColumnsRenamed({v: k for k, v in clash.items()}).select(*[f"`{c}`" for c in docs.columns])


def op11_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    found = find_leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), carry=["doc_id"])
    names = F.array_sort(F.array_distinct(F.transform("items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
with i as (select item_id, w, least(len(w), 10) as size from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0),
phrase as (
  select distinct item_id, size, array_to_string(w[p:p + size - 1], ' ') as phrase
  from (select *, unnest(range(1, len(w) - size + 2)) as p from i)),
d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
place as (
  select r, p, size, array_to_string(w[p:p + size - 1], ' ') as phrase
  from (select *, unnest(range(1, len(w) - size + 2)) as p
        from d cross join (select distinct size from phrase) where len(w) >= size)),
found as (select place.r, place.p, place.size, item_id from place join phrase on place.size = phrase.size and place.phrase = phrase.phrase),
hit as (select r, count(distinct word) as n_hit from (select r, unnest(range(p, p + size)) as word from found) group by r),
item as (
  select r, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct r, item_id::varchar as name from found where item_id is not null) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join item using (r)
"""
