"""Substring deduplication by hashing normalised units.

Digests of all units are grouped over the whole corpus; of equal units the earliest stays, by document
and place, and all others are listed for removal with their offsets in the original text. A unit is a
line, a paragraph or a sentence; passages are found from units of all kinds at once, from runs of short
ones, and from runs of words whose place depends on the words only, so that no mark is needed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.functions.skew import MAX_HOT_KEYS, salted_join
from stockwave.llm.common import map_arrow, small_batches, table, unused
from stockwave.session import stage

#: What ends a unit. Passages that many documents share often lie within a line, hence sentences.
ENDS = {"paragraph": r"\n[ \t\r]*\n\s*", "line": r"\n+", "sentence": r"\n+|(?<=[.!?])[ \t]+"}
UNIT = "sentence"
MIN_WORDS = 8  # shorter units repeat by chance

#: Scripts written without blanks: each character is a token, and two count as one word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff00-\uff65\U00020000-\U0003ffff"
MARKS = ".!?\u2026\u0589\u061f\u06d4\u0964\u0965\u1362\u104a\u104b\u17d4\u17d5\u3002\uff01\uff0e\uff1f\uff61"
CLOSERS = "\"')]}\u00bb\u2019\u201d\u300d\u300f\u3011\uff09"
RUN_WORDS = 16  # of a run that starts at a chosen word instead of a mark
WINDOW = 16  # of this many successive words one at least starts such a run
HOT_UNITS = 50_000  # occurrences of a unit that one task of the join should take
FILTER_BITS = 1 << 28  # of the bitmap of repeated digests
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F)  # odd, for sums modulo 2^64


def cut(text: str, ends: re.Pattern, min_words: int) -> Iterator[tuple[int, int, int, str]]:
    """(start, end, words, normal form) of the units of a text: lower case, single blanks."""
    at = 0
    for start, end in [*((m.start(), m.end()) for m in ends.finditer(text)), (len(text), len(text))]:
        own = text[at:start]
        words = own.lower().split()
        if len(words) >= min_words:
            left = at + len(own) - len(own.lstrip())
            yield left, left + len(own.strip()), len(words), " ".join(words)
        at = end


def units(docs: DataFrame, unit: str = UNIT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, start, end, n_words and a 128-bit digest (high, low) of the units of every row."""
    ends = re.compile(ENDS[unit])
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            owner, places, digests = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for start, end, n, normal in cut(text or "", ends, min_words):
                    owner.append(i)
                    places.append((start, end, n))
                    digests.append(xxhash.xxh3_128_digest(normal.encode("utf-8", "surrogatepass")))
            place = np.array(places, np.int64).reshape(-1, 3)
            digest = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            ids = batch.column("doc_id").take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c) for c in place.T.copy()), *(pa.array(c) for c in digest.T.copy())], ["doc_id", "start", "end", "n_words", "high", "low"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, end long, n_words long, high long, low long")


def repeated_units(docs: DataFrame, unit: str = UNIT, min_words: int = MIN_WORDS) -> DataFrame:
    """Units to remove: doc_id, start, end (code points, exclusive), n_words, and the kept_doc_id and kept_start of the one that stays.

    Units under ``min_words`` words are never removed, so null, empty and short texts have none. The
    earliest is that of the smallest doc_id, then of the smallest start; null ids come last. Rows with
    one doc_id count as one document, so the rows of a repeated row keep the same units. An empty table
    gives no rows; other columns are not read. Digests are grouped with partial sums; the join that
    follows can be split by Spark where a unit is in very many documents.
    """
    found = stage(units(docs, unit, min_words), "units")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "start")
    firsts = found.groupBy("high", "low").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = found.join(firsts, ["high", "low"])
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("start") == F.col("first.start"))
    return again.where(~same).select("doc_id", "start", "end", "n_words", F.col("first.doc_id").alias("kept_doc_id"), F.col("first.start").alias("kept_start")).distinct()


class Powers:
    """Powers of the bases and of their inverses, as far as asked for."""

    def __init__(self):
        self.known = 0

    def upto(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if n > self.known:
            self.known = max(1 << 14, 2 * n)
            self.tables = [tuple(self.table(x) for x in (b, pow(b, -1, 1 << 64))) for b in BASES]
        return self.tables

    def table(self, base: int) -> np.ndarray:
        factors = np.full(self.known + 1, base, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kinds_of_characters() -> np.ndarray:
    """Per code point: 1 for white space, 2 for a script without blanks, plus 4 for a mark and 8 for a closing quote or bracket."""
    kinds = np.zeros(0x110000, np.uint8)
    bounds = re.findall("(.)-(.)", UNSPACED)
    for low, high in bounds:
        kinds[ord(low) : ord(high) + 1] = 2
    for c in range(0x3001):
        if chr(c).isspace():
            kinds[c] = 1
    for more, characters in ((4, MARKS), (8, CLOSERS)):
        kinds[[ord(c) for c in characters]] += more
    return kinds


def prefix_sums(values: np.ndarray, power: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[: len(values)], dtype=np.uint64)])


def passages(text: str, kinds: np.ndarray, powers: Powers) -> np.ndarray | None:
    """Rows of (start and end, first token and token after the last, high, low) of all units of a text, sorted; two numbers of 32 bits are one of 64.

    Units are the paragraphs, lines and sentences of ``MIN_WORDS`` words or more; from every mark the
    shortest run up to a mark that has as many; and runs of ``RUN_WORDS`` words from words chosen by the
    hash of the four words there, the least in a window. A shared passage of ``RUN_WORDS + WINDOW - 1`` words
    in any place has a unit in common.
    """
    lower = text.lower()
    if len(lower) != len(text):  # offsets are those of the text
        lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    chars = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds[chars]
    blank, single = (kind & 1) > 0, (kind & 2) > 0
    if not len(chars) or blank.all():
        return None
    before = np.concatenate([[True], blank[:-1]])
    cut_here = ~blank & (before | single | np.concatenate([[False], single[:-1]]))
    starts = np.flatnonzero(cut_here)
    n = len(starts)
    stops = np.concatenate([starts[1:], [len(chars)]])
    blanks = np.concatenate([[0], np.cumsum(blank)])
    ends = stops - (blanks[stops] - blanks[starts])  # blanks follow the token
    (p0, q0), *doubles = powers.upto(len(chars) + 1)
    sums = prefix_sums(mixed(chars.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)), p0)
    token = mixed((sums[ends] - sums[starts]) * q0[starts] + (ends - starts).astype(np.uint64))
    word_start = before[starts]
    weight = np.concatenate([[0], np.cumsum(np.where(single[starts] & ~word_start, 1, 2))])

    newlines = np.concatenate([[0], np.cumsum(chars == 10)])
    n_newlines = newlines[stops] - newlines[ends]
    last = chars[ends - 1]
    after = chars[np.minimum(ends, len(chars) - 1)]
    full_stop = ((last == 46) | (last == 33) | (last == 63)) & (stops > ends) & ((after == 32) | (after == 9))
    tail = ends - 1
    closing = (kind[tail] & 8) > 0
    for _ in range(3):  # the mark before closing quotes
        tail = np.where(((kind[tail] & 8) > 0) & (tail > starts), tail - 1, tail)
    mark = (n_newlines > 0) | (((kind[tail] & 4) > 0) & ((stops > ends) | single[starts])) | (closing & single[starts])

    found = []
    for end in (n_newlines > 1, n_newlines > 0, (n_newlines > 0) | full_stop):
        end = end.copy()
        end[-1] = True
        b = np.flatnonzero(end) + 1
        found.append(np.stack([np.concatenate([[0], b[:-1]]), b], 1))
    mark[-1] = True
    b = np.flatnonzero(mark) + 1
    a = np.concatenate([[0], b[:-1]])
    at = np.searchsorted(weight[b], weight[a] + 2 * MIN_WORDS)
    found.append(np.stack([a[at < len(b)], b[at[at < len(b)]]], 1))
    if n >= 4:
        p, q = doubles[0]
        own = prefix_sums(token, p)
        gram = mixed((own[4:] - own[:-4]) * q[: n - 3])
        if len(gram) >= WINDOW:
            view = np.lib.stride_tricks.sliding_window_view(gram, WINDOW)
            a = np.unique(view.argmin(1) + np.arange(len(view)))
            b = np.searchsorted(weight, weight[a] + 2 * RUN_WORDS)
            found.append(np.stack([a[b <= n], b[b <= n]], 1))
    pairs = np.concatenate(found)
    pairs = pairs[weight[pairs[:, 1]] - weight[pairs[:, 0]] >= 2 * MIN_WORDS]
    if not len(pairs):
        return None
    joined = np.unique(pairs[:, 0] * (n + 1) + pairs[:, 1])
    a, b = joined // (n + 1), joined % (n + 1)
    digests = []
    for salt, (p, q) in enumerate(doubles, 1):
        sums = prefix_sums(mixed(token + np.uint64(salt)), p)
        digests.append(mixed((sums[b] - sums[a]) * q[a] + (b - a).astype(np.uint64)).view(np.int64))
    return np.stack([starts[a] << 32 | ends[b - 1], a << 32 | b, *digests], 1)


PLACE = ["place", "tokens", "high", "low"]


def repeated_digests(docs: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits at most of the digests that occur twice or more; only 64 bits per unit are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, powers = kinds_of_characters(), Powers()
        for batch in small_batches(batches):
            found = [x[:, 3] for t in batch.column("text").to_pylist() if t and (x := passages(t, kinds, powers)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))], ["low"])

    keys = docs.select("text").mapInArrow(run, "low long")
    many = stage(keys.groupBy("low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("low"), "repeated-digests")
    n_bits = min(FILTER_BITS, 1 << max(15, (16 * many.count()).bit_length()))
    p = F.col("low").bitwiseAND(F.lit(n_bits - 1)) + 1  # bitmaps count from 1
    at = many.select(p.alias("p")).select(F.expr("bitmap_bucket_number(p)").alias("bucket"), F.expr("bitmap_bit_position(p)").alias("bit"))
    bitmap = np.zeros(n_bits // 8, np.uint8)
    for row in at.groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).toLocalIterator():
        bitmap[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(bytes(row.bits), np.uint8)
    return bitmap


def copy_of(text: str) -> Column:
    """24 bits of the hash of a text: tells the texts of one doc_id apart."""
    return F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFF))


def passage_units(docs: DataFrame) -> DataFrame:
    """doc_id, copy (hash of the text) and the units of every row whose digest the bitmap holds to be repeated."""
    bitmap = docs.sparkSession.sparkContext.broadcast(repeated_digests(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, powers, bits = kinds_of_characters(), Powers(), bitmap.value
        for batch in small_batches(batches):
            owner, found = [np.zeros(0, np.int64)], [np.zeros((0, len(PLACE)), np.int64)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = passages(text, kinds, powers) if text else None
                if own is not None:
                    p = own[:, 3] & (len(bits) * 8 - 1)
                    own = own[(bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0]
                    owner.append(np.full(len(own), i))
                    found.append(own)
            rows, which = np.concatenate(found), pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(which), batch.column("copy").take(which), *(pa.array(c) for c in rows.T.copy())], ["doc_id", "copy", *PLACE])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", copy_of("text").alias("copy"), "text").mapInArrow(run, f"doc_id {kind}, copy long, " + ", ".join(f"{c} long" for c in PLACE))


def passage_spans(docs: DataFrame) -> DataFrame:
    """The columns of ``repeated_passages``, and copy, the hash of the text in which a span lies."""
    found = stage(passage_units(docs), "passage-units")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "copy", "place", "tokens")
    firsts = found.groupBy("high", "low").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = stage(firsts.where("n > 1").withColumnsRenamed({"high": "first_high"}), "first-units")  # others stand for themselves
    most = firsts.groupBy("low").agg(F.max("n").alias("n")).where(F.col("n") > HOT_UNITS)
    hot = most.orderBy(F.desc("n"), "low").limit(MAX_HOT_KEYS).select("low", F.ceil(F.col("n") / HOT_UNITS).cast("int").alias("_hot"))
    again = salted_join(found, firsts.drop("n"), "low", hot=hot).where("high = first_high")

    def high(pair: str) -> Column:
        return F.shiftright(pair, 32)

    def low(pair: str) -> Column:
        return F.col(pair).bitwiseAND(F.lit(0xFFFFFFFF))

    same_text = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("copy") == F.col("first.copy"))
    on_first = same_text & (high("place") < low("first.place"))  # itself, or a run that overlaps it
    kept = [F.col("first.doc_id").alias("kept_doc_id"), F.col("first.copy").alias("kept_copy"), high("first.place").alias("kept_start")]
    listed = again.where(~on_first).select("doc_id", "copy", "place", "tokens", *kept, (high("tokens") - high("first.tokens")).alias("shift"))
    # units of one passage are one span; a window holds units of one document
    key = ["doc_id", "copy", "kept_doc_id", "kept_copy", "shift"]
    order = Window.partitionBy(*key).orderBy("tokens")
    so_far = F.max(low("tokens")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = listed.withColumn("_so_far", so_far).withColumn("_new", F.when(high("tokens") <= F.col("_so_far"), 0).otherwise(1))
    spans = fresh.withColumn("_span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*key, "_span")
    n_words = F.max(low("tokens")) - F.min(high("tokens"))
    spans = spans.agg(F.min(high("place")).alias("start"), F.max(low("place")).alias("end"), n_words.alias("n_words"), F.min("kept_start").alias("kept_start"))
    return spans.select("doc_id", "copy", "start", "end", "n_words", "kept_doc_id", "kept_start")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Spans to remove, as in ``repeated_units``, from units of all kinds and runs of them (see ``passages``).

    Units that meet and repeat the same place are one span; spans that repeat different places may overlap.
    A run that overlaps its own first occurrence stays. n_words counts characters where there are no blanks. Different texts of
    one doc_id, or of none, are documents of their own, ranked by the hash of the text; the same row again is the same document. The
    table is read twice: only units whose digest occurs twice are written with their places.
    """
    return passage_spans(docs).drop("copy").distinct()


def without_repeats(docs: DataFrame, unit: str | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated passages of their texts, or the repeated units of one kind; other columns stay."""
    own = copy_of("text") if unit is None else F.lit(0).cast("long")
    spans = passage_spans(docs) if unit is None else repeated_units(docs, unit, min_words).withColumn("copy", own)
    doc, copy, mine, listed = unused(docs, "doc", "copy", "own_copy", "spans")
    spans = spans.groupBy(F.col("doc_id").alias(doc), F.col("copy").alias(copy))
    spans = spans.agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(listed))  # of one document
    columns = docs.columns

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in small_batches(batches):
            found = batch.column(listed)
            some = pc.fill_null(pc.greater(pc.list_value_length(found), 0), False)
            clean = [without(t, f) for t, f in zip(batch.column("text").filter(some).to_pylist(), found.filter(some).to_pylist())]
            out = list(batch.columns[: len(columns)])
            out[at] = pc.replace_with_mask(out[at], some, pa.array(clean, out[at].type))
            yield pa.RecordBatch.from_arrays(out, columns)

    joined = docs.withColumn(mine, own).join(spans, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(mine) == F.col(copy)), "left")
    return map_arrow(joined.select(*[f"`{c}`" for c in columns], listed), drop, docs.schema)


def without(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    out, at = [], 0
    for s in spans:  # sorted; they may overlap
        out.append(text[at : s["start"]])
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def op5_unit_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))
