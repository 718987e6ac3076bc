"""Personal data: fixed patterns per kind, and identifiers found by bootstrapping their contexts.

The fixed patterns give the seeds. Every identifier-like string of the corpus, seed or not, is an
instance; the words around it make lexical patterns. Patterns are scored by the share of their
instances that are believed to be of a kind, instances by the patterns that hold them, in turn, until
the beliefs settle; strings that trusted patterns agree on are reported as further spans of that kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.llm.common import freed, map_arrow, small_batches, table, unused
from stockwave.session import stage

KINDS = ("email", "ip", "card", "phone")
SETTLED = 1e-3  # rounds end when the beliefs together grow by less than this share
MIN_SUPPORT = 3  # believed instances a pattern needs
TRUST = 0.8  # score from which a pattern speaks for its instances
BELIEF = 0.9  # score from which an instance is reported
KNOWN = 4  # instances from which a context of two words is known well enough not to back off to one
SMOOTHING = 1.0
CONTEXT_CHARS = 48
MIN_DIGITS = 4  # of a candidate without @: shorter ones are counts, days and the like
RUN_DIGITS = 20  # the blank-parted groups of a longer run are candidates of their own
KEY_CHARS = 128  # longer strings are named by their digest

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![0-9])\(?[0-9](?:(?!\.\x20)[\x20().-]{0,2}[0-9])+")  # a full stop and a blank end a sentence
GROUP = re.compile(r"\(?[0-9][^\x20]*")  # of a number, up to the next blank
TELLING = re.compile(r"[0-9@]")
BLANK = frozenset(" \t\n\v\f\r")
EDGES = ".,;:!?()\"'[]{}<>*$%&#|="


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; the local part reaches back to the match before, in linear time."""
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            last = match.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 16 <= len(digits) <= 19 and passes_luhn(digits)


def is_phone(text: str) -> bool:
    return 8 <= len(digits_of(text)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start; a match that fails its kind's test is dropped."""
    found = [(0, *span) for span in emails(text)]
    for number, (pattern, test) in enumerate(((IP, is_ip), (CARD, is_card), (PHONE, is_phone)), 1):
        found += [(number, m.start(), m.end()) for m in pattern.finditer(text) if test(m.group())]
    return found


def shape_of(text: str) -> str:
    if "@" in text:
        return "mail"
    return "mixed" if any(c.isalpha() for c in text) else "number"


def candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like strings outside the spans already taken: numbers, and words with an @ or letters and digits."""
    busy = sorted((start, end) for _, start, end in taken)
    covered: list[tuple[int, int]] = []
    for start, end in busy:
        if covered and start <= covered[-1][1]:
            covered[-1] = covered[-1][0], max(end, covered[-1][1])
        else:
            covered.append((start, end))
    pos, n, next_busy = 0, len(text), 0
    while match := TELLING.search(text, pos):
        start = match.start()
        while next_busy < len(covered) and covered[next_busy][1] <= start:
            next_busy += 1
        if next_busy < len(covered) and covered[next_busy][0] <= start:
            pos = covered[next_busy][1]
            continue
        limit = covered[next_busy][0] if next_busy < len(covered) else n
        number = NUMBER.match(text, start, limit)
        n_digits = len(digits_of(number.group())) if number else 0
        if n_digits >= MIN_DIGITS and (start == 0 or not text[start - 1].isalnum()) and (number.end() == n or not text[number.end()].isalnum()):
            if n_digits <= RUN_DIGITS:
                yield start, number.end()
            else:
                for group in GROUP.finditer(text, start, number.end()):
                    if len(digits_of(group.group())) >= MIN_DIGITS:
                        yield group.span()
            pos = number.end()
            continue
        left, right = start, start + 1
        while left > pos and text[left - 1] not in BLANK:
            left -= 1
        while right < limit and text[right] not in BLANK:
            right += 1
        pos = right
        word = text[left:right]
        left += len(word) - len(word.lstrip(EDGES))
        word = word.strip(EDGES)
        if "@" in word[1:-1] or any(c.isalpha() for c in word) and len(digits_of(word)) >= MIN_DIGITS:
            yield left, left + len(word)


def instance_of(text: str) -> str:
    """What an instance is known by: the string without case; its digest where it is long."""
    own = text.lower()
    return own if len(own) <= KEY_CHARS else f"md5 {hashlib.md5(own.encode('utf-8', 'surrogatepass')).hexdigest()}"


def patterns_at(text: str, start: int, end: int) -> list[str]:
    """Contexts on the line, longest first: two words before (L), one before and one after (M), one before (B), one after (A).

    The ends of the line are words. Words are cut to their last or first letters. The contexts of one
    word, to which the others back off, hold for one shape.
    """
    left, right, shape = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS), shape_of(text[start:end])
    head, tail = text[left:start].lower(), text[end:right].lower()
    first, last = "\n" in head or not left, "\n" in tail or right == len(text)
    before = ["^"] * first + [w.strip(EDGES) or w for w in head.rpartition("\n")[2].split()]
    after = [w.strip(EDGES) or w for w in tail.partition("\n")[0].split()] + ["$"] * last
    near, next_ = before[-1] if before else "", after[0] if after else ""
    return [f"L {before[-2] if len(before) > 1 else ''} {near}", f"M {near} _ {next_}", f"B {shape} {near}", f"A {shape} {next_}"]


SPANS = "array<struct<kind: int, start: int, end: int>>"
INSTANCES = "array<struct<instance: string, shape: string, kind: int, start: int, end: int, patterns: array<string>>>"

_PLACE = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
SPANS_TYPE = pa.list_(pa.struct(_PLACE))
INSTANCES_TYPE = pa.list_(pa.struct([("instance", pa.string()), ("shape", pa.string()), *_PLACE, ("patterns", pa.list_(pa.string()))]))


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, digest (MD5 of the text), base spans and all instances with their contexts, per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            spans, instances = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                found = base_spans(text)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                every = found + [(-1, s, e) for s, e in candidates(text, found)]
                instances.append([
                    {"instance": instance_of(text[s:e]), "shape": shape_of(text[s:e]), "kind": k, "start": s, "end": e, "patterns": patterns_at(text, s, e)}
                    for k, s, e in every
                ])
            columns = [batch.column("doc_id"), batch.column("digest"), pa.array(spans, SPANS_TYPE), pa.array(instances, INSTANCES_TYPE)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "spans", "instances"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.md5("text").alias("digest"), "text")
    return rows.mapInArrow(lambda batches: freed(run(batches)), f"doc_id {kind}, digest string, spans {SPANS}, instances {INSTANCES}")


def bootstrap(extracted: DataFrame) -> DataFrame:
    """(instance, kind, score) of strings that are no seeds but that trusted patterns hold to be of a kind.

    The graph has one edge per pattern and instance, however often they meet. A pattern's score for a
    kind is the belief in its instances over their number; an instance's belief is one less the
    product of the doubts of its trusted patterns. Contexts of one word speak where no longer one of the
    instance is trusted or known from several instances. Strings are believed only where their shape (mail,
    number or mixed) occurs among the kind's seeds. Beliefs only ever grow, up to 1, so the rounds come to an end.
    """
    flat = extracted.select(F.explode("instances").alias("i")).select("i.*")
    nodes = stage(flat.groupBy("instance", "shape").agg(F.max("kind").alias("kind")), "pii-instances")  # a seed in any place is a seed
    edges = stage(flat.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pii-edges")
    short = F.col("pattern").rlike("^[AB] ")
    seeds = nodes.where("kind >= 0").select("instance", "kind", F.lit(1.0).alias("belief"))
    shapes = F.broadcast(nodes.where("kind >= 0").select("kind", "shape").distinct())  # at most kinds x 3
    sizes = stage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MIN_SUPPORT), "pii-patterns")  # others are never trusted
    unseen = nodes.where("kind < 0").select("instance", "shape")
    well_known = edges.where(~short).join(sizes.where(F.col("n") >= KNOWN), "pattern").join(unseen, "instance", "left_semi")
    unseen = stage(unseen.join(well_known.select("instance", F.lit(True).alias("known")).distinct(), "instance", "left"), "pii-unseen")
    asked = stage(edges.join(sizes.select("pattern"), "pattern", "left_semi"), "pii-asked")
    found, total = None, 0.0
    while True:
        believed = seeds if found is None else seeds.unionByName(found)
        votes = asked.join(believed, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("votes"), F.count(F.lit(1)).alias("support"))
        trusted = votes.where(F.col("support") >= MIN_SUPPORT).join(sizes, "pattern")
        trusted = trusted.select("pattern", "kind", (F.col("votes") / (F.col("n") + SMOOTHING)).alias("trust")).where(F.col("trust") >= TRUST)
        doubt = F.log1p(-F.col("trust"))
        doubts = asked.join(trusted, "pattern").groupBy("instance", "kind").agg(F.sum(F.when(~short, doubt)).alias("long"), F.sum(F.when(short, doubt)).alias("short"))
        told = doubts.join(unseen, "instance").join(shapes, ["kind", "shape"])
        told = told.withColumn("doubt", F.least("long", F.when(F.col("known").isNull(), F.col("short"))))
        found = stage(told.where(F.col("doubt").isNotNull()).select("instance", "kind", (1 - F.exp("doubt")).alias("belief")), "pii-beliefs")
        before, total = total, found.agg(F.sum("belief")).head()[0] or 0.0
        if total - before <= SETTLED * total:
            break
    best = F.row_number().over(Window.partitionBy("instance").orderBy(F.desc("belief"), "kind"))  # at most one row per kind
    return found.where(F.col("belief") >= BELIEF).withColumn("_r", best).where("_r = 1").select("instance", "kind", F.col("belief").alias("score"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, digest, base spans, and all spans by kind and start, per row of ``docs`` (doc_id, text).

    Spans count code points, ends exclusive. Null text is empty; null and repeated doc_ids are rows like
    others; rows equal in doc_id and text have equal spans; an empty table gives no rows. Every text is
    read whole; other columns are not read.
    """
    extracted = stage(extract(docs), "pii-extracted")
    unseen = extracted.select("doc_id", "digest", F.explode("instances").alias("i")).where("i.kind < 0")
    unseen = unseen.select("doc_id", "digest", "i.instance", "i.start", "i.end")
    found = unseen.join(bootstrap(extracted), "instance").select("doc_id", "digest", F.struct(F.col("kind").cast("int").alias("kind"), "start", "end").alias("span")).distinct()
    added = found.groupBy("doc_id", "digest").agg(F.collect_list("span").alias("added"))  # of one text
    a = added.withColumnsRenamed({"doc_id": "_doc", "digest": "_digest"})
    rows = extracted.select("doc_id", "digest", "spans").join(a, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("digest").eqNullSafe(F.col("_digest")), "left")
    every = F.array_sort(F.concat("spans", F.coalesce("added", F.array().cast(SPANS))))
    return rows.select("doc_id", "digest", F.col("spans").alias("base"), every.alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; overlapping spans become one.

    Rows, their other columns and null texts stay as they are, repeated rows and ids included; an empty table gives no
    rows. Texts are read as in ``find``.
    """
    doc, digest, own, listed_ = unused(docs, "doc", "digest", "own_digest", "spans")
    spans = find(docs).where(F.size("spans") > 0)
    spans = spans.select(F.col("doc_id").alias(doc), F.col("digest").alias(digest), F.col("spans").alias(listed_)).distinct()
    columns = docs.columns

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in small_batches(batches):
            found = batch.column(listed_)
            some = pc.fill_null(pc.greater(pc.list_value_length(found), 0), False)
            clean = [masked(t, f) for t, f in zip(batch.column("text").filter(some).to_pylist(), found.filter(some).to_pylist())]
            out = list(batch.columns[: len(columns)])
            out[at] = pc.replace_with_mask(out[at], some, pa.array(clean, out[at].type))
            yield pa.RecordBatch.from_arrays(out, columns)

    keyed = docs.withColumn(own, F.md5("text"))
    joined = keyed.join(spans, F.col("doc_id").eqNullSafe(F.col(doc)) & F.col(own).eqNullSafe(F.col(digest)), "left")
    return map_arrow(joined.select(*[f"`{c}`" for c in columns], listed_), replace, docs.schema)


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars, where ``docs`` has it and the text is not null, set to the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def masked(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    out, at = [], 0
    for start, kind, end in sorted((s["start"], s["kind"], s["end"]) for s in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def listed(spans: F.Column) -> F.Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    """The digest that the query reports, from plain spans; for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def op7_contexts(spark: SparkSession, folder: str) -> DataFrame:
    found = find(table(spark, folder, "documents"))
    counts = [F.size(F.array_remove(F.transform("base", lambda s: s["kind"]), i)) for i in range(len(KINDS))]
    counts = [(F.size("base") - rest).cast("long").alias(f"n_{kind}") for kind, rest in zip(KINDS, counts)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
