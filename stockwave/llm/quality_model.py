"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Fitted with Spark on a bounded, documented number of labelled rows, it scores every text in time
linear in its distinct words: the pairwise term is half of the squared sums less the summed squares.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwave.llm.common import freed, map_arrow, small_batches, table, unused
from stockwave.session import scratch_path, stage

WORD_SLOTS = 4096
FACTORS = 4
MAX_FIT_ROWS = 20_000  # labelled documents used to fit, those of smallest hash
ITERATIONS = 80
THRESHOLD = 0.3
HELD_OUT_PARTS = 5
CACHED_WORDS = 100_000
BYTE_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>", b".,;:", b"!?", b" \t\r\v\f", b"\n", b"\"'()[]{}=_-+/\\@~^`")
STRUCTURE = len(BYTE_CLASSES) + 8
SIZE = WORD_SLOTS + STRUCTURE


class WordSlots(dict):
    """Hash slot of a word, remembered while a task lasts; forgets all when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        slot = zlib.crc32(word.lower().encode("utf-8", "replace")) % WORD_SLOTS
        if len(word) < 64:
            self[word] = slot
        return slot


@functools.cache
def class_of_byte() -> np.ndarray:
    """Class number per byte; bytes of other characters share the last one."""
    found = np.full(256, len(BYTE_CLASSES))
    for number, members in enumerate(BYTE_CLASSES):
        found[list(members)] = number
    return found


def features(text: str | None, n_chars: float | None, slots: WordSlots, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions and values of one document's features that are not 0; words have unit length, the rest is in 0..1."""
    text = text or ""
    words = text.split()
    n = len(words)
    counts = np.bincount(np.fromiter(map(slots.__getitem__, words), np.int64, n), minlength=WORD_SLOTS)
    at = np.flatnonzero(counts)
    values = counts[at] / max(math.sqrt(float((counts[at] ** 2).sum())), 1.0)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    shares = np.bincount(classes, np.bincount(data, minlength=256), len(BYTE_CLASSES) + 1) / max(len(data), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    twice = sum(map(str.__eq__, words, words[1:]))
    size = len(text) if n_chars is None or n_chars != n_chars or n_chars < 0 else n_chars
    rest = (
        len(set(words)) / n if n else 0.0, twice / n if n else 0.0, 1 - len(set(lines)) / len(lines) if lines else 0.0,
        min(1.0, (len(text) / n) / 20) if n else 0.0, min(1.0, math.log1p(n) / 12), min(1.0, math.log1p(float(size)) / 16), float(n < 5),
    )
    at, values = np.concatenate([at, np.arange(WORD_SLOTS, SIZE)]), np.concatenate([values, shares, rest])
    return at[values != 0], values[values != 0]


@dataclass(frozen=True)
class Model:
    """Intercept, weight per feature and factors (features x factors) of a fitted machine."""

    intercept: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        own = self.factors[at]
        pairs = ((x @ own) ** 2 - (x**2) @ (own**2)).sum() / 2
        margin = self.intercept + float(self.linear[at] @ x) + float(pairs)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, margin))))


def is_held_out():
    """Remainder 0 of the document id's CRC-32; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_PARTS == 0, F.lit(False))


def with_size(docs: DataFrame) -> DataFrame:
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.length("text"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, factors: int = FACTORS, iterations: int = ITERATIONS) -> Model:
    """Fits on the rows of ``labels`` (doc_id, quality) that are not held out, at most ``max_rows`` documents.

    Several labels of a document count by majority (a tie is 1); of documents with one doc_id the one
    with the smallest digest counts. Null ids and labels are left out. Without both labels among
    the rows the model is the constant share of label 1 (one half without rows).
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~is_held_out())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, classes = WordSlots(), class_of_byte()
        for batch in small_batches(batches):
            found = [features(t, n, slots, classes) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())]
            at, x = pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), batch.column("digest"), at, x], ["doc_id", "label", "digest", "at", "x"])

    rows = with_size(docs).select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars"), F.md5("text").alias("digest"))
    rows = rows.join(F.broadcast(chosen), "doc_id")  # at most max_rows ids
    rows = rows.mapInArrow(lambda batches: freed(extract(batches)), f"doc_id {dict(docs.dtypes)['doc_id']}, label double, digest string, at array<int>, x array<double>")
    rows = stage(rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min_by(F.struct("at", "x"), F.coalesce("digest", F.lit(""))).alias("f")), "fit-rows")
    share = rows.agg(F.avg("label")).head()[0]
    if share is None or share in (0.0, 1.0):
        odds = {None: 0.0, 0.0: -30.0, 1.0: 30.0}[share]
        return Model(odds, np.zeros(SIZE), np.zeros((SIZE, factors)))
    machine = FMClassifier(factorSize=factors, maxIter=iterations, stepSize=0.1, regParam=1e-5, initStd=0.05, seed=7, solver="adamW")
    found = machine.fit(sparse_vectors(rows.select("label", "f.at", "f.x")))
    return Model(float(found.intercept), found.linear.toArray(), found.factors.toArray())


def sparse_vectors(rows: DataFrame) -> DataFrame:
    """``rows`` (label, at, x) with sparse vectors as ``features``: stored in the form vectors have in files, and read back as such."""
    path = scratch_path(rows.sparkSession, "fit-vectors")
    parts = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(SIZE).alias("size"), F.col("at").alias("indices"), F.col("x").alias("values"))
    rows.select("label", parts.alias("features")).write.parquet(path)
    kept = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    return rows.sparkSession.read.schema(kept).parquet(path)


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` (text and perhaps n_chars) with a score from 0 to 1, the probability of label 1.

    Null and empty texts are scored from their structure. Equal rows score alike; other columns stay, and one
    that is called ``name`` is replaced.
    """
    kept = [c for c in docs.columns if c != name]
    (size,) = unused(docs, "size")
    length = F.col("n_chars") if "n_chars" in docs.columns else F.length("text")
    rows = docs.select(*[f"`{c}`" for c in kept], length.cast("double").alias(size))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, classes = WordSlots(), class_of_byte()
        for batch in small_batches(batches):
            texts, sizes = batch.column("text").to_pylist(), batch.column(size).to_pylist()
            scores = [model.score(*features(t, n, slots, classes)) for t, n in zip(texts, sizes)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(scores, pa.float64())], [*kept, name])

    return map_arrow(rows, score, T.StructType([*[docs.schema[c] for c in kept], T.StructField(name, T.DoubleType())]))


def op10_factorisation_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs, table(spark, folder, "labels"))
    scored = with_score(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
