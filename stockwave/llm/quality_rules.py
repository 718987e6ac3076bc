"""Quality rules: base counts, and divergence of a text from the text of its language.

Two histograms of a document, of character classes and of its language's most common words (with
one class for the rest), are compared with the same histograms over all documents of the language by
Jensen-Shannon distance. DataFrame functions only; a document never leaves its row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.llm.common import SPACE, WORD, let, table
from stockwave.session import stage

COMMON_WORDS = 30
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words in repeated windows
WINDOW = 8
GUARD_WORDS = 50  # shorter texts vary too much to be judged by divergence
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.42
CLASSES = ("upper", "digit", "symbol", "stop", "space", "other")
COUNTED = {"upper": r"\p{Lu}", "digit": "0-9", "symbol": "#*$%&|<>", "stop": ".,;:!?"}


def class_counts(text: Column) -> Column:
    """How many characters of a text are in each of ``COUNTED``, as an array: others are cut away once, then each class counts what is left."""
    every = "".join(COUNTED.values())

    def counts(left: Column) -> Column:
        return F.array(*[F.length(F.regexp_replace(left, f"[^{chars}]+", "")) for chars in COUNTED.values()])

    return let(F.regexp_replace(text, f"[^{every}]+", ""), counts)


def repeated_window_words(words: Column) -> Column:
    """Words in ``WINDOW``-word windows that occur twice or more in the text; 64-bit hashes stand for windows."""

    def hashes(of: Column) -> Column:
        own = F.transform(of, lambda w: F.xxhash64(w))
        return let(own, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)])))

    def covered(of: Column) -> Column:
        pairs = F.sort_array(F.transform(of, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            last = F.size(p) - 1
            same = F.filter(p, lambda x, j: ((j > 0) & (p[F.greatest(j - 1, F.lit(0))]["h"] == x["h"])) | ((j < last) & (p[F.least(j + 1, last)]["h"] == x["h"])))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def total(at: Column) -> Column:  # windows that overlap count their words once
            steps = F.transform(at, lambda i, j: F.when(j + 1 < F.size(at), F.least(F.lit(WINDOW), at[F.least(j + 1, F.size(at) - 1)] - i)).otherwise(WINDOW))
            return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

        return let(let(pairs, places), total)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))

    return F.when(F.size(words) > WINDOW, let(hashes(words), count)).otherwise(0)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, the class counts and the words of every document."""
    body = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(body, SPACE), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
    word_chars = F.length(F.regexp_replace(body, SPACE, ""))
    dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    raw = docs.select("doc_id", "lang", word_chars.alias("word_chars"), F.length(body).alias("n_chars"), dup.alias("n_dup_lines"), words.alias("words"), class_counts(body).alias("counted"))
    return raw.select("doc_id", "lang", "word_chars", F.get("counted", F.lit(list(COUNTED).index("symbol"))).alias("n_symbols"), "n_dup_lines", "words", all_classes().alias("classes"))


def all_classes() -> Column:
    """Counts of all ``CLASSES`` from counted (an array), n_chars and word_chars."""
    space = F.col("n_chars") - F.col("word_chars")
    other = F.col("word_chars") - reduce(Column.__add__, [F.get("counted", F.lit(i)) for i in range(len(COUNTED))])
    return F.concat("counted", F.array(space, other))


def references(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """Per language (null is one): shares of character classes, the most common words and their shares.

    Counts cover all documents. Words of equal count are ranked by code point.
    """
    body = F.coalesce("text", F.lit(""))
    counted = docs.select("lang", class_counts(body).alias("counted"), F.length(body).alias("n_chars"), F.length(F.regexp_replace(body, SPACE, "")).alias("word_chars"))
    per_class = counted.select("lang", all_classes().alias("classes"))
    totals = per_class.groupBy("lang").agg(*[F.sum(F.get("classes", F.lit(i))).alias(c) for i, c in enumerate(CLASSES)])
    chars = reduce(Column.__add__, [F.col(c) for c in CLASSES])
    shares = totals.select("lang", F.array(*[F.when(chars > 0, F.col(c) / chars).otherwise(0.0) for c in CLASSES]).alias("class_shares"))

    words = docs.select("lang", F.explode(F.split(body, SPACE)).alias("word")).where("word != ''")
    counted = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    n_words = counted.groupBy("lang").agg(F.sum("n").alias("n_words"))
    salted = counted.withColumn("_part", F.pmod(F.xxhash64("word"), F.lit(64)))
    near = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(F.desc("n"), "word"))
    top = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    ranked = salted.withColumn("_r", near).where(F.col("_r") <= common).withColumn("_r", top).where(F.col("_r") <= common)
    listed = ranked.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("_r", "word", "n"))).alias("top"))  # at most ``common`` entries
    a, b, c = shares.alias("a"), listed.alias("b"), n_words.alias("c")
    joined = a.join(b, F.col("a.lang").eqNullSafe(F.col("b.lang")), "left").join(c, F.col("a.lang").eqNullSafe(F.col("c.lang")), "left")
    return joined.select(
        F.col("a.lang").alias("ref_lang"), "class_shares",
        F.coalesce(F.col("top.word"), F.array().cast("array<string>")).alias("common_words"),
        F.coalesce(F.transform("top", lambda t: t["n"] / F.col("n_words")), F.array().cast("array<double>")).alias("word_shares"),
    )


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, the root of the divergence) of two lists of shares."""

    def part(x: Column, y: Column) -> Column:
        m = (x + y) / 2
        one = F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
        two = F.when(y > 0, y * F.log2(y / m)).otherwise(0.0)
        return (one + two) / 2

    total = F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def with_rest(shares: Column) -> Column:
    return let(shares, lambda s: F.concat(s, F.array(F.greatest(F.lit(0.0), 1 - F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x)))))


def judge(
    docs: DataFrame, common: int = COMMON_WORDS, guard_words: int = GUARD_WORDS,
    max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Base counts, distances and verdict of every row of ``docs`` (doc_id, text, lang).

    Null text counts as empty and fails the base rules; a null lang is a language of its own. Texts
    under ``guard_words`` words and texts within both limits are kept unless the base rules fail.
    Equal rows get equal verdicts; an empty table gives no rows; other columns are not read.
    """
    refs = stage(references(docs, common), "language-references")
    seen = measures(docs).join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    total = F.aggregate("classes", F.lit(0), lambda acc, x: acc + x)

    def values(words: Column) -> Column:
        n = F.size(words)
        longest = F.aggregate("common_words", F.lit(0), lambda most, w: F.greatest(most, F.octet_length(w)))
        # what no common word can equal goes first, so that few words are compared with all of them
        p_words = let(
            let(longest, lambda most: F.filter(words, lambda w: (F.octet_length(w) <= most) & F.array_contains("common_words", w))),
            lambda own: F.transform("common_words", lambda w: (F.size(own) - F.size(F.array_remove(own, w))) / F.greatest(n, F.lit(1))),
        )
        return F.struct(
            n.cast("long").alias("n_words"),
            repeated_window_words(words).cast("long").alias("n_repeat_words"),
            F.when(n >= guard_words, divergence(with_rest(p_words), with_rest(F.col("word_shares")))).alias("word_distance"),
        )

    shares = let(total, lambda t: F.transform("classes", lambda c: c / F.greatest(t, F.lit(1))))
    found = seen.select("doc_id", "word_chars", "n_symbols", "n_dup_lines", let(F.col("words"), values).alias("v"), divergence(shares, F.col("class_shares")).alias("class_distance"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    far = (F.col("n_words") >= guard_words) & ((F.col("class_distance") > max_class) | (F.col("word_distance") > max_word))
    flat = found.select(
        "doc_id", "v.n_words", F.col("word_chars").cast("long").alias("word_chars"), F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"), "v.n_repeat_words", "class_distance", "v.word_distance",
    )
    return flat.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~far)


def op6_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))
