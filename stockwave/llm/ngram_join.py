"""Exact Jaccard join of word n-gram sets by universe partition and the pigeonhole principle.

Sets are 64-bit shingle hashes. The hash range is cut into units, as many per size band as the greatest
number of differing shingles of a pair, and some more. Most units are segments of their own, whose
subsets must be equal in at least one segment of every pair sought; where two units form a segment,
subsets may differ by one shingle, so the subset and its one-deletion neighbourhood are indexed. A
cost model picks the number of each per band. Of the equal-subset segments a document indexes
only as many as the principle asks for, largest subsets first: an order that both documents of a pair
share, so none is lost.

Documents with equal sets form one class. Classes that share an index entry are verified by
intersecting their sets: first against one leader per entry, then, where they are not yet
connected, against the others that have that leader, in blocks. Since Jaccard distance is a metric, classes
whose distances from a leader differ by more than a link allows cannot be linked.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.llm.common import freed, row_order, small_batches, table, unused, word_count
from stockwave.llm.components import components
from stockwave.session import stage

SHINGLE = 5
FIRST_BAND = 4  # smaller sets are linked to equal ones only
BANDS = 26
CHANCE = 0.1  # cost model: chance that a shingle is shared by an unrelated text; short texts, more often
SPURIOUS = 200.0  # cost model: what verifying the matches of an empty subset costs, in index rows
APART = 0.2  # the greatest Jaccard distance of a link
NEAR = 0.7  # Jaccard distance up to which a class joins the group of a leader
FILTER_BITS = 1 << 27  # of the bitmap of wanted texts, 16 MB
BLOCK_SHINGLES = 500_000  # shingles of the sets that are compared in one task, on either side
CACHED_WORDS = 100_000
MASK = (1 << 64) - 1
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash per word, remembered while a task lasts; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = value
        return value


@functools.cache
def powers(size: int) -> list[np.uint64]:
    return [np.uint64(pow(0xD6E8FEB86659FD93, i, 1 << 64)) for i in range(size)]


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams; of the whole sequence where it is shorter. A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and blanks only
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(w))
    found = np.full(len(w) - n + 1, np.uint64(n * int(STEP) & MASK))
    for i, p in enumerate(powers(n)):
        found += w[i : len(w) - n + 1 + i] * p
    return np.unique(mix(found))


@functools.cache
def band_plan(band: int) -> tuple[int, int, int]:
    """(equal-subset segments, one-deletion segments, index entries a pair shares at least) of a band.

    Band b holds the smaller sets of a pair of FIRST_BAND * 2**b up to twice that many shingles.
    """
    low = FIRST_BAND << band
    most = (2 * low - 1) // 4  # shingles in which a pair may differ
    size, chance = 1.4 * low, CHANCE + 1 / low

    def cost(n_deletion: int) -> float:
        per_unit = size / (most + 1)
        equal = (most + 1 - 2 * n_deletion) * (1 + SPURIOUS * chance**per_unit)
        return equal + n_deletion * (1 + 2 * per_unit) * (1 + SPURIOUS * chance ** (2 * per_unit - 1))

    n_deletion = min(range((most + 1) // 2 + 1), key=cost)
    common = 1 if n_deletion else 1 + most // 10
    return most + common - 2 * n_deletion, n_deletion, common


def band_of(n: int) -> int:
    return (n // FIRST_BAND).bit_length() - 1


def places(n: int) -> list[tuple[int, int]]:
    """(band, shingles in which a partner may differ) for each band in which a set of n shingles is indexed."""
    if n < FIRST_BAND:
        return []
    own = band_of(n)
    found = [(own, (n + n * 5 // 4) // 9)]
    low = FIRST_BAND << own
    if own and -(-4 * n // 5) < low:
        found.append((own - 1, (n + low - 1) // 9))
    return found


def entries(own: np.ndarray) -> np.ndarray:
    """Index entries of a sorted set."""
    found = []
    value = mix(own ^ STEP)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    for band, differ in places(len(own)):
        n_equal, n_deletion, common = band_plan(band)
        units = n_equal + 2 * n_deletion
        unit = ((own >> np.uint64(32)) * np.uint64(units)) >> np.uint64(32)
        bound = np.searchsorted(unit, np.arange(units + 1, dtype=np.uint64))
        salt = np.uint64(((band + 1) << 40) & MASK)
        if n_deletion:
            edge = bound[: 2 * n_deletion + 1 : 2]
            subset = sums[edge[1:]] - sums[edge[:-1]]
            number = np.arange(n_deletion, dtype=np.uint64) + salt
            segment = (unit[: edge[-1]] >> np.uint64(1)).astype(np.int64)
            found += [mix(subset ^ mix(number)), mix((subset[segment] - value[: edge[-1]]) ^ mix(number[segment]))]
        keep = min(n_equal, max(0, differ + common - 2 * n_deletion))
        if keep:
            edge = bound[2 * n_deletion :]
            subset = sums[edge[1:]] - sums[edge[:-1]]
            entry = mix(subset ^ mix(np.arange(2 * n_deletion, units, dtype=np.uint64) + salt))
            found.append(entry[np.lexsort((entry, edge[:-1] - edge[1:]))[:keep]])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def class_of(own: np.ndarray) -> int:
    """One 64-bit number per set."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(own.tobytes()), ">i8")[0])


def shared_entries() -> Column:
    """How many index entries a class of ``n`` shingles shares with every class it is linked to, at least."""
    at_least = F.lit(1)
    for band in range(BANDS):
        low = FIRST_BAND << band
        own = band_plan(band)[2]
        below = band_plan(band - 1)[2] if band else own
        in_both = (F.col("n") * 4 + 4).cast("long") / 5
        at_least = F.when(F.col("n") >= low, F.when(F.floor(in_both) < low, min(own, below)).otherwise(own)).otherwise(at_least)
    return at_least


def indexed(docs: DataFrame) -> DataFrame:
    """doc_id, digest (MD5 of the text), n (set size), class (null for an empty set) and index entries of each row.

    A task lists the entries of a class once, however many copies it meets.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, digest string, n long, class long, entries array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in small_batches(batches):
            sizes, classes, parts = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingles(text, hashes)
                name = class_of(own) if len(own) else None
                sizes.append(len(own))
                classes.append(name)
                parts.append(np.zeros(0, np.uint64) if name is None or name in seen else entries(own))
                seen.add(name)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["doc_id", "digest", "n", "class", "entries"],
            )

    return docs.select("doc_id", F.md5("text").alias("digest"), "text").mapInArrow(lambda batches: freed(run(batches)), schema)


def met_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (entry, class): the distinct ones whose entry holds two classes or more.

    Only the last row of a batch is carried to the next, so an entry may hold any number of classes.
    """
    last, last_out = None, False  # the row carried, and whether its entry is known to hold another class
    for batch in batches:
        entry, own = batch.column("entry").to_numpy(), batch.column("class").to_numpy()
        if last is not None:
            entry, own = np.concatenate([[last[0]], entry]), np.concatenate([[last[1]], own])
        if not len(entry):
            continue
        new = np.ones(len(entry), bool)
        new[1:] = (entry[1:] != entry[:-1]) | (own[1:] != own[:-1])
        entry, own = entry[new], own[new]
        same = entry[1:] == entry[:-1]
        many = np.zeros(len(entry), bool)
        many[1:] |= same
        many[:-1] |= same
        if last_out:
            many[0] = True
        last, last_out = (entry[-1], own[-1]), bool(many[-1])
        out = many[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(entry[:-1][out]), pa.array(own[:-1][out])], ["entry", "class"])
    if last is not None and last_out:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int64())], ["entry", "class"])


def with_distance(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds the shared and the united number of shingles to pairs of classes (a, b)."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", F.size(F.array_intersect("_a", "_b")))
    return both.select(*pairs.columns, "shared", (F.size("_a") + F.size("_b") - F.col("shared")).alias("united"))


def is_link(percent: int) -> Column:
    return F.col("shared") * 100 >= F.col("united") * percent


def connected(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, component) of the classes that have links."""
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = rows.select(F.explode("entries").alias("entry"), "class")
    members = listed.repartition(n_parts, "entry").sortWithinPartitions("entry", "class").mapInArrow(lambda batches: freed(met_twice(batches)), "entry long, class long")
    members = stage(members, "ngram-members")
    counted = members.groupBy("class").agg(F.count(F.lit(1)).alias("weight")).join(classes.select("class", "n", "first"), "class")
    active = stage(counted.where(F.col("weight") >= shared_entries()), "ngram-active")
    own = shingle_sets(docs, active)
    sets = stage(own, "ngram-sets")

    # every class of an entry against the one that shares the most entries, its leader
    by_entry = Window.partitionBy("entry")
    leader = F.max(F.struct("weight", "class")).over(by_entry)["class"]
    ranked = members.join(active.select("class", "weight"), "class").withColumn("leader", leader).where("class <> leader").drop("weight")
    ranked = stage(ranked, "ngram-star")
    tried = stage(with_distance(ranked.select(F.col("class").alias("a"), F.col("leader").alias("b")).distinct(), sets), "ngram-tried")
    links = tried.where(is_link(80)).select("a", "b")
    known = components(links).withColumnRenamed("node", "class")

    # each class joins the largest group of a leader it is near to, and groups are settled within
    away = (1 - F.col("shared") / F.col("united")).alias("away")
    star = stage(tried.select(F.col("a").alias("class"), F.col("b").alias("leader"), away), "ngram-distances")
    near = star.where(F.col("away") <= NEAR)
    size = near.groupBy("leader").agg(F.count(F.lit(1)).alias("size"))
    chosen = near.join(size, "leader").groupBy("class").agg(F.max(F.struct("size", "leader", "away")).alias("best")).select("class", "best.leader", "best.away")
    heads = chosen.select(F.col("leader").alias("class")).distinct()
    own = heads.select("class", F.col("class").alias("leader"), F.lit(0.0).alias("away"))
    grouped = stage(chosen.join(heads, "class", "left_anti").unionByName(own), "ngram-groups")
    group_of = grouped.select("class", F.col("leader").alias("grp"))
    found = leader_links(grouped, known, group_of.withColumn("grp", F.col("class")), active, sets)
    known = joined_by(known, found)

    # then all classes of different groups that have a leader in common
    return joined_by(known, leader_links(star, known, group_of, active, sets))


def joined_by(known: DataFrame, links: DataFrame) -> DataFrame:
    """(class, component) after more links."""
    edges = known.select(F.col("class").alias("a"), F.col("component").alias("b")).unionByName(links)
    return components(edges).withColumnRenamed("node", "class")


def leader_links(star: DataFrame, known: DataFrame, group_of: DataFrame, active: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes that have a leader in common: at least one per class and component linked to it.

    Only classes outside the leader's component are asked, against those of other groups, in blocks of
    bounded size: as sets are compared within a block, no pairs are listed. Classes whose distances
    from the leader differ by more than a link allows are passed over.
    """
    of_leader = known.select(F.col("class").alias("leader"), F.col("component").alias("_leader_component"))
    placed = star.join(known, "class", "left").join(of_leader, "leader", "left").join(group_of, "class", "left").join(active.select("class", "n"), "class")
    component = F.coalesce("component", "class")
    placed = placed.select("leader", "class", "away", "n", F.coalesce("grp", "class").alias("grp"), component.alias("component"), (component != F.coalesce("_leader_component", "leader")).alias("open"))
    placed = stage(placed, "ngram-near")
    open_n = F.when(F.col("open"), F.col("n"))
    sizes = placed.groupBy("leader").agg(
        F.ceil(F.sum(open_n) / BLOCK_SHINGLES).cast("int").alias("n_asked"), F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("n_parts"),
        F.min(F.when(F.col("open"), F.col("away"))).alias("nearest"), F.min("grp").alias("low"), F.max("grp").alias("high"),
    ).where("n_asked is not null and low <> high")
    rows = placed.join(sizes, "leader").where(F.col("away") >= F.col("nearest") - APART - 1e-9).join(sets, "class")

    def dealt(by: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("class", F.lit(salt)), F.col(by)).cast("int")

    columns = ["leader", "asked", "part", "class", "away", "component", "grp", "shingles"]
    each_part = F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))
    each_asked = F.explode(F.sequence(F.lit(0), F.col("n_asked") - 1))
    asked = rows.where("open").withColumn("asked", dealt("n_asked", 1)).withColumn("part", each_part).select(*columns)
    parts = rows.withColumn("part", dealt("n_parts", 2)).withColumn("asked", each_asked).select(*[F.col(c).alias(c) for c in columns])
    key = ["leader", "asked", "part"]
    return asked.groupBy(*key).cogroup(parts.groupBy(*key)).applyInPandas(match, "a long, b long")


def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """One link of every class on the left with every other component on the right that it is linked to."""
    links = []
    if len(left) and len(right):
        sizes = right["shingles"].map(len).to_numpy()
        flat, owner = np.concatenate(right["shingles"].to_list()), np.repeat(np.arange(len(right)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        classes, components_, away, groups_ = (right[c].to_numpy() for c in ("class", "component", "away", "grp"))
        for name, component, distance, grp, own in zip(*[left[c] for c in ("class", "component", "away", "grp", "shingles")]):
            low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
            n = high - low
            hits = np.arange(n.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            shared = np.bincount(owner[hits], minlength=len(right))
            linked = (100 * shared >= 80 * (sizes + len(own) - shared)) & (components_ != component) & (groups_ != grp) & (np.abs(away - distance) <= APART + 1e-9)
            _, first = np.unique(components_[linked], return_index=True)
            links += [(name, b) for b in classes[linked][first].tolist()]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def shingle_sets(docs: DataFrame, active: DataFrame) -> DataFrame:
    """class and shingles of the classes in ``active``, each from the text of its first document.

    A bitmap of the wanted texts' digests, of ``FILTER_BITS`` bits at most, lets a scan of ``docs`` pass over
    almost all other texts, so that sets are shuffled and not texts. Where it is full it spares
    nothing; the join with the wanted classes decides.
    """
    n = active.count()
    n_bits = min(FILTER_BITS, 1 << max(15, (16 * n).bit_length()))
    position = F.pmod(F.xxhash64("digest"), F.lit(n_bits)).cast("long") + 1  # bitmaps count from 1
    wanted = active.select("class", F.col("first.digest").alias("digest"))
    at = wanted.select(position.alias("p")).select(F.expr("bitmap_bucket_number(p)").alias("bucket"), F.expr("bitmap_bit_position(p)").alias("bit"))
    parts = at.groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()  # n_bits / 32768 rows of 4 KB
    bitmap = np.zeros(n_bits // 8, np.uint8)
    for row in parts:
        bitmap[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(bytes(row.bits), np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            bit = batch.column("p").to_numpy() - 1
            wanted_rows = np.flatnonzero((bitmap[bit >> 3] >> (bit & 7)) & 1)
            for small in small_batches(iter([batch.take(pa.array(wanted_rows))])):
                names, sets = [], []
                for text in small.column("text").to_pylist():
                    own = shingles(text, hashes)
                    name = class_of(own) if len(own) else None
                    if name is not None and name not in seen:
                        seen.add(name)
                        names.append(name)
                        sets.append(own)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["class", "shingles"])

    rows = docs.select("text", F.md5("text").alias("digest")).where("digest is not null").select("text", position.alias("p"))
    found = rows.mapInArrow(lambda batches: freed(run(batches)), "class long, shingles array<long>")
    return found.join(wanted.select("class"), "class", "left_semi").groupBy("class").agg(F.first("shingles").alias("shingles"))


def resolved(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their class, and per class its component and the first row of the component."""
    rows = stage(indexed(docs), "ngram-rows")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest")
    named = rows.where(F.col("class").isNotNull())
    classes = stage(named.groupBy("class").agg(F.min(place).alias("first"), F.first("n").alias("n")), "ngram-classes")
    known = connected(docs, rows, classes)
    placed = classes.join(known, "class", "left").select("class", "first", F.coalesce("component", "class").alias("component"))
    firsts = placed.groupBy("component").agg(F.min("first").alias("head"))
    return rows.drop("entries"), placed.join(firsts, "component").select("class", "component", "head")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class and component_id of every row of ``docs`` (doc_id, text).

    Two rows are linked when their sets of 5-word shingles have a Jaccard similarity of 0.8 or more;
    component_id is the smallest doc_id that links reach. Null and empty texts have an empty set, no
    class, and are linked with nothing; texts under five words have one shingle. Repeated rows are
    linked. A null doc_id is never the smallest; a row that reaches null ids only gets null. An empty
    table gives no rows; other columns are not read. ``docs`` is read twice.
    """
    rows, by_class = resolved(docs)
    found = rows.join(by_class.select("class", F.col("head.doc_id").alias("component_id")), "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "class", own.alias("component_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each group of ``docs``, with all its columns: smallest doc_id, then smallest text digest.

    Rows without words are linked with nothing and stay.
    """
    _, by_class = resolved(docs)
    doc, digest, own, place = unused(docs, "doc", "digest", "own_digest", "place")
    heads = by_class.select(F.col("head.doc_id").alias(doc), F.col("head.digest").alias(digest)).distinct()
    texts = docs.withColumn(own, F.md5("text")).where(word_count(F.col("text")) > 0)
    kept = texts.join(heads, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(digest)))
    nth = F.row_number().over(Window.partitionBy("doc_id", own).orderBy(*row_order(docs)))
    one = kept.withColumn(place, nth).where(F.col(place) == 1)  # the same row again
    columns = [f"`{c}`" for c in docs.columns]
    return one.select(*columns).unionByName(docs.where(word_count(F.col("text")) == 0))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return groups(table(spark, folder, "documents")).drop("class")
