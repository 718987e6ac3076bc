"""Hard-negative mining with Kronecker-packed products.

The components of many candidates stand side by side in fields of one wide integer per dimension, made
positive by a bias. One multiplication per component of an anchor then adds to the products of all
candidates at once, without carries between fields, and the exact scores are read from the sum.

Anchors are a stated set of queries: blocks of them meet blocks of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.llm.common import table
from stockwave.session import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
SHARES = (4, 5)  # a negative scores at least 4/5 of its positive
STRIP = 4096  # candidates in an integer
BLOCK_ROWS = 32_768  # rows of a block at most, and MIN_BLOCK_ROWS at least where they make BLOCKS
MIN_BLOCK_ROWS = 1024
BLOCKS = 64
ANCHOR_ROWS = 8192
ENDS = -(1 << 63), (1 << 63) - 1  # scores beyond are held there


def whole_numbers(components: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows, shorter ones ending in zeros: int64, or Python integers where that is too small."""
    out = np.zeros((len(components), dim))
    for i, v in enumerate(components):
        out[i, : len(v)] = v
    if out.size and np.abs(out).max() >= 2.0**62:
        return np.array([[int(x) for x in row] for row in out.tolist()], object).reshape(out.shape)
    return out.astype(np.int64)


class Packed:
    """Candidates packed into one integer per dimension, to be multiplied by anchors with components up to ``reach`` in size."""

    def __init__(self, rows: np.ndarray, reach: int):
        self.n, dim = rows.shape
        self.bias, self.reach = int(np.abs(rows).max()) if rows.size else 0, reach
        largest = max(1, dim * 2 * self.bias * 2 * reach)
        self.width = -(-largest.bit_length() // 8)  # bytes of a field
        self.wide = [int.from_bytes(self._fields(rows[:, d] + self.bias), "little") for d in range(dim)]
        self.sums = rows.sum(1)

    def _fields(self, column: np.ndarray) -> bytes:
        if self.width > 7:
            return b"".join(int(x).to_bytes(self.width, "little") for x in column)
        return np.ascontiguousarray(column.astype("<u8").view(np.uint8).reshape(self.n, 8)[:, : self.width]).tobytes()

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of the anchor with every candidate."""
        parts = [int(a) + self.reach for a in anchor]
        raw = sum((a * wide for a, wide in zip(parts, self.wide)), 0).to_bytes(self.n * self.width, "little")
        less = self.bias * sum(int(a) for a in anchor) + len(parts) * self.reach * self.bias
        if self.width > 7:
            fields = [int.from_bytes(raw[at : at + self.width], "little") for at in range(0, len(raw), self.width)]
            exact = [f - self.reach * int(s) - less for f, s in zip(fields, self.sums)]
            return np.array([min(max(s, ENDS[0]), ENDS[1]) for s in exact], np.int64)
        fields = np.zeros((self.n, 8), np.uint8)
        fields[:, : self.width] = np.frombuffer(raw, np.uint8).reshape(self.n, self.width)
        return fields.view("<i8")[:, 0] - self.reach * self.sums - less


def strips(rows: np.ndarray, ids: np.ndarray, reach: int) -> Iterator[tuple[Packed, np.ndarray, np.ndarray]]:
    """(packed candidates, their ids, their places) in order of the id."""
    by = np.argsort(ids, kind="stable")
    for at in range(0, len(by), STRIP):
        own = by[at : at + STRIP]
        yield Packed(rows[own], reach), ids[own], own


def first_of(scores: np.ndarray, wanted: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest wanted scores, ties to the earlier place."""
    places = np.flatnonzero(wanted)
    if len(places) > k:
        places = places[scores[places] >= np.partition(scores[places], -k)[-k]]
    return places[np.argsort(~scores[places], kind="stable")][:k]  # ~s falls as s grows, and has no overflow


def labelled(vectors: DataFrame, label: Column) -> DataFrame:
    """Distinct vec_id, label and ``v``, floor(256 x) per component as whole doubles; ``row`` tells rows apart."""
    ok = F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()
    ok &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def whole(x):
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger ones are whole

    rows = vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform("embedding", whole).alias("v"))
    return rows.distinct().withColumn("row", F.xxhash64("vec_id", "label", "v"))


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, shares: tuple[int, int] = SHARES
) -> DataFrame:
    """Hard negatives of anchors: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and ``label`` (by default a column of that name); ``is_anchor`` picks the anchors by vec_id.
    Scores are integer inner products of floor(256 x), higher first, ties by smaller vec_id. An
    anchor's positives are its first ``positives`` rows of the same label and another vec_id; for each, the first
    ``negatives`` rows of another label are returned whose score s fits share p <= s <= p, share being
    ``shares[0] / shares[1]``. Without such rows a positive has no row in the result.

    Rows with a null vec_id or label, and vectors that are null or hold null or non-finite components, take no
    part; shorter vectors count as ending in zeros; scores beyond the range of long stay at its ends. Repeated
    rows count once; rows of one vec_id with different vectors or labels are each taken, and each is an anchor of
    its own under that id. Equal vectors are ties. An empty table gives no rows, other columns are not read.
    """
    rows = stage(labelled(vectors, F.col("label") if label is None else label), "labelled-vectors")
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    size = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if(is_anchor), F.max(F.when(is_anchor, largest))).head()
    n, dim, n_anchors, reach = size[0], size[1] or 0, size[2], int(size[3] or 0)
    block_rows = min(BLOCK_ROWS, max(MIN_BLOCK_ROWS, n // BLOCKS))
    n_blocks, n_groups = max(1, -(-n // block_rows)), max(1, -(-n_anchors // ANCHOR_ROWS))

    def meet(anchors: DataFrame, found, schema: str) -> DataFrame:
        """Every block of anchors with every block of rows."""
        grouped = anchors.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_groups)).cast("int"))
        left = grouped.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        right = rows.select("vec_id", "label", "v", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(n_blocks)).cast("int").alias("block"))
        right = right.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
        return left.groupBy("block", "grp").cogroup(right.groupBy("block", "grp")).applyInPandas(found, schema)

    def same_label(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        anchors, candidates = whole_numbers(left["v"], dim), whole_numbers(right["v"], dim)
        own, ids, out = left["vec_id"].to_numpy(), right["vec_id"].to_numpy(), []
        for group, members in left.groupby("label").indices.items():
            places = np.flatnonzero((right["label"] == group).to_numpy())
            for packed, strip_ids, _ in strips(candidates[places], ids[places], reach):
                for a in members:
                    scores = packed.scores(anchors[a])
                    out += [(left["row"].iat[a], strip_ids[p], scores[p]) for p in first_of(scores, strip_ids != own[a], positives)]
        return pd.DataFrame(out, columns=["row", "positive_id", "positive_score"])

    def other_label(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        anchors, candidates = whole_numbers(left["v"], dim), whole_numbers(right["v"], dim)
        labels, groups, out = right["label"].to_numpy(), left["label"].to_numpy(), []
        for packed, strip_ids, places in strips(candidates, right["vec_id"].to_numpy(), reach):
            for a in range(len(left)):
                scores, other = packed.scores(anchors[a]), labels[places] != groups[a]
                for limit in left["limits"].iat[a]:
                    least = -(-int(limit) * shares[0] // shares[1])
                    wanted = other & (scores <= limit) & (scores >= least)
                    out += [(left["row"].iat[a], limit, strip_ids[p], scores[p]) for p in first_of(scores, wanted, negatives)]
        return pd.DataFrame(out, columns=["row", "positive_score", "negative_id", "negative_score"])

    def ranked(found: DataFrame, keys: list[str], score: str, id: str, k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc(score), id)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    anchors = stage(rows.where(is_anchor), "anchors")
    near = meet(anchors, same_label, "row long, positive_id long, positive_score long")
    chosen = stage(ranked(near, ["row"], "positive_score", "positive_id", positives).drop("rank"), "positives")
    limits = chosen.where("positive_score >= 0").groupBy("row").agg(F.collect_set("positive_score").alias("limits"))  # at most ``positives``
    hard = meet(anchors.join(limits, "row"), other_label, "row long, positive_score long, negative_id long, negative_score long")
    hard = ranked(hard, ["row", "positive_score"], "negative_score", "negative_id", negatives)
    named = chosen.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row").join(hard, ["row", "positive_score"])
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_kronecker(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP12_SQL = """
with v as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
    list_sum(list_transform(list_zip(a.v, c.v), lambda x: coalesce(x[1], 0) * coalesce(x[2], 0)))::bigint as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
positive as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
fitting as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
  from positive p join scored s on p.anchor_id = s.anchor_id and not s.same
    and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from fitting where rank <= 5
"""
