"""Exact top-k search by inner product with a dual-tree search over cover trees.

Vectors are dealt to the cells of a few pivots and cells to blocks. A block's task builds a cover tree
over its vectors and one over the queries that reach it, and descends both together: a pair of nodes
whose covering radii rule out a score as good as the worst kth score of the query node is dropped.
A first pass searches one block near each query for a bound, so that the second pass sends queries only
to blocks that can still beat it. Queries of neighbouring cells go together, and a block is repeated
only for the groups of queries that reach it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.llm.common import table
from stockwave.session import stage

K = 5
SCALE = 256
BLOCK_ROWS = 4096
QUERY_ROWS = 2048
MAX_PIVOTS = 256
PIVOT_SAMPLE = 4096  # vectors, those of smallest hash, among which pivots are chosen
LEAF = 64
SHRINK = 0.6  # a child's covering radius per parent's
NONE = -(1 << 63)  # score of a place not taken
ROUNDING = 1e-15  # whole numbers beyond 2 ** 53 are rounded as doubles


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and floor(256 x) per component as ``v``, without vectors that are null or hold null or non-finite components."""
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    ok &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def scaled(x):
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger ones are whole

    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", scaled).alias("v"))


def matrix(rows: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(rows), dim))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice: each pivot is the vector farthest from those before."""
    chosen = [0]
    away = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def chain(centers: np.ndarray) -> list[int]:
    """The centres in an order in which near ones follow each other: each time the nearest one left."""
    left, order = set(range(1, len(centers))), [0]
    while left:
        rest = sorted(left)
        order.append(rest[int(((centers[rest] - centers[order[-1]]) ** 2).sum(1).argmin())])
        left.remove(order[-1])
    return order


def query_groups(counts: dict[int, int], centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups per cell: neighbouring cells share a group up to QUERY_ROWS queries, larger ones have several."""
    first, split = np.zeros(len(centers), int), np.ones(len(centers), int)
    group, filled = 0, 0
    for cell in chain(centers):
        n = counts.get(cell, 0)
        if filled and filled + n > QUERY_ROWS:
            group, filled = group + 1, 0
        first[cell], split[cell] = group, max(1, -(-n // QUERY_ROWS))
        group, filled = group + int(split[cell]) - 1, QUERY_ROWS if split[cell] > 1 else filled + n
    return first, split


class Tree:
    """Cover tree: nodes in lists; children of a node are centres apart by more than their covering radius."""

    def __init__(self, points: np.ndarray):
        self.points, self.centers, self.radii, self.children, self.members = points, [], [], [], []
        if len(points):
            self.add(np.arange(len(points)), 0)
        self.centers = points[self.centers] if self.centers else points
        self.radii = np.array(self.radii)
        self.norms = np.sqrt((self.centers**2).sum(1))

    def add(self, own: np.ndarray, center: int) -> int:
        """A node over the points ``own`` with ``center`` as its centre."""
        node = len(self.centers)
        away = np.sqrt(((self.points[own] - self.points[center]) ** 2).sum(1))
        radius = float(away.max())
        self.centers.append(center)
        self.radii.append(radius * (1 + 1e-9))
        self.children.append([])
        self.members.append(own)
        if len(own) <= LEAF or radius == 0:
            return node
        limit, groups, rest = radius * SHRINK, [], own
        middle = center
        while len(rest):
            near = np.sqrt(((self.points[rest] - self.points[middle]) ** 2).sum(1))
            groups.append((rest[near <= limit], middle))
            far = near > limit
            middle = int(rest[far][near[far].argmax()]) if far.any() else -1
            rest = rest[far]
        if len(groups) > 1 and len(groups) * 2 <= len(own):
            self.children[node] = [self.add(group, head) for group, head in groups]
        else:  # points too far apart for nets: halves by distance bound the size of a leaf
            order = own[np.argsort(away, kind="stable")]
            self.children[node] = [self.add(half, int(half[0])) for half in np.array_split(order, 2)]
        return node


class Best:
    """The k best (score, vec_id) of each query, ties to the smaller id; ``floor`` is a score known to be reached."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.scores, self.ids, self.floor = k, np.full((n, k), NONE), np.full((n, k), NONE), floor.copy()

    def offer(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some points per query, NONE where a point is no candidate."""
        all_scores = np.concatenate([self.scores[queries], scores], 1)
        all_ids = np.concatenate([self.ids[queries], np.broadcast_to(ids, scores.shape)], 1)
        first = np.lexsort((all_ids, ~all_scores))[:, : self.k]  # ~ turns the order around without overflow
        self.scores[queries], self.ids[queries] = np.take_along_axis(all_scores, first, 1), np.take_along_axis(all_ids, first, 1)
        worst = self.scores[queries, -1]
        reached = np.where(worst == NONE, -np.inf, worst - np.abs(worst.astype(float)) * ROUNDING)
        self.floor[queries] = np.maximum(self.floor[queries], reached)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; by exact integers where doubles would round, held at the ends of the range of long."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= 2.0**52:
        whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
        product = [[min(max(sum(x * y for x, y in zip(p, q)), NONE + 1), (1 << 63) - 1) for q in whole[1]] for p in whole[0]]
        return np.array(product, np.int64)
    return (a @ b.T).astype(np.int64)


def search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, points: np.ndarray, point_ids: np.ndarray, k: int) -> Best:
    """Dual-tree search: the k best points of every query that reach its floor, the query's own id left out."""
    best = Best(len(queries), k, floor)
    if not len(queries) or not len(points):
        return best
    q, r = Tree(queries), Tree(points)

    def bounds(a: int, nodes: list[int]) -> np.ndarray:
        """Upper bound of any score between query node ``a`` and each of ``nodes``."""
        ra, rb = q.radii[a], r.radii[nodes]
        top = r.centers[nodes] @ q.centers[a] + ra * r.norms[nodes] + rb * q.norms[a] + ra * rb
        return top + np.abs(top) * 1e-9 + 1e-3

    todo = [(0, 0, np.inf)]
    while todo:
        a, b, bound = todo.pop()
        if bound < best.floor[q.members[a]].min():
            continue
        if q.children[a] and (not r.children[b] or q.radii[a] >= r.radii[b]):
            split = [(c, b, float(bounds(c, [b])[0])) for c in q.children[a]]
        elif r.children[b]:
            split = list(zip([a] * len(r.children[b]), r.children[b], bounds(a, r.children[b]).tolist()))
        else:
            own, other = q.members[a], r.members[b]
            scores = exact_scores(queries[own], points[other])
            hit = (scores >= best.floor[own][:, None]) & (query_ids[own][:, None] != point_ids[other])
            some = hit.any(1)
            if some.any():
                best.offer(own[some], np.where(hit, scores, NONE)[some], point_ids[other])
            continue
        todo += sorted((s for s in split if s[2] >= best.floor[q.members[s[0]]].min()), key=lambda s: s[2])  # the best is next
    return best


def top_k(vectors: DataFrame, is_query: F.Column, k: int = K) -> DataFrame:
    """The k highest scores of every query: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding; ``is_query`` picks the queries. Scores are integer inner
    products of floor(256 x); ties go to the smaller vec_id, and a vec_id is no candidate of its own.
    Vectors with a null id, null, or with null or non-finite components take no part; shorter vectors count
    as ending in zeros; scores beyond the range of long stay at its ends. Equal vectors are one
    candidate with its k + 1 smallest ids, all that can be among the k best. Repeated rows count once.
    An empty table, or one without queries, gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors).distinct(), "vectors")
    queries = rows.where(is_query)
    same = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    points = rows.withColumn("_nth", same).where(F.col("_nth") <= k + 1).drop("_nth")
    size = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).head()
    n, dim = size[0], max(1, size[1] or 0)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).toPandas()  # bounded
    pivots = choose_pivots(matrix(sample["v"], dim), min(MAX_PIVOTS, max(1, n // BLOCK_ROWS)))

    def to_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = matrix(batch["v"], dim)
            away = np.stack([((m - p) ** 2).sum(1) for p in pivots], 1)
            cell = away.argmin(1)
            yield batch.assign(cell=cell.astype("int32"), away=np.sqrt(away[np.arange(len(m)), cell]))

    placed = stage(points.mapInPandas(to_cell, "vec_id long, v array<double>, cell int, away double"), "vector-cells")
    cells = {c.cell: c for c in placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}  # a row per pivot
    used = np.array(sorted(cells))
    centers, radii = pivots[used], np.array([cells[c].radius * (1 + 1e-9) for c in used])
    parts = np.array([max(1, -(-cells[c].n // BLOCK_ROWS)) for c in used])
    norms = np.sqrt((centers**2).sum(1))

    def per_cell(values) -> F.Column:
        return F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("cell") + 1)

    part_of = per_cell(dict(zip(used, parts)).get(c, 1) for c in range(len(pivots)))
    blocks = placed.select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), part_of).cast("int").alias("part"))
    dealt = stage(queries.mapInPandas(to_cell, "vec_id long, v array<double>, cell int, away double"), "query-cells").drop("away")
    first_group, n_groups = query_groups({r.cell: r["count"] for r in dealt.groupBy("cell").count().collect()}, pivots)  # a row per pivot
    grouped = dealt.withColumn("grp", (per_cell(first_group) + F.pmod(F.xxhash64("vec_id", F.lit(1)), per_cell(n_groups))).cast("int")).drop("cell")

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The block of each query's best cell, its part picked by id."""
        for batch in batches:
            m = matrix(batch["v"], dim)
            cell = (m @ centers.T).argmax(1)
            yield batch.assign(cell=used[cell].astype("int32"), part=(batch["vec_id"].to_numpy() % parts[cell]).astype("int32"), floor=-np.inf)

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every block whose cell may hold a score that reaches the query's floor."""
        for batch in batches:
            m = matrix(batch["v"], dim)
            top = m @ centers.T + np.sqrt((m**2).sum(1))[:, None] * radii
            may = top + np.abs(top) * 1e-9 + 1e-3 >= batch["floor"].to_numpy()[:, None]
            for j in range(len(used)):
                for part in range(parts[j]):
                    if may[:, j].any():
                        yield batch[may[:, j]].assign(cell=np.int32(used[j]), part=np.int32(part))

    out = "query_id long, vec_id long, score long"

    def of_block(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids = left["vec_id"].to_numpy()
        found = search(matrix(left["v"], dim), ids, left["floor"].to_numpy(), matrix(right["v"], dim), right["vec_id"].to_numpy(), k)
        taken = [(int(ids[i]), int(v), int(s)) for i in range(len(ids)) for v, s in zip(found.ids[i], found.scores[i]) if s != NONE]
        return pd.DataFrame(taken, columns=["query_id", "vec_id", "score"])

    def search_blocks(asked: DataFrame) -> DataFrame:
        """Query groups meet the blocks that a query of theirs reaches, so no task holds more than one of each."""
        key = ["cell", "part", "grp"]
        asked = stage(asked, "asked")
        reached = asked.select(*key).distinct().toDF("_cell", "_part", "_grp")
        repeated = blocks.join(reached, (F.col("cell") == F.col("_cell")) & (F.col("part") == F.col("_part")))
        repeated = repeated.select("vec_id", "v", "cell", "part", F.col("_grp").alias("grp"))
        return asked.groupBy(*key).cogroup(repeated.groupBy(*key)).applyInPandas(of_block, out)

    asked = "vec_id long, v array<double>, grp int, cell int, part int, floor double"
    columns = ["vec_id", "v", "grp", "cell", "part", "floor"]
    first = search_blocks(grouped.mapInPandas(lambda it: (b[columns] for b in near(it)), asked))
    floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("low")).where(F.col("n") >= k)
    bounded = grouped.join(floors.select(F.col("query_id").alias("vec_id"), (F.col("low") - F.abs("low") * ROUNDING).alias("floor")), "vec_id", "left").fillna(float("-inf"), ["floor"])
    found = search_blocks(bounded.mapInPandas(lambda it: (b[columns] for b in reach(it)), asked))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


OP1_SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda x: coalesce(x[1], 0) * coalesce(x[2], 0)))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""
