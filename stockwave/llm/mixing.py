"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every document of a source gets a place in a seeded shuffle. Its virtual finish time is the number of
its source's words up to and including it, divided by the source's target. All documents, with
their repeats, are put in the order of finish times and cut off where the budget is used up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.llm.common import bucket_bits, row_order, running_sum, table, unused, word_count
from stockwave.session import stage

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def target_shares(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets for (source, source_size): the budget by weight, at most ``max_epochs`` times the size.

    Sources in code-point order, null last, take the weights in turn. Words above a source's limit go
    to the others by weight until none is above: sources sorted by limit per weight are full up to the
    first one whose share of what is left stays within its limit. One row per source in one window.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    ranked = sizes.select("source", "source_size", place.alias("src"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("src") % len(weights) + 1)
    ranked = ranked.withColumn("weight", turn).withColumn("most", F.col("source_size") * max_epochs)
    full_first = Window.orderBy(F.col("most") / F.col("weight"), "src")
    done = F.coalesce(F.sum("most").over(full_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(full_first.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy()
    budget = F.floor(F.sum("source_size").over(every) * F.lit(share)).cast("long")
    leveled = ranked.withColumn("budget", budget).withColumn("_level", (F.col("budget") - done).cast("double") / rest)
    fits = F.when(F.col("_level") * F.col("weight") <= F.col("most"), F.col("_level"))
    level = F.coalesce(F.max(fits).over(every), F.lit(float("inf")))
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    return leveled.select("source", "src", "source_size", "budget", target.alias("target"))


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS, seed: str = "mix"
) -> DataFrame:
    """How often each document is taken: one row per row of ``docs`` (doc_id, text, source).

    Columns: doc_id, digest (MD5 of the text), source, size, source_size, target, finish (of the first
    copy), epochs, taken. A null or empty text has size 0 and is taken 0 times; null sources form one
    source; null doc_ids and repeated rows are rows like others (rows equal in doc_id and text are
    interchangeable). An empty table gives an empty plan. Other columns of ``docs`` are not read.
    """
    digest = F.md5(F.col("text"))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("digest", F.lit("")))
    items = docs.select("doc_id", "source", digest.alias("digest"), word_count(F.col("text")).alias("size"))
    items = stage(items.withColumn("key", F.md5(named)), "mix-items")
    targets = stage(target_shares(items.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs), "mix-targets")
    n_rows = items.count()
    t = targets.withColumnRenamed("source", "_source")
    placed = items.join(t, items.source.eqNullSafe(t._source)).drop("_source")
    placed = running_sum(placed, "src", "key", F.col("size"), ["size"], "_start", n_rows)
    placed = stage(placed.withColumn("_end", F.col("_start") + F.col("size")), "mix-placed")

    def finish(epoch):
        return F.try_divide((F.col("_end") + epoch * F.col("source_size")).cast("double"), F.col("target"))

    slots = 1 << bucket_bits(n_rows)

    def slot(at):  # times beyond 2 are rare (a document larger than its source's target): they share a slot
        return F.floor(F.least(at, F.lit(2.0)) * slots).cast("long")

    entries = placed.where("size > 0 and target > 0").select("src", "size", "budget", "_end", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"))
    entries = entries.select("src", "size", "budget", finish(F.col("epoch")).alias("finish"))
    last, time, src = cut_off(entries.withColumn("slot", slot(F.col("finish"))))

    def is_taken(at):
        if last is None:
            return F.lit(True)
        early = slot(at) < last
        within = (slot(at) == last) & ((at < F.lit(time)) | ((at == F.lit(time)) & (F.col("src") <= src)))
        return early | within if time is not None else early

    counted = (F.col("size") > 0) & (F.col("target") > 0)
    epochs = sum((F.when(counted & is_taken(finish(F.lit(e))), 1).otherwise(0) for e in range(max_epochs)), F.lit(0))
    first = F.when(counted, finish(F.lit(0)))
    out = placed.select("doc_id", "digest", "source", "size", "source_size", "target", first.alias("finish"), epochs.cast("long").alias("epochs"))
    return out.withColumn("taken", F.col("epochs") * F.col("size"))


def cut_off(entries: DataFrame) -> tuple[int | None, float | None, int | None]:
    """The slot, finish time and source of the last entry within the budget; only these come to the driver.

    Words are summed per slot of the time line, the slots are added up, and only the entries of the
    slot where the budget ends are put in order. (None, None, None): all entries fit;
    (slot, None, None): no entry of that slot fits.
    """
    per_slot = entries.groupBy("slot").agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
    upto = F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    crossing = per_slot.withColumn("upto", upto).where("upto > budget").orderBy("slot").limit(1).head()
    if crossing is None:
        return None, None, None
    before = crossing.upto - crossing.words
    ordered = Window.orderBy("finish", "src").rowsBetween(Window.unboundedPreceding, 0)
    inside = entries.where(F.col("slot") == crossing.slot).withColumn("upto", F.sum("size").over(ordered) + before)
    found = inside.where("upto <= budget").agg(F.max(F.struct("finish", "src")).alias("last")).head()
    return (crossing.slot, found.last.finish, found.last.src) if found.last else (crossing.slot, None, None)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as it is taken, with the columns of ``docs``.

    Rows equal in doc_id and text share their copies as evenly as possible. ``docs`` should be stored.
    """
    plan = mix_plan(docs, **options)
    doc, digest, own, copies, rows = unused(docs, "doc", "digest", "own_digest", "copies", "rows")
    counts = plan.groupBy(F.col("doc_id").alias(doc), F.col("digest").alias(digest)).agg(F.sum("epochs").alias(copies), F.count(F.lit(1)).alias(rows))
    counts = counts.where(F.col(copies) > 0)
    keyed = docs.withColumn(own, F.md5(F.col("text")))
    joined = keyed.join(counts, F.col("doc_id").eqNullSafe(F.col(doc)) & F.col(own).eqNullSafe(F.col(digest)))
    nth = F.row_number().over(Window.partitionBy("doc_id", own).orderBy(*row_order(docs)))
    share = F.floor(F.col(copies) / F.col(rows)) + F.when(nth <= F.col(copies) % F.col(rows), 1).otherwise(0)
    taken = joined.withColumn(copies, share).where(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return taken.select(*[f"`{c}`" for c in docs.columns])


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_plan(table(spark, folder, "documents")).drop("digest", "source")


OP3_SQL = r"""
with items as (
  select row_number() over () as n, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(md5(text), '')) as key
  from documents),
ranked as (
  select source, sum(size)::bigint as s, row_number() over (order by source nulls last) - 1 as src from items group by source),
weighed as (select *, case src % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w, 3 * s as most from ranked),
leveled as (
  select *, sum(s) over () as budget,
    (sum(s) over () - coalesce(sum(most) over (order by most / w, src rows between unbounded preceding and 1 preceding), 0))::double
      / sum(w) over (order by most / w, src rows between current row and unbounded following) as level
  from weighed),
targets as (
  select source, src, s, budget, least(most::double, max(case when level * w <= most then level end) over () * w) as target from leveled),
placed as (
  select i.n, i.doc_id, i.size, t.src, t.s, t.budget, t.target,
    sum(i.size) over (partition by t.src order by i.key, i.size rows unbounded preceding) as upto
  from items i join targets t on i.source is not distinct from t.source),
entries as (
  select n, src, size, budget, (upto + e * s)::double / target as finish
  from placed, (values (0), (1), (2)) as epochs(e) where size > 0 and target > 0),
taken as (
  select n, count(*) as epochs from (
    select n, budget, sum(size) over (order by finish, src rows unbounded preceding) as total from entries)
  where total <= budget group by n)
select p.doc_id, p.size::bigint as size, p.s::bigint as source_size, p.target::double as target,
  case when p.size > 0 and p.target > 0 then p.upto::double / p.target end as finish,
  coalesce(k.epochs, 0)::bigint as epochs, (coalesce(k.epochs, 0) * p.size)::bigint as taken
from placed p left join taken k on p.n = k.n
"""
