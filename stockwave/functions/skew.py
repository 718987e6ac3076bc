"""Join for a big side whose key may be held by a large share of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 4096  # for lists of hot keys that callers make themselves
MAX_FOUND_KEYS = 1 << 19  # rows of the list that hot_keys makes
SAMPLED_ROWS = 1000  # expected in the sample of a key that has the target's rows
SAMPLE_MARGIN = 0.75  # such a key falls below this share of them with a chance of about 1e-15
SAMPLE_SEED = 11
TARGET_ROWS = 1_000_000  # rows of one key that one task should take
NULL_SALTS = 64
SLOTS = 1 << 20


def hot_keys(big: DataFrame, key: str, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Keys with more than ``target_rows`` rows, and into how many parts ``_hot`` each should be dealt.

    Rows are sampled so that a key of that many rows is expected ``SAMPLED_ROWS`` times, and the sample is counted by key:
    every such key is found however many rows there are in all, and of a table of 10**12 rows 10**9 keys are
    shuffled. Up to ``SAMPLED_ROWS`` target rows all rows are counted. At most ``MAX_FOUND_KEYS`` keys are listed, the
    largest, so the list may be broadcast; below 5 * 10**11 rows there cannot be more of a million rows. The
    counts are estimates, which only decide how keys are dealt, never what the join returns.
    """
    share = min(1.0, SAMPLED_ROWS / target_rows)
    keys = big.select(key).where(F.col(key).isNotNull())
    sampled = keys if share == 1.0 else keys.sample(fraction=share, seed=SAMPLE_SEED)
    counted = sampled.groupBy(key).agg((F.count(F.lit(1)) / share).alias("_n"))
    found = counted.where(F.col("_n") > target_rows * (1.0 if share == 1.0 else SAMPLE_MARGIN))
    parts = F.ceil(F.col("_n") / target_rows).cast("int")
    return found.orderBy(F.desc("_n"), key).limit(MAX_FOUND_KEYS).select(key, F.least(parts, F.lit(SLOTS)).alias("_hot"))


def row_slots() -> Column:
    """A slot number per row from its place in its input split.

    A task that is run again produces the same slots only where the input order is fixed: use it
    on a scan or on narrow steps over one, and carry the column through later shuffles.
    """
    return F.pmod(F.monotonically_increasing_id(), F.lit(SLOTS)).cast("int")


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    slot: str | None = None,
    target_rows: int = TARGET_ROWS,
    keep: bool = False,
) -> DataFrame:
    """``big`` join ``small`` on ``key`` with each hot key of ``big`` spread over as many tasks as it needs.

    Rows of a hot key (and rows with a null key) get a salt; only the hot rows of ``small`` are
    repeated once per salt. ``how`` is inner or left. Without ``hot`` and ``slot``, ``big`` must be
    a scan or narrow steps on one; otherwise pass the hot keys of the underlying scan and the name
    of a ``row_slots`` column made on it. ``keep`` leaves ``_salt`` and ``_hot`` in the result, which
    is partitioned by (key, ``_salt``) unless Spark found ``small`` small enough to broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"only inner and left joins can be salted, got {how}")
    hot = F.broadcast(hot_keys(big, key, target_rows) if hot is None else hot)  # at most MAX_FOUND_KEYS rows
    place = F.col(slot) if slot else row_slots()
    parts = F.coalesce("_hot", F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.lit(1)))
    left = big.join(hot, key, "left").withColumn("_salt", F.pmod(place, parts))
    copies = F.sequence(F.lit(0), F.coalesce("_hot", F.lit(1)) - 1)
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    joined = left.join(right, [key, "_salt"], how)
    return joined if keep else joined.drop("_salt", "_hot")
