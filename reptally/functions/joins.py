"""Joins of a large table to a table with one row per key.

A key of the large table may hold a large part of all its rows, so the join is
planned by size and, when it needs a shuffle, hot keys are split over several
tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reptally.functions.storage import cut


def total_of(df: DataFrame, expr: Column) -> Column:
    """One aggregate over the whole of ``df`` as a scalar subquery."""
    return df.agg(expr.alias("v")).scalar()


def _bytes_conf(df: DataFrame, key: str) -> int:
    text = str(df.sparkSession.conf.get(key)).strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if text and text[-1] in units:
        return int(float(text[:-1]) * units[text[-1]])
    return int(text)


def small_enough(df: DataFrame, limit: int = 0) -> bool:
    """True if the planner's size estimate lets it broadcast ``df`` by itself, or is up to ``limit``.

    The estimate comes from file sizes and is never below them for filters,
    projections and aggregates, so no job is run for the check.
    """
    limit = max(limit, _bytes_conf(df, "spark.sql.autoBroadcastJoinThreshold"))
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return 0 <= int(str(size)) <= limit


def key_weights(fact: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows per key, combined on the map side before the shuffle."""
    return fact.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))


def hot_keys(weights: DataFrame, on: Sequence[str], pieces: int) -> DataFrame:
    """Keys with more than 1/``pieces`` of all rows, and the parts to split each into.

    At most ``pieces`` keys can be hot, whatever the data, which bounds the table.
    """
    share = F.col("n_rows") * F.lit(pieces) / total_of(weights, F.sum("n_rows"))
    return (
        weights.select(*on, F.ceil(share).cast("int").alias("_parts"))
        .filter(F.col("_parts") > 1)
    )


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    by: Sequence[str] = (),
    weights: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join in which every hot key of ``fact`` is split into parts.

    A row of a hot key goes to the part given by the hash of its ``by`` columns, and
    the one row of ``dim`` for that key is repeated once per part. All parts together
    are at most twice the number of shuffle partitions. ``weights`` holds ``n_rows``
    per key when the caller has it already.
    """
    on = list(on)
    pieces = max(2, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = list(by) or [c for c in fact.columns if c not in on]
    # written once: a handful of rows that both sides read
    hot = cut(hot_keys(key_weights(fact, on) if weights is None else weights, on, pieces), "hot")
    spread = F.xxhash64(*by)
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    # rows without a key match nothing; spread them as well
    salted = (
        fact.join(F.broadcast(hot), on, "left")
        .withColumn(
            "_part",
            F.when(no_key, F.pmod(spread, F.lit(pieces)))
            .otherwise(F.coalesce(F.pmod(spread, F.col("_parts")), F.lit(0)))
            .cast("int"),
        )
        .drop("_parts")
    )
    copies = (
        dim.join(F.broadcast(hot), on, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )
    return salted.join(copies, on + ["_part"], how).drop("_part")


def attach(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    by: Sequence[str] = (),
    counted: str | None = None,
    weights: DataFrame | None = None,
    limit: int = 0,
) -> DataFrame:
    """Join ``fact`` to ``dim``, which has one row per key, by the size of ``dim``.

    If the planner cannot tell that ``dim`` is small, it is written once and the size of
    its files decides: a small one is broadcast, so that ``fact`` is not shuffled, and for
    a larger one hot keys are spread (:func:`spread_join`). ``counted`` names a column of
    ``dim`` that holds the rows of ``fact`` per key; it is not part of the result. ``limit``
    broadcasts a ``dim`` of up to so many bytes where rows of ``fact`` are far wider than usual.
    """
    on = list(on)
    if not small_enough(dim):
        dim = cut(dim, "dim")
    known = dim.select(*on, F.col(counted).alias("n_rows")) if counted else weights
    if counted:
        dim = dim.drop(counted)
    if small_enough(dim):
        return fact.join(dim, on, how)
    if small_enough(dim, limit):
        return fact.join(F.broadcast(dim), on, how)
    return spread_join(fact, dim, on, how, by, known)
