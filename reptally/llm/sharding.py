"""Sharding by balanced label propagation.

Documents are linked through hubs (by default: equal texts share a hub). Rounds of joins move
linked documents towards the shard where most of their neighbours are, under quotas that keep
every shard near its share; then the least attached documents of shards above their share fill
the others, so that row counts differ by one at most.

A third of all documents may share a hub. Hubs are only ever aggregated to one count per shard,
no pair of neighbours is listed, and a hub that is large for a shard is moved by rows instead of
whole.

Defined cases: null texts are linked to nothing and have size 1; empty texts are equal texts;
repeated rows are rows of their own; ties go by hash; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import stored

ROUNDS = 4
#: A hub that is larger than this part of a shard moves by rows.
SLACK = 0.02
#: Rows of one task when slots are numbered.
BUCKET_ROWS = 20_000


def _uniform(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 20)) / F.lit(float(1 << 20))


def _start(n_shards: int) -> Column:
    return F.pmod(F.xxhash64("rid"), F.lit(n_shards)).cast("int")


def _quotas(wish: np.ndarray, sizes: np.ndarray, most: float) -> np.ndarray:
    """Which part of each flow between shards may go, so that no shard ends above ``most``."""
    flow = wish.astype(float)
    for _ in range(50):
        after = sizes + flow.sum(0) - flow.sum(1)
        over = after > most
        if not over.any():
            break
        room = np.maximum(most - sizes + flow.sum(1), 0)
        scale = np.where(over, np.minimum(1, room / np.maximum(flow.sum(0), 1e-9)), 1)
        flow = flow * scale[None, :]
    return np.divide(flow, wish, out=np.zeros_like(flow), where=wish > 0)


def propagate(members: DataFrame, n_shards: int, capacity: int, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """(rid, hub, shard, pull): a shard per linked node, how many neighbours pull it there, and
    the least of its hubs.

    ``members`` (rid, hub, shard) has the hubs of every linked node and its first shard; each
    hub has two nodes or more. No shard gets more than ``capacity`` linked nodes; rows without
    links make room.
    """
    shards = range(n_shards)
    have = dict(members.dropDuplicates(["rid"]).groupBy("shard").count().collect())  # one number per shard
    sizes = np.array([have.get(s, 0) for s in shards], float)
    state = members
    for k in range(rounds):
        counts = stored(
            state.groupBy("hub").agg(F.count(F.lit(1)).alias("hub_rows"), *[F.count_if(F.col("shard") == s).alias(f"n{s}") for s in shards]), "hubs"
        )
        # a neighbour counts the less, the larger the hub; a node counts itself, so that two that
        # are apart agree on where to meet instead of changing places
        weight = F.lit(1.0) / F.greatest(F.col("hub_rows") - 1, F.lit(1))
        lead = F.struct(F.xxhash64("hub").alias("h"), F.col("hub").alias("hub"), F.col("hub_rows").alias("n"))
        votes = attach(state, counts, ["hub"], "inner", by=["rid"])
        votes = votes.groupBy("rid", "shard").agg(
            *[F.round(F.sum(weight * F.col(f"n{s}")), 9).alias(f"v{s}") for s in shards],
            F.sum(weight).alias("self"),
            F.min(lead).alias("lead"),
            F.collect_set("hub").alias("hubs"),
        )
        # ties by a hash of hub and shard, on which all members of a hub agree
        best = F.greatest(*[F.struct(F.col(f"v{s}").alias("v"), F.xxhash64("lead.h", F.lit(s)).alias("tie"), F.lit(s).alias("s")) for s in shards])
        here = F.element_at(F.array(*[F.col(f"v{s}") for s in shards]), F.col("shard") + 1)
        votes = stored(votes.select("rid", "shard", "lead", "hubs", (here - F.col("self")).alias("pull"), best.alias("best")), "votes")
        wish = np.zeros((n_shards, n_shards))
        for a, b, c in votes.filter("best.s <> shard").groupBy("shard", "best.s").count().collect():  # one number per pair of shards
            wish[a, b] = c
        share = _quotas(wish, sizes, capacity)
        allowed = F.element_at(F.array(*[F.lit(float(x)) for x in share.ravel()]), F.col("shard") * n_shards + F.col("best.s") + 1)
        # a hub goes whole or not at all; one that is larger than the slack goes by rows
        dice = F.when(F.col("lead.n") > int(capacity * slack) + 1, _uniform("rid", F.lit(k))).otherwise(_uniform("lead.hub", F.lit(k)))
        goes = (F.col("best.s") != F.col("shard")) & (dice < allowed)
        after = votes.select(
            "rid", "hubs", F.col("shard").alias("old"), F.when(goes, F.col("best.s")).otherwise(F.col("shard")).alias("shard"), F.when(goes, F.col("best.v")).otherwise(F.col("pull")).alias("pull")
        )
        moved = 0
        for a, b, c in after.filter("old <> shard").groupBy("old", "shard").count().collect() if wish.any() else ():
            sizes[a], sizes[b], moved = sizes[a] - c, sizes[b] + c, moved + c
        if k == rounds - 1 or moved <= 0.001 * sizes.sum():
            break
        state = after.select("rid", F.explode("hubs").alias("hub"), "shard")
    return after.select("rid", "shard", "pull", F.array_min("hubs").alias("hub"))


def numbered(rows: DataFrame, by: list[str], n_rows: int, *order: Column) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 per ``by``, with no task that holds a whole group.

    Rows are dealt to buckets; the buckets' sizes, summed in order, are where each begins.
    """
    buckets = max(1, n_rows // BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("rid"), F.lit(buckets)))
    sizes = rows.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))
    start = F.sum("n").over(Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*by, "bucket", F.coalesce(start, F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy(*by, "bucket").orderBy(*order))
    return rows.withColumn("rank", rank).join(starts, [*by, "bucket"]).withColumn("slot", F.col("start") + F.col("rank") - 1).drop("bucket", "start", "rank")


def shard(docs: DataFrame, n_shards: int = 8, rounds: int = ROUNDS, members: DataFrame | None = None) -> DataFrame:
    """(rid, doc_id, size, text_crc32, shard, slot) per row of ``docs``; counts differ by one at most.

    ``members`` (doc_id, hub) links documents; without it, equal texts do.
    """
    data = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            (F.octet_length(data) + 1).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
            F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text").alias("a"), F.crc32(data).alias("b"), F.octet_length(data).alias("c"))).alias("same"),
        ),
        "rows",
    )
    n = rows.count()
    if members is None:
        links = rows.filter("same is not null").select("rid", F.xxhash64("same.a", "same.b", "same.c").alias("hub"))
    else:
        links = members.select("doc_id", F.xxhash64("hub").alias("hub")).distinct().join(rows.select("rid", "doc_id"), "doc_id").select("rid", "hub")
    shared = links.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hub")
    links = stored(attach(links, shared, ["hub"], "inner", by=["rid"]).withColumn("shard", _start(n_shards)), "links")
    labels = propagate(links, n_shards, max(1, n // n_shards), rounds)
    state = stored(
        rows.drop("same")
        .join(labels, "rid", "left")
        .select("rid", "doc_id", "size", "text_crc32", F.coalesce("shard", _start(n_shards)).alias("shard"), F.coalesce("pull", F.lit(0.0)).alias("pull"), "hub"),
        "state",
    )
    return numbered(_even(state, n_shards, n), ["shard"], n, F.col("rid")).select("rid", "doc_id", "size", "text_crc32", "shard", "slot")


def _even(state: DataFrame, n_shards: int, n: int) -> DataFrame:
    """Moves as few rows as it takes to make counts differ by one at most: of a shard above its
    share those with the least pull go, and of equal ones whole hubs first."""
    have = dict(state.groupBy("shard").count().collect())  # one number per shard
    have = [have.get(s, 0) for s in range(n_shards)]
    share = [n // n_shards] * n_shards
    for s in sorted(range(n_shards), key=lambda s: (-have[s], s))[: n % n_shards]:
        share[s] += 1
    give = [max(0, h - w) for h, w in zip(have, share, strict=True)]
    take = [(s, w - h) for s, (h, w) in enumerate(zip(have, share, strict=True)) if w > h]
    if not any(give):
        return state
    # classes by pull, then slices of hubs, then slices of rows: all counted before a row moves
    level = F.floor(F.log2(F.col("pull") * 64 + 1)).cast("int")
    slices = max(16, n // BUCKET_ROWS)
    hub_slice = F.pmod(F.xxhash64(F.coalesce("hub", "rid"), F.lit(7)), F.lit(slices))
    row_slice = F.pmod(F.xxhash64("rid", F.lit(9)), F.lit(slices))
    giving = state.filter(F.col("shard").isin([s for s, g in enumerate(give) if g]))
    cells = giving.select("rid", "shard", F.struct(level.alias("l"), hub_slice.alias("h")).alias("cell"), row_slice.alias("part"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    limit = F.element_at(F.array(*[F.lit(g) for g in give]), F.col("shard") + 1)
    by_cell = cells.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    by_cell = by_cell.filter(F.col("start") < limit)
    within = cells.join(by_cell.drop("n"), ["shard", "cell"])
    parts = within.groupBy("shard", "cell", "start", "part").agg(F.count(F.lit(1)).alias("n"))
    inner = Window.partitionBy("shard", "cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("at", F.col("start") + F.coalesce(F.sum("n").over(inner), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("shard", "cell", "part").orderBy("rid"))
    going = within.join(parts.select("shard", "cell", "part", "at"), ["shard", "cell", "part"]).withColumn("place", F.col("at") + rank - 1)
    base, places = 0, []
    for g in give:
        places.append(base)
        base += g
    going = going.filter(F.col("place") < limit).select("rid", (F.element_at(F.array(*[F.lit(p) for p in places]), F.col("shard") + 1) + F.col("place")).alias("place"))
    target, upto = F.lit(None).cast("int"), sum(t for _, t in take)
    for s, t in reversed(take):
        target = F.when(F.col("place") < upto, F.lit(s)).otherwise(target)
        upto -= t
    moves = stored(going.select("rid", target.alias("new")), "moves")
    return state.join(moves, "rid", "left").withColumn("shard", F.coalesce("new", "shard")).drop("new")
