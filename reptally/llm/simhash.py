"""Near-duplicates by SimHash with a generalised pigeonhole.

Bits that go together are grouped into one part, so that some parts tell fingerprints apart
much better than others. For each fingerprint, thresholds of the parts that sum to the radius
minus the number of parts plus one are chosen by dynamic programming on candidate counts
estimated from all fingerprints; whatever lies within the radius is then within the threshold
of at least one part. Parts are probed by an equi-join and candidates verified.

Large groups of near copies make no list of pairs: first each bucket is linked to a few pivots,
then only fingerprints of different components are compared, from the smaller component's side.

Defined cases: null and empty texts have fingerprint 0, linked like any other; fewer words than
a shingle are one shingle; equal fingerprints are one class; an empty table gives no row; null
ids are rows like others, without being a smallest id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import components, discard, stored

BITS = 64
_CHUNK = 1 << 16
#: Bins in which shingles are counted, for an order from rare to common ones.
BINS = 1 << 18
_BLOCK = 1 << 10
#: 64-bit words of a set's odd sketch.
SKETCH = 8
#: Hashes of a set up to which that sketch is all; larger sets have one that grows with them.
FEW = 32 * SKETCH
#: Rows of a key up to which one task may hold them all.
RUN = 1 << 13


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``size`` words, joined by spaces."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    data, n = b" ".join(words), len(words)
    if n <= size:
        return np.array([xxh64_intdigest(data, 42)] if n else [], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = [0, *(gaps[: n - size] + 1).tolist()]
    ends = [*gaps[size - 1 :].tolist(), len(data)]
    return np.fromiter((xxh64_intdigest(data[a:b], 42) for a, b in zip(starts, ends, strict=True)), np.uint64, n - size + 1)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def majority(hashes: np.ndarray) -> int:
    """A signed 64-bit number whose bits are those set in over half of ``hashes``."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        ones += bits_of(hashes[at : at + _CHUNK]).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def odd_sketch(hashes: np.ndarray) -> list[int]:
    """Parity of how many of the (distinct) ``hashes`` fall in each of 64 * SKETCH bins. Each hash
    that only one of two sets has changes one bit, so sketches differ in no more bits than sets in hashes."""
    odd = np.bincount((hashes % np.uint64(BITS * SKETCH)).astype(np.int64), minlength=BITS * SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8").tolist()


def wide_sketch(hashes: np.ndarray) -> bytes:
    """An odd sketch of at least two bits a hash (a power of two); nothing for FEW hashes or less."""
    if len(hashes) <= FEW:
        return b""
    bits = 1 << (2 * len(hashes) - 1).bit_length()
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two wide sketches differ, the longer one folded to the other's length; sets
    differ in at least as many hashes."""
    if not a or not b:
        return 0
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.unpackbits(x ^ y).sum(dtype=np.int64))


def fingerprint(text: Column, size: int = 3, once: bool = False) -> Column:
    """SimHash of a text's shingles; with ``once`` each distinct shingle counts once."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = (shingle_hashes(t, size) for t in texts)
        return pd.Series([majority(np.unique(h) if once else h) for h in found], dtype="int64")

    return of(text)


# --- generalised pigeonhole


def bit_groups(nodes: DataFrame, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size, correlated ones together (counts over all)."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros((BITS, BITS))
        for batch in batches:
            b = bits_of(batch["fp"].to_numpy("int64").view(np.uint64)).astype(np.float32)
            both += b.T @ b
        yield pd.DataFrame({"cell": np.arange(BITS * BITS), "n": both.ravel()})

    # 4,096 numbers whatever the input
    summed = nodes.select("fp").mapInPandas(pairs, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS)
    for cell, n in summed.collect():
        both[cell] = n
    both, total = both.reshape(BITS, BITS), max(1, nodes.count())
    p = both.diagonal() / total
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    together = np.abs((both / total - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(together, 0)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(sorted(left), key=lambda i: together[i, sorted(left)].sum())]
        left -= set(group)
        while len(group) < size:
            group.append(max(sorted(left), key=lambda i: together[i, group].sum()))
            left.discard(group[-1])
        groups.append(sorted(group))
    return groups


def _value(fp: Column, bits: list[int]) -> Column:
    """The bits of ``fp`` at the given places, as a number."""
    total = None
    for k, b in enumerate(bits):
        bit = F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1).cast("long")), k)
        total = bit if total is None else total.bitwiseOR(bit)
    return total


def _masks(width: int) -> list[np.ndarray]:
    """Numbers of ``width`` bits by how many are set, up to three."""
    one = 1 << np.arange(width, dtype=np.int64)
    two = np.array([a | b for i, a in enumerate(one) for b in one[:i]], np.int64)
    three = np.array([a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]], np.int64)
    return [np.zeros(1, np.int64), one, two, three]


def _near_counts(counts: np.ndarray, width: int) -> np.ndarray:
    """For each value, how many counts are at distance 0, 1, 2, 3."""
    values = np.arange(1 << width)
    return np.array([sum(counts[values ^ m] for m in masks) for masks in _masks(width)])


class Allocation:
    """Thresholds per fingerprint: the cheapest that sum to radius - parts + 1."""

    def __init__(self, groups: list[list[int]], near: list[list[np.ndarray]], n: int, radius: int):
        self.groups, self.near, self.n, self.total = groups, near, n, radius - len(groups) + 1
        self.masks = [_masks(len(g)) for g in groups]
        self.most = 3

    def costs(self, values: list[np.ndarray], part: int) -> np.ndarray:
        """Estimated candidates plus probes for thresholds -1 .. most; halves of a wide part are
        taken as independent."""
        share = None
        for sub, (lo, width) in zip(self.near[part], halves(len(self.groups[part])), strict=True):
            own = sub[:, (values[part] >> lo) & ((1 << width) - 1)] / max(1, self.n)
            share = own if share is None else np.array([sum(share[j] * own[e - j] for j in range(e + 1)) for e in range(4)])
        probes = np.cumsum([len(m) for m in self.masks[part]])[:, None]
        return np.vstack([np.zeros((1, len(values[part]))), np.cumsum(share, 0) * self.n + probes])

    def choose(self, values: list[np.ndarray]) -> np.ndarray:
        """(parts, queries) thresholds by dynamic programming over the parts' sums."""
        parts, q = len(self.groups), len(values[0])
        best: dict[int, np.ndarray] = {0: np.zeros(q)}
        back: list[dict[int, np.ndarray]] = []
        for p in range(parts):
            cost, new, chosen = self.costs(values, p), {}, {}
            for done, so_far in best.items():
                for t in range(-1, self.most + 1):
                    s, c = done + t, so_far + cost[t + 1]
                    if s not in new:
                        new[s], chosen[s] = c, np.full(q, t)
                    else:
                        better = c < new[s]
                        new[s] = np.where(better, c, new[s])
                        chosen[s] = np.where(better, t, chosen[s])
            best = new
            back.append(chosen)
        out, at = np.zeros((parts, q), int), np.full(q, self.total)
        for p in reversed(range(parts)):
            for s, t in back[p].items():
                out[p] = np.where(at == s, t, out[p])
            at = at - out[p]
        return out


def halves(width: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the pieces of a part that are counted: 16 bits at most."""
    n = -(-width // 16)
    sizes = [width // n + (k < width % n) for k in range(n)]
    return [(sum(sizes[:k]), s) for k, s in enumerate(sizes)]


def parts_for(n: int) -> int:
    """Fewer and wider parts for more fingerprints, so that buckets stay small."""
    return 4 if n < 1 << 24 else 3 if n < 1 << 30 else 2


def allocation(nodes: DataFrame, groups: list[list[int]], n: int, radius: int) -> Allocation:
    pieces = [(p, k, g[lo : lo + w]) for p, g in enumerate(groups) for k, (lo, w) in enumerate(halves(len(g)))]
    keys = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(k).alias("k"), _value(F.col("fp"), bits).alias("v")) for p, k, bits in pieces])
    near: list[list[np.ndarray]] = [[None] * len(halves(len(g))) for g in groups]
    counts = {(p, k): np.zeros(1 << len(bits)) for p, k, bits in pieces}
    # at most 2^16 numbers per piece, whatever the input
    for p, k, v, c in nodes.select(F.explode(keys).alias("x")).groupBy("x.p", "x.k", "x.v").count().toLocalIterator():
        counts[p, k][v] = c
    for (p, k), c in counts.items():
        near[p][k] = _near_counts(c, halves(len(groups[p]))[k][1])
    return Allocation(groups, near, n, radius)


def _probes(plan: Allocation, more: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                fp = part["fp"].to_numpy("int64")
                bits = bits_of(fp.view(np.uint64)).astype(np.int64)
                values = [bits[:, g] @ (1 << np.arange(len(g), dtype=np.int64)) for g in plan.groups]
                chosen = plan.choose(values)
                for p, masks in enumerate(plan.masks):
                    for t in range(plan.most + 1):
                        rows = np.flatnonzero(chosen[p] == t)
                        if len(rows):
                            m = np.concatenate(masks[: t + 1])
                            keys = (p << 32) | (values[p][rows][:, None] ^ m[None, :])
                            own = part.iloc[np.repeat(rows, len(m))]
                            yield own.assign(key=keys.ravel())[["key", "node", "fp", "c_size", "c_root", *more]]

    return probe


def link(
    nodes: DataFrame,
    radius: int,
    verify: Callable[[DataFrame], DataFrame] | None = None,
    pivots: int = 2,
    alike: Callable[[str], Column] | None = None,
    late: Sequence[str] = (),
    late_alike: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Edges (a, b) that connect whatever is within ``radius`` bits (and passes ``verify``).

    ``nodes`` (node, fp, n: rows that the node stands for), nodes unique; further columns (longs)
    are there for ``alike``, which gets a prefix and returns a condition on a column and that of the
    other node (with the prefix), so that candidates are ruled out before they are listed. The columns
    ``late`` are for ``late_alike`` alone: they are wider, and only probes that meet another component
    carry them. Edges between nodes
    that are connected otherwise may be left out; components are those of all links.
    """
    keep = verify or (lambda e: e)
    n = nodes.count()
    groups = bit_groups(nodes, parts_for(n))
    more = [c for c in nodes.columns if c not in ("node", "fp", "n", *late)]
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other_fp"))) <= radius
    if alike:
        apart = apart & alike("other_")
    others = [F.col(c).alias(f"other_{c}") for c in ("fp", *more)]
    keys = F.array(*[(F.lit(p << 32).cast("long").bitwiseOR(_value(F.col("fp"), g))) for p, g in enumerate(groups)])
    index = stored(nodes.select(F.explode(keys).alias("key"), "node", "fp", "n", *more), "index")
    near = []
    for k in range(pivots):
        # the node with most rows, then any; whatever is near it needs no other link
        weight = F.struct(*([F.col("n")] if k == 0 else []), F.xxhash64("node", F.lit(k)).alias("h"), F.col("node").alias("other"), *others)
        pivot = index.groupBy("key").agg(F.max(weight).alias("m"), F.count(F.lit(1)).alias("in_key")).filter("in_key > 1")
        pivot = pivot.select("key", "m.other", "m.other_fp", *[f"m.other_{c}" for c in more])
        found = attach(index.drop("n"), pivot, ["key"], "inner", by=["node"]).filter(apart & (F.col("node") != F.col("other")))
        near.append(found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")))
    edges = stored(keep(reduce(DataFrame.union, near).distinct()), "pivot-edges")
    discard(index)
    groups_so_far = stored(components(edges), "pivot-groups")
    size = groups_so_far.groupBy("root").agg(F.count(F.lit(1)).alias("c_size"))
    ranks = stored(attach(groups_so_far, size, ["root"], "left").select("node", F.col("root").alias("c_root"), "c_size"), "ranks")
    ranked = stored(
        nodes.drop("n").join(ranks, "node", "left").select("node", "fp", *more, F.coalesce("c_size", F.lit(1).cast("long")).alias("c_size"), F.coalesce("c_root", "node").alias("c_root"), *late),
        "ranked",
    )
    index = stored(ranked.select(F.explode(keys).alias("key"), F.col("node").alias("other"), *others, F.struct("c_size", "c_root").alias("rank"), *[F.col(c).alias(f"other_{c}") for c in late]), "index")
    top = index.groupBy("key").agg(F.max("rank").alias("top"))
    plan = allocation(nodes, groups, n, radius)
    probes = ranked.drop(*late).mapInPandas(_probes(plan, more), "key long, node long, fp long, c_size long, c_root long" + "".join(f", {c} long" for c in more))
    probes = attach(probes, top, ["key"], "inner", by=["node"]).withColumn("own", F.struct("c_size", "c_root"))
    # a pair of two components is found from the smaller one's side; without one in the bucket, no probe
    probes = probes.filter("own < top").select("key", "node", "fp", "own", *more)
    if late_alike:
        # a node has few probes, so no key of this join is hot
        probes = probes.join(nodes.select("node", *late), "node")
        apart = apart & late_alike("other_")
    across = probes.join(index, "key").filter((F.col("own") < F.col("rank")) & apart)
    across = keep(across.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())
    links = stored(edges.unionByName(across), "links")
    discard(edges, groups_so_far, ranks, ranked, index)
    return links


def near_duplicates(docs: DataFrame, radius: int = 3, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    marked = stored(docs.select("doc_id", fingerprint(F.col("text"), size).alias("fp")), "fingerprints")
    classes = stored(marked.groupBy(F.col("fp").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")), "classes")
    edges = link(classes.select("node", F.col("node").alias("fp"), "n"), radius)
    roots = components(edges)
    named = stored(classes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "classes")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = attach(named.select("node", "root"), least, ["root"], "inner").select(F.col("node").alias("fp"), "component_id")
    out = attach(marked, stored(named, "named"), ["fp"], "inner", by=["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- sets that share most of their hashes


def shingle_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How many shingles of the column ``text`` fall in each of BINS bins."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, held, waiting = np.zeros(BINS, np.int64), [], 0
        for batch in batches:
            for t in batch["text"]:
                held.append(shingle_hashes(t, size))
                waiting += len(held[-1])
                if waiting >= BINS:
                    n += np.bincount((np.concatenate(held) % np.uint64(BINS)).astype(np.int64), minlength=BINS)
                    held, waiting = [], 0
        if waiting:
            n += np.bincount((np.concatenate(held) % np.uint64(BINS)).astype(np.int64), minlength=BINS)
        blocks = n.reshape(-1, _BLOCK)
        some = np.flatnonzero(blocks.any(1))
        if len(some):
            yield pd.DataFrame({"block": some.astype("int32"), "n": [blocks[k].tolist() for k in some]})

    def add(found: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": found["block"].iloc[:1], "n": [np.sum(np.stack(found["n"].to_list()), 0).tolist()]})

    # BINS numbers whatever the input
    out = np.zeros((BINS // _BLOCK, _BLOCK), np.int64)
    for block, n in texts.select("text").mapInPandas(count, "block int, n array<long>").groupBy("block").applyInPandas(add, "block int, n array<long>").toLocalIterator():
        out[block] = n
    return out.ravel()


def rarest(hashes: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """Those of a set's (sorted, distinct) ``hashes`` that come first in one order of all hashes, from
    rare to common bins: so many that two sets of a Jaccard similarity of ``least`` have one in common.
    They share ``least`` of the larger set, so the first shared hash has at most the others before it."""
    n = len(hashes)
    order = np.argsort(counts[(hashes % np.uint64(BINS)).astype(np.int64)], kind="stable")
    return hashes[order[: n - int(np.ceil(least * n - 1e-9)) + 1]] if n else hashes


def with_least(keys: DataFrame) -> DataFrame:
    """(key, node, lo, n_rows) for keys of several nodes: the least node of each.

    Keys are counted first, and only those of several rows go on. Keys of up to RUN rows get their
    least node where the join left them; for longer ones it is aggregated before a shuffle.
    """
    several = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1"), "several")
    discard()
    whole = Window.partitionBy("key")
    # a row that comes several times counts once
    short = keys.join(several.filter(F.col("n_rows") <= RUN).select("key"), "key").select("key", "node").dropDuplicates(["key", "node"])
    tables = [short.select("key", "node", F.min("node").over(whole).alias("lo"), F.count(F.lit(1)).over(whole).alias("n_rows")).filter("n_rows > 1")]
    long = several.filter(F.col("n_rows") > RUN)
    if not long.isEmpty():
        rows = attach(keys, long.withColumn("n", F.col("n_rows")), ["key"], "inner", by=["node"], counted="n")
        rows = stored(rows.select("key", "node").distinct(), "long-keys")
        ends = rows.groupBy("key").agg(F.min("node").alias("lo"), F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
        tables.append(attach(rows, ends.withColumn("n", F.col("n_rows")), ["key"], "inner", by=["node"], counted="n").select("key", "node", "lo", "n_rows"))
    shared = stored(reduce(DataFrame.unionByName, tables), "shared-keys")
    discard(several, *([rows] if len(tables) > 1 else []))
    return shared


def link_shared(nodes: DataFrame, keys: DataFrame, alike: Callable[[str], Column], verify: Callable[[DataFrame], DataFrame], edges: DataFrame) -> DataFrame:
    """Edges (a, b) that connect whatever shares a key and passes ``alike`` and ``verify``, with ``edges``.

    ``nodes`` (node, and further columns of longs for ``alike``), nodes unique. ``alike`` gets a
    prefix and returns a condition on a column and that of the other node (with the prefix), by
    which candidates are ruled out before they are listed. ``keys`` are (key, node). Nodes that
    ``edges`` (links found before) connect are not compared again. The nodes of a key are compared
    with its least node first. Keys of more than two nodes whose nodes still are in different
    components are compared whole, from the smaller component's side. Key tables hold keys, nodes
    and components only; what ``alike`` needs is fetched per pair with the least node of a key, and
    for the keys that still hold several components.
    """
    more = [c for c in nodes.columns if c != "node"]
    so_far = components(edges)
    shared = with_least(keys)
    pairs = shared.filter("node <> lo").select(F.least("node", "lo").alias("a"), F.greatest("node", "lo").alias("b")).distinct()
    # a least node may be in any share of the pairs
    for end in ("a", "b"):
        pairs = attach(pairs, so_far.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), [end], "left")
    pairs = stored(pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"), "pairs")
    both = attach(pairs, nodes.withColumnRenamed("node", "a"), ["a"], "inner", by=["b"])
    both = attach(both, nodes.select(F.col("node").alias("b"), *[F.col(c).alias(f"other_{c}") for c in more]), ["b"], "inner", by=["a"])
    edges = stored(edges.unionByName(verify(both.filter(alike("other_")).select("a", "b"))), "edges")
    discard(pairs, so_far)
    so_far = components(edges)
    size = so_far.groupBy("root").agg(F.count(F.lit(1)).alias("c_size"))
    ranks = stored(attach(so_far, size, ["root"], "left").select("node", F.struct("c_size", F.col("root").alias("c_root")).alias("own")), "ranks")
    # of two nodes, the pair has been compared
    ranked = shared.filter("n_rows > 2").select("key", "node").join(ranks, "node", "left")
    ranked = stored(ranked.withColumn("own", F.coalesce("own", F.struct(F.lit(1).cast("long").alias("c_size"), F.col("node").alias("c_root")))), "ranked")
    discard(shared)
    mixed = ranked.groupBy("key").agg(F.min("own").alias("least"), F.max("own").alias("top")).filter("least < top").select("key", "top")
    mixed = stored(attach(ranked, mixed, ["key"], "inner", by=["node"]), "mixed-keys")
    discard(ranked)
    full = stored(mixed.join(nodes, "node"), "mixed-keys")
    # a pair of two components is found from the smaller one's side; without another in the bucket, no probe
    probes = full.filter("own < top").drop("top")
    index = full.select("key", F.col("node").alias("other"), *[F.col(c).alias(f"other_{c}") for c in more], F.col("own").alias("rank"))
    across = probes.join(index, "key").filter((F.col("own") < F.col("rank")) & alike("other_"))
    across = verify(across.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())
    links = stored(edges.unionByName(across), "links")
    discard(edges, mixed, full, ranks, so_far)
    return links


def drop_near_copies(docs: DataFrame, size: int = 5, least: float = 0.8, radius: int = 3) -> DataFrame:
    """``docs`` with one row, that of the smallest id, for each group of near copies.

    A link is a Jaccard similarity of at least ``least`` on shingles of ``size`` words. Texts whose
    SimHashes (of three-word shingles) differ in up to ``radius`` bits are found by the generalised
    pigeonhole, as :func:`near_duplicates` does, and compared exactly. SimHash cannot promise all
    such links, so the rest follows: pairs in different components so far share one of their
    rarest shingles. Rows of equal words are one node. Null ids come last.
    """

    sketch = [f"odd_{k}" for k in range(SKETCH)]
    names = ["node", "fp", "size", *sketch]
    counts = shingle_counts(docs, size)

    @F.pandas_udf(f"struct<{', '.join(f'{c}: long' for c in names)}, wide: binary, keys: array<long>>")
    def mark(texts: pd.Series) -> pd.DataFrame:
        from xxhash import xxh64_intdigest

        out = []
        for t in texts:
            own = np.unique(shingle_hashes(t, size))
            node = np.uint64(xxh64_intdigest(b" ".join((t or "").encode().lower().split()), 7)).view(np.int64)
            out.append((int(node), majority(shingle_hashes(t, 3)), len(own), *odd_sketch(own), wide_sketch(own), rarest(own, counts, least).view(np.int64)))
        return pd.DataFrame(out, columns=[*names, "wide", "keys"]).astype(dict.fromkeys(names, "int64"))

    # sets that similar differ in so many of all their hashes at most
    apart = (1 - least) / (1 + least)

    def may_be(other: str) -> Column:
        """Sets that similar have sizes as similar; they differ in few enough hashes, and their sketches in no more bits."""
        small, large = F.least("size", f"{other}size"), F.greatest("size", f"{other}size")
        bits = reduce(Column.__add__, [F.bit_count(F.col(c).bitwiseXOR(F.col(other + c))) for c in sketch])
        return (small >= least * large - 1e-9) & (bits <= apart * (small + large) + 1e-9)

    @F.pandas_udf("int")
    def bits_apart(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([differing(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.unique(shingle_hashes(x, size)), np.unique(shingle_hashes(y, size))
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= least * (len(x) + len(y) - both) - 1e-9)
        return pd.Series(out, dtype=bool)

    def row_key(df: DataFrame) -> DataFrame:
        return df.withColumn("rk", F.xxhash64(F.col("row")["doc_id"], F.col("row")["text"])).withColumn("id", F.col("row")["doc_id"])

    rows = row_key(docs.select(F.struct("*").alias("row")))
    made = stored(rows.select("rk", "id", mark(F.col("row")["text"]).alias("m")).select("rk", "id", "m.*"), "marks")
    order = F.struct(F.col("id").isNull().alias("nil"), F.col("id").alias("id"), F.col("rk").alias("rk"))
    classes = stored(made.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")), "classes")
    # keys, most of what is written, stay where they are; those of copies are left out
    copies = attach(made.select("rk", "node"), classes.filter("n > 1").select("node", F.col("first.rk").alias("kept")), ["node"], "inner", by=["rk"])
    copies = stored(copies.filter("rk <> kept").select("rk").distinct(), "copies")
    own = attach(made, copies, ["rk"], "left_anti")
    wide = stored(own.filter(F.octet_length("wide") > 0).select("node", "size", "wide").dropDuplicates(["node"]), "wide")

    def alike(edges: DataFrame) -> DataFrame:
        """Edges whose two texts are similar enough; only the texts that the sketches leave are read again."""
        pairs = stored(edges, "candidates")
        both = pairs
        for end in ("a", "b"):
            both = attach(both, wide.select(F.col("node").alias(end), F.col("size").alias(f"{end}_size"), F.col("wide").alias(f"{end}_wide")), [end], "left")
        few = F.col("a_wide").isNull() | F.col("b_wide").isNull()
        near = stored(both.filter(few).select("a", "b").unionByName(both.filter(~few).filter(bits_apart("a_wide", "b_wide") <= apart * (F.col("a_size") + F.col("b_size")) + 1e-9).select("a", "b")), "candidates")
        ends = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
        readers = stored(ends.join(classes, "node").select("node", F.col("first.rk").alias("rk")), "compared")
        texts = attach(rows.select("rk", F.col("row")["text"].alias("text")), readers.select("rk"), ["rk"], "left_semi")
        # texts are shuffled, which compress, not their hashes, which don't
        own = stored(texts.join(readers, "rk").select("node", "text").dropDuplicates(["node"]), "texts")
        both = near
        for end in ("a", "b"):
            both = attach(both, own.select(F.col("node").alias(end), F.col("text").alias(f"{end}_text")), [end], "inner")
        found = stored(both.filter(similar("a_text", "b_text")).select("a", "b"), "alike")
        discard(pairs, near, readers, own)
        return found

    close = link(classes.select("node", "fp", "n"), radius, alike)
    links = link_shared(classes.select("node", "size", *sketch), own.select(F.explode("keys").alias("key"), "node"), may_be, alike, close)
    marked = stored(made.select("rk", "id", "node"), "marks")
    discard(made, wide, copies, close)
    groups = stored(classes.join(components(links), "node", "left").select("node", "n", "first", F.coalesce("root", "node").alias("root")), "groups")
    firsts = groups.groupBy("root").agg(F.sum("n").alias("rows"), F.min("first").alias("kept")).filter("rows > 1")
    chosen = stored(attach(groups.select("node", "root"), firsts, ["root"], "inner").select("node", "kept"), "chosen")
    ruled = attach(marked, chosen, ["node"], "inner", by=["rk"])
    ruled = stored(
        ruled.groupBy("rk", "id").agg(F.max((F.col("rk") == F.col("kept.rk")) & F.col("id").eqNullSafe(F.col("kept.id"))).alias("stays"), F.count(F.lit(1)).alias("copies")),
        "ruled",
    )
    discard(links, marked, classes, groups, chosen)
    # only the names of rows that go, or that stay once of several, meet the texts
    known = ["rk", "known"]
    name = F.coalesce(F.col("id").cast("string"), F.lit("")).alias("known")
    rows = rows.select("row", "rk", name)
    left = attach(rows, stored(ruled.filter("not stays").select("rk", name), "gone"), known, "left_anti")
    again = stored(ruled.filter("stays and copies > 1").select("rk", name), "again")
    if not again.isEmpty():  # a row that comes several times stays once
        left = attach(left, again, known, "left_anti").unionByName(attach(left, again, known, "left_semi").dropDuplicates(known))
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
