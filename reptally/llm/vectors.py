"""Embedding near-duplicates on a robust-pruned flat graph.

Vectors of one label are dealt to overlapping shards, those of their nearest centres. In each
shard every vector gets neighbours by robust pruning: a near one makes all that lie closer to it
than to the vector needless. The adjacency lists of all shards are united to one flat graph. In
each shard a greedy search then runs from the medoid over that graph for every vector, and goes on
through all that lies within the range until nothing new does. Pairs found are verified by cosine
in double precision. Recall is audited against brute force on some vectors, and if it is too low
the shards overlap more.

Equal vectors of a label are one class, so that copies make neither long lists nor hot shards. A
shard above its bound is split in blocks and every two blocks are taken together, which loses no
pair.

Defined cases: vectors that are null, empty, zero or have null or non-finite parts, and vectors
without label, are rows that link with nothing; vectors of different lengths never link; rows
that repeat are linked to each other; null ids count as links but are no smallest id; extra
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import components, stored

LEAST = 0.98
#: Classes of a shard, as wished and at most before it is split.
SHARD, BOUND = 1000, 4000
#: Centres of a label, and of all labels; their vectors are what is broadcast.
CENTRES, ALL_CENTRES = 4096, 16384
#: Vectors per centre that centres are fitted on.
FIT = 20
OVERLAP = 2
CANDIDATES, DEGREE, ALPHA, BEAM = 48, 16, 1.2, 8
AUDITED, RECALL = 256, 0.9
#: Cells of the matrices that a task works on at once, whatever the size of a group or label.
CELLS = 1 << 20


def unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _blocks(n: int, width: int) -> list[slice]:
    """Rows of a matrix of ``n`` by ``width`` in blocks of up to CELLS cells."""
    step = max(1, CELLS // max(1, width))
    return [slice(at, at + step) for at in range(0, n, step)]


def _products(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``a`` and ``b`` of ``x``, pair by pair."""
    out = np.empty(len(a), x.dtype)
    for part in _blocks(len(a), x.shape[1]):
        out[part] = np.einsum("pd,pd->p", x[a[part]], x[b[part]])
    return out


def fit_centres(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Centres of unit vectors by a few rounds of k-means on the sphere; rows are in hash order."""
    centres = x[:k].copy()
    for _ in range(rounds):
        own = np.concatenate([np.argmax(x[rows] @ centres.T, axis=1) for rows in _blocks(len(x), len(centres))])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def pruned(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each unit vector by robust pruning of its nearest candidates."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, int)]
    c = min(CANDIDATES, n - 1)
    near = np.empty((n, c), int)
    for rows in _blocks(n, n):
        block = -(x[rows] @ x.T)
        block[np.arange(len(block)), rows.start + np.arange(len(block))] = np.inf
        part = np.argpartition(block, c - 1, axis=1)[:, :c]
        order = np.argsort(np.take_along_axis(block, part, 1), axis=1, kind="stable")
        near[rows] = np.take_along_axis(part, order, 1)

    def apart(of: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Distance of each row ``of`` to each of its row of ``others``."""
        out = np.empty(others.shape)
        for part in _blocks(len(of), c * x.shape[1]):
            out[part] = 1 - np.einsum("nd,ncd->nc", x[of[part]], x[others[part]])
        return out

    far = apart(np.arange(n), near)
    alive, kept = np.ones((n, c), bool), [[] for _ in range(n)]
    for _ in range(DEGREE):
        rows = np.flatnonzero(alive.any(1))
        if not len(rows):
            break
        first = alive[rows].argmax(1)
        chosen = near[rows, first]
        for r, p in zip(rows, chosen, strict=True):
            kept[r].append(p)
        alive[rows] &= ALPHA * apart(chosen, near[rows]) > far[rows]
        alive[rows, first] = False
    return [np.array(k, int) for k in kept]


def search(x: np.ndarray, lists: list[np.ndarray], least: float) -> np.ndarray:
    """Pairs within range (rows of a < b), by greedy search for every vector from the medoid and on
    through the range. ``lists`` are neighbours by place. Vectors are searched for in blocks."""
    n = len(x)
    medoid = int(np.argmax(x @ x.mean(0)))
    ends = np.concatenate([[0], np.cumsum([len(nb) for nb in lists])])
    graph = np.concatenate([*lists, np.zeros(0, int)]).astype(np.int64), ends
    found = [_search(x, graph, medoid, block, least) for block in _blocks(n, n)]
    keys = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]))
    return np.stack([keys // n, keys % n], axis=1)


def _search(x: np.ndarray, graph: tuple[np.ndarray, np.ndarray], medoid: int, block: slice, least: float) -> np.ndarray:
    """Pairs within range of the vectors of one block, as smaller place * len(x) + larger place."""
    n, first = len(x), block.start
    own = np.arange(first, min(block.stop, n))
    m = len(own)
    seen = np.zeros((m, n), bool)
    q = np.arange(m)
    beam = np.full((m, BEAM), -1)
    score = np.full((m, BEAM), -2.0)
    done = np.zeros((m, BEAM), bool)
    beam[:, 0], score[:, 0] = medoid, x[own] @ x[medoid]
    seen[:, medoid] = True
    found_q, found_v = [], []
    inside = np.flatnonzero(score[:, 0] >= least)
    found_q.append(inside)
    found_v.append(np.full(len(inside), medoid))
    while True:
        todo = np.where(done | (beam < 0), -3.0, score)
        best = todo.argmax(1)
        rows = q[todo[q, best] > -3]
        if not len(rows):
            break
        done[rows, best[rows]] = True
        a, b = _expand(graph, seen, rows, beam[rows, best[rows]])
        s = _products(x, first + a, b)
        hit = s >= least
        found_q.append(a[hit])
        found_v.append(b[hit])
        # the new ones of each query beside its beam; the best stay
        order = np.lexsort((-s, a))
        a, b, s = a[order], b[order], s[order]
        at = np.arange(len(a)) - np.searchsorted(a, a)
        ok = at < BEAM
        more_b, more_s = np.full((m, BEAM), -1), np.full((m, BEAM), -2.0)
        more_b[a[ok], at[ok]], more_s[a[ok], at[ok]] = b[ok], s[ok]
        all_b, all_s = np.hstack([beam, more_b]), np.hstack([score, more_s])
        all_d = np.hstack([done, np.zeros((m, BEAM), bool)])
        top = np.argsort(-all_s, axis=1, kind="stable")[:, :BEAM]
        beam, score, done = (np.take_along_axis(z, top, 1) for z in (all_b, all_s, all_d))
    # each vector lies in its own range, and so does what its range leads to
    alone = q[~seen[q, own]]
    seen[alone, own[alone]] = True
    front_q, front_v = np.concatenate([alone, *found_q]), np.concatenate([own[alone], *found_v])
    found_q.append(alone)
    found_v.append(own[alone])
    while len(front_q):
        a, b = _expand(graph, seen, front_q, front_v)
        hit = _products(x, first + a, b) >= least
        front_q, front_v = a[hit], b[hit]
        found_q.append(front_q)
        found_v.append(front_v)
    a, b = first + np.concatenate(found_q), np.concatenate(found_v)
    a, b = a[a != b], b[a != b]
    return np.unique(np.minimum(a, b) * np.int64(n) + np.maximum(a, b))


def _expand(graph: tuple[np.ndarray, np.ndarray], seen: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, neighbour) for neighbours of ``nodes`` that the queries have not seen yet; so many
    lists at once as have about CELLS neighbours."""
    flat, ends = graph
    sizes = ends[nodes + 1] - ends[nodes]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    found_a, found_b, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < len(nodes):
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] + CELLS, side="right")) - 1)
        own = sizes[at:stop]
        a = np.repeat(queries[at:stop], own)
        b = flat[np.arange(upto[stop] - upto[at]) + np.repeat(ends[nodes[at:stop]] - (upto[at:stop] - upto[at]), own)]
        ok = ~seen[a, b]
        key = np.unique(a[ok] * np.int64(seen.shape[1]) + b[ok])
        a, b = key // seen.shape[1], key % seen.shape[1]
        seen[a, b] = True
        found_a.append(a)
        found_b.append(b)
        at = stop
    return np.concatenate(found_a), np.concatenate(found_b)


def _dealt(classes: DataFrame, overlap: int) -> DataFrame:
    """(grp, shard, piece, class, embedding): each class in ``overlap`` shards of its group."""
    spark = classes.sparkSession
    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    total = classes.count()
    # as many centres as vectors ask for, within the bound on what is broadcast
    wished = F.least(F.ceil(F.col("n") / SHARD), F.lit(CENTRES), F.greatest(F.floor(F.col("n") * ALL_CENTRES / max(1, total)), F.lit(1))).cast("int")
    sizes = stored(sizes.select("grp", wished.alias("k"), "n"), "groups")
    several = sizes.filter("k > 1")
    sampled = attach(classes, several, ["grp"], "inner", by=["class"])
    sampled = sampled.filter(F.pmod(F.xxhash64("class", F.lit(3)), F.lit(1 << 20)) < (F.col("k") * FIT / F.col("n") * (1 << 20)))

    def centres(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(h=[hash((int(c), 7)) for c in group["class"]]).sort_values("h")
        c = fit_centres(unit(group["embedding"]), int(group["k"].iloc[0]))
        return pd.DataFrame({"grp": group["grp"].iloc[0], "centre": list(c.astype(np.float32))})

    fitted = sampled.select("grp", "class", "embedding", "k").groupBy("grp").applyInPandas(centres, "grp long, centre array<float>")
    table: dict[int, list] = {}
    for grp, centre in fitted.collect():  # at most ALL_CENTRES, whatever the input
        table.setdefault(grp, []).append(centre)
    shared = spark.sparkContext.broadcast({g: np.array(sorted(c), np.float32) for g, c in table.items()})

    @F.pandas_udf("array<int>")
    def nearest(grp: pd.Series, embedding: pd.Series) -> pd.Series:
        out = pd.Series([[0]] * len(grp))
        for g, rows in grp.groupby(grp).groups.items():
            c = shared.value.get(g)
            if c is not None:
                for at in range(0, len(rows), 1024):
                    part = rows[at : at + 1024]
                    near = unit(embedding.loc[part]) @ c.T
                    k = min(overlap, len(c))
                    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                    for i, t in zip(part, top, strict=True):
                        out[i] = t.tolist()
        return out

    placed = stored(classes.select("grp", "class", "embedding", F.explode(nearest("grp", "embedding")).alias("shard")), "placed")
    blocks = placed.groupBy("grp", "shard").agg(F.ceil(F.count(F.lit(1)) / BOUND).cast("int").alias("blocks"))
    placed = attach(placed, stored(blocks, "blocks"), ["grp", "shard"], "inner", by=["class"])
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.concat_ws("-", F.least(own, o), F.greatest(own, o)))
    return stored(placed.select("grp", "shard", "class", "embedding", F.explode(pairs).alias("piece")), "dealt")


def _links(classes: DataFrame, least: float, overlap: int) -> DataFrame:
    """(a, b): verified pairs of classes."""
    dealt = _dealt(classes, overlap)
    key = ["grp", "shard", "piece"]

    def build(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["class"].to_numpy(np.int64)
        lists = pruned(unit(group["embedding"]))
        a, b = np.repeat(ids, [len(x) for x in lists]), ids[np.concatenate([*lists, np.zeros(0, int)]).astype(int)]
        return pd.DataFrame({"class": np.concatenate([a, b]), "neighbour": np.concatenate([b, a])})

    graph = dealt.groupBy(*key).applyInPandas(build, "class long, neighbour long")
    graph = stored(graph.groupBy("class").agg(F.collect_set("neighbour").alias("neighbours")), "graph")

    def find(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("class", kind="stable")
        ids, x = group["class"].to_numpy(np.int64), unit(group["embedding"])
        lists = []
        for nb in group["neighbours"]:
            nb = np.sort(np.asarray(nb if nb is not None else [], np.int64))
            at = np.minimum(np.searchsorted(ids, nb), len(ids) - 1)
            lists.append(at[ids[at] == nb])
        pairs = search(x.astype(np.float32), lists, least - 1e-4)
        # in double precision, from the vectors as they are given
        raw = np.stack([np.asarray(e, np.float64) for e in group["embedding"]])
        norms = np.sqrt(np.einsum("nd,nd->n", raw, raw))
        cos = _products(raw, pairs[:, 0], pairs[:, 1]) / (norms[pairs[:, 0]] * norms[pairs[:, 1]])
        pairs = pairs[cos >= least]
        return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    with_lists = attach(dealt, graph, ["class"], "left", by=key)
    return stored(with_lists.groupBy(*key).applyInPandas(find, "a long, b long").distinct(), "links")


def audit(classes: DataFrame, links: DataFrame, least: float, sample: int = AUDITED) -> float:
    """Part of the links that brute force finds for at most ``sample`` classes, taken by hash."""
    n = classes.count()
    chosen = classes.filter(F.pmod(F.xxhash64("class", F.lit(11)), F.lit(1 << 20)) < int(min(1.0, sample / max(1, n)) * (1 << 20)))
    queries: dict[int, list] = {}
    for r in chosen.select("grp", "class", "embedding").collect():  # bounded by `sample`
        queries.setdefault(r["grp"], []).append((r["class"], r["embedding"]))
    if not queries:
        return 1.0
    shared = classes.sparkSession.sparkContext.broadcast({g: (np.array([c for c, _ in v]), unit([e for _, e in v])) for g, v in queries.items()})

    def brute(batches):
        for batch in batches:
            for g, part in batch.groupby("grp"):
                if g in shared.value:
                    ids, q = shared.value[g]
                    other = part["class"].to_numpy(np.int64)
                    i, j = np.nonzero(unit(part["embedding"]) @ q.T >= least + 1e-9)
                    a, b = other[i], ids[j]
                    yield pd.DataFrame({"a": np.minimum(a, b)[a != b], "b": np.maximum(a, b)[a != b]})

    true = stored(classes.mapInPandas(brute, "a long, b long").distinct(), "audit")
    total = true.count()
    return true.join(links, ["a", "b"]).count() / total if total else 1.0


def near_duplicates(vectors: DataFrame, least: float = LEAST, overlap: int = OVERLAP, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label)."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(e, lambda v: v != 0), F.lit(False))
    rows = vectors.select("vec_id", "embedding", F.xxhash64(F.col("label"), F.size(e)).alias("grp"), usable.alias("usable"))
    rows = rows.select("vec_id", "usable", "grp", "embedding", F.xxhash64("grp", "embedding").alias("h1"), F.hash("embedding", "grp").alias("h2"))
    marked = stored(rows, "vectors")
    classes = marked.filter("usable").groupBy("grp", "h1", "h2").agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("class"), "*"), "classes")
    plain = classes.select("grp", "class", "embedding")
    while True:
        links = _links(plain, least, overlap)
        if audit(plain, links, least) >= recall or overlap >= 16:
            break
        overlap *= 2
    sizes = classes.select("class", "n")
    ends = links.select(F.col("a").alias("class"), F.col("b").alias("other")).union(links.select("b", "a"))
    linked = attach(ends, sizes.withColumnsRenamed({"class": "other"}), ["other"], "inner").groupBy("class").agg(F.sum("n").alias("linked"))
    roots = components(links)
    named = classes.drop("embedding").join(linked, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = stored(named.select("h1", "h2", "least", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "class").alias("root")), "named")
    least_of = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(attach(named.drop("least"), least_of, ["root"], "inner").select("h1", "h2", "n_links", "component_id"), "named")
    out = attach(marked.select("vec_id", "usable", "h1", "h2"), named, ["h1", "h2"], "left", by=["vec_id"])
    own = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(F.col("usable"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )
