from collections import defaultdict

import numpy as np
import pytest

from reptally.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, grp string, h1 int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], lab, "x", 0) for i, e, lab in rows], SCHEMA)


def brute(rows, least=0.98):
    n, root = defaultdict(int), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ok = []
    for _, e, lab in rows:
        v = None if e is None or lab is None or any(x is None for x in e) else np.array(e, np.float32).astype(float)
        ok.append(v if v is not None and len(v) and np.isfinite(v).all() and v.any() else None)
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] is not None and ok[b] is not None and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]):
                if ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= least:
                    n[a] += 1
                    n[b] += 1
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    least_of = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least_of[find(k)] = min(i, least_of.get(find(k), i))
    return sorted((str(i), n[k], least_of.get(find(k)) if ok[k] is not None else i) for k, (i, _, _) in enumerate(rows))


def near(rnd, v, spread):
    w = v + rnd.normal(size=len(v)) * spread
    return w / np.linalg.norm(w)


def sample(seed, n, groups, dim=16):
    rnd = np.random.default_rng(seed)
    rows = [(k, rnd.normal(size=dim), int(k % 3)) for k in range(n)]
    for g in range(groups):
        v = rnd.normal(size=dim)
        v /= np.linalg.norm(v)
        rows += [(n + 100 * g + j, near(rnd, v, 0.03), g % 3) for j in range(8)]
    return rows


@pytest.mark.parametrize("shard", [1000, 40])
def test_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(vectors, "SHARD", shard)
    rows = sample(shard, 300, 30)
    got = vectors.near_duplicates(frame(spark, rows)).collect()
    have = sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got)
    want = brute(rows)
    assert sum(h[1] for h in have) >= 0.97 * sum(w[1] for w in want) > 0
    if shard == 1000:
        assert have == want
    assert all(h[1] <= w[1] for h, w in zip(have, want, strict=True))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_split_shards_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BOUND", 60)
    rows = sample(2, 200, 25)
    got = vectors.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got) == brute(rows)


def test_edge_rows(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0, 0, 0], 1), (4, [1, None, 2], 1), (5, [1, nan, 2], 1), (6, [1, inf, 2], 1), (7, v, None)]
    rows += [(8, v, 1), (9, v, 1), (9, v, 1), (10, [2.0, 4.0, 6.0], 1), (11, v, 2), (None, v, 1), (12, [1.0, 2.0], 1), (13, [-1.0, -2.0, -3.0], 1)]
    got = vectors.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got) == brute(rows)
    assert vectors.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_many_copies_are_one_class(spark):
    rows = [(k, [1.0, 0.0, 0.5], 1) for k in range(500)] + [(500 + k, [1.0, 0.01 * k, 0.5], 1) for k in range(1, 5)]
    got = vectors.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got) == brute(rows)


def test_work_of_a_group_comes_in_blocks(monkeypatch):
    """Centres, pruning and search give the same in small blocks, and hold no matrix of all rows by all."""
    rnd = np.random.default_rng(17)
    x = vectors.unit(np.concatenate([rnd.normal(size=(300, 16)), rnd.normal(size=(1, 16)) + rnd.normal(size=(100, 16)) * 0.02]))
    whole = vectors.fit_centres(x, 20), vectors.pruned(x)
    hub = [np.union1d(nb, [0]).astype(int) for nb in whole[1]]
    hub[0] = np.arange(len(x))
    links = vectors.search(x.astype(np.float32), hub, 0.98)
    assert len(links) > 4000 and (links[:, 0] < links[:, 1]).all()
    monkeypatch.setattr(vectors, "CELLS", 512)
    assert np.allclose(vectors.fit_centres(x, 20), whole[0])
    assert all(np.array_equal(a, b) for a, b in zip(vectors.pruned(x), whole[1], strict=True))
    assert np.array_equal(vectors.search(x.astype(np.float32), hub, 0.98), links)


def test_centres_of_a_large_label_take_little_memory():
    import tracemalloc

    x = vectors.unit(np.random.default_rng(1).normal(size=(20_000, 8)))
    tracemalloc.start()
    try:
        vectors.fit_centres(x, 1000, rounds=1)
        assert tracemalloc.get_traced_memory()[1] < 40e6  # all rows by all centres are 160 MB
    finally:
        tracemalloc.stop()
