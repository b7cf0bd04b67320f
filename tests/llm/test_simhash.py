import random
from collections import defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from reptally.llm import simhash


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component(fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def check(docs, rows):
    got = simhash.near_duplicates(docs(*rows)).collect()
    assert len(got) == len(rows)
    fps = [fingerprint(t) for _, t in rows]
    roots = component(fps, 3)
    least = {}
    for r, (i, _) in zip(roots, rows, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, roots, strict=True))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want
    return want


def test_edge_rows(docs, edge_rows):
    check(docs, edge_rows)
    assert simhash.near_duplicates(docs((1, "a")).limit(0)).count() == 0


def test_near_copies_and_chains(docs):
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(40):
        words = [rnd.choice(vocabulary) for _ in range(250)]
        for j in range(6):
            rows.append((k * 10 + j, " ".join(words)))
            words[rnd.randrange(250)] = rnd.choice(vocabulary)
    want = check(docs, rows)
    assert len({w[2] for w in want}) < 200


def random_fps(rnd, n, groups):
    out = [int(rnd.integers(0, 2**63)) for _ in range(n)]
    for g in range(groups):
        for _ in range(12):
            fp = out[g]
            for b in rnd.choice(64, rnd.integers(0, 9), replace=False):
                fp ^= 1 << int(b)
            out.append(fp - (1 << 64) if fp >= 1 << 63 else fp)
    return sorted(set(out))


@pytest.mark.parametrize(("radius", "parts"), [(3, 4), (7, 4), (3, 3), (5, 2)])
def test_links_are_those_of_brute_force(spark, monkeypatch, radius, parts):
    monkeypatch.setattr(simhash, "parts_for", lambda n: parts)
    fps = random_fps(np.random.default_rng(radius * parts), 150, 25)
    # a common top half, so that one part hardly tells fingerprints apart
    fps = sorted({(f & 0xFFFFFFFF) | (0x1234 << 48) if k % 3 else f for k, f in enumerate(fps)})
    nodes = spark.createDataFrame([(f, f, 1) for f in fps], "node long, fp long, n long")
    edges = simhash.link(nodes, radius).collect()
    unsigned = [f % (1 << 64) for f in fps]
    at = {f: k for k, f in enumerate(fps)}
    assert all((unsigned[at[e["a"]]] ^ unsigned[at[e["b"]]]).bit_count() <= radius for e in edges)
    joined = component([0] * 0, 0) or list(range(len(fps)))

    def find(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for e in edges:
        x, y = find(at[e["a"]]), find(at[e["b"]])
        joined[max(x, y)] = min(x, y)
    assert [find(k) for k in range(len(fps))] == component(unsigned, radius)


def test_thresholds_sum_to_what_the_principle_asks(spark):
    groups = [list(range(k * 16, k * 16 + 16)) for k in range(4)]
    near = [[simhash._near_counts(np.ones(1 << 16), 16)] for _ in groups]
    near[0][0] = near[0][0] * 1000  # a part that tells nothing apart
    plan = simhash.Allocation(groups, near, 1 << 16, 3)
    chosen = plan.choose([np.array([5, 9])] * 4)
    assert (chosen.sum(0) == 0).all() and (chosen[0] == -1).all()


def test_components_of_chains_and_stars(spark):
    from reptally.llm.common import components

    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 80)] + [(5000, 5000)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r["root"]].add(r["node"])
    assert sorted(map(len, groups.values())) == [61, 80]


def test_stage_keeps_one_of_each_group(docs, edge_rows):
    rnd = random.Random(8)
    vocabulary = [f"v{k}" for k in range(500)]
    rows = list(edge_rows)
    for k in range(30):
        words = [rnd.choice(vocabulary) for _ in range(200)]
        rows.append((100 + 10 * k, " ".join(words)))
        for j in range(1, 3):  # two words of 200 changed: similarity 0.9
            copy = list(words)
            for _ in range(2):
                copy[rnd.randrange(200)] = rnd.choice(vocabulary)
            rows.append((100 + 10 * k + j, " ".join(copy)))
    df = docs(*rows)
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    left = [r["doc_id"] for r in out.collect()]
    planted = [i for i in left if i and i >= 100]
    assert len(planted) <= 32 and {100 + 10 * k for k in range(30)} <= set(planted)
    # of the edge rows: one without words, one of the equal texts (with its near copy), all others
    others = sorted(i for i in left if i and i < 100)
    assert others == [1, 4, *range(7, 11), *range(20, 50)]
    assert simhash.drop_near_copies(df.limit(0)).count() == 0


def test_counts_take_partitions_without_rows(spark, docs):
    texts = docs((1, "a b c")).select("text").repartition(1).unionByName(docs((2, None)).select("text").filter("text is not null"))
    assert simhash.shingle_counts(texts, 5).sum() == 1


def test_odd_sketches_differ_in_no_more_bits_than_sets_in_hashes():
    rng = np.random.default_rng(5)
    for n, other in [(0, 0), (0, 3), (1, 0), (40, 10), (400, 90), (3000, 700), (3000, 3000)]:
        both = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        own = np.unique(rng.integers(0, 1 << 63, other, dtype=np.uint64))
        a, b = simhash.odd_sketch(both), simhash.odd_sketch(np.union1d(both, own))
        assert len(a) == simhash.SKETCH and all(-(1 << 63) <= x < 1 << 63 for x in a)
        differ = sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) + (1 << 64)).bit_count() for x, y in zip(a, b, strict=True))
        assert differ <= len(np.setdiff1d(own, both)) and (differ > 0 or other == 0)


@pytest.mark.parametrize("run", [simhash.RUN, 2])
def test_stage_links_all_that_brute_force_does(docs, no_broadcast, monkeypatch, run):
    """Truncated, lengthened, framed and short copies, and chains of them."""
    monkeypatch.setattr(simhash, "RUN", run)
    rnd = random.Random(21)
    vocabulary = [f"v{k}" for k in range(3000)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    common = text(12)
    texts = []
    for k in range(60):
        words = text(rnd.choice([6, 12, 30, 60, 200, 500])) + common
        n = len(words)
        texts += [words, words[: int(n * rnd.uniform(0.8, 0.95))], words + text(int(n * rnd.uniform(0.05, 0.25))), text(n // 10) + words + text(n // 10)]
        texts.append([w if rnd.random() > 0.02 else rnd.choice(vocabulary) for w in words])
    rnd.shuffle(texts)
    sets = [{tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    left = simhash.drop_near_copies(docs(*[(k, " ".join(t)) for k, t in enumerate(texts)])).collect()
    assert len(set(root)) < 250
    assert sorted(r["doc_id"] for r in left) == sorted(set(root))


@pytest.mark.parametrize("least", [0.5, 0.8, 0.9])
def test_similar_sets_share_one_of_their_rarest_hashes(least):
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 5, simhash.BINS)
    for n in [1, 2, 3, 4, 5, 9, 10, 20, 50, 333]:
        for _ in range(30):
            own = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            other = np.union1d(rng.permutation(own)[rng.integers(0, n) :], rng.integers(0, 1 << 63, rng.integers(0, n // 4 + 1), dtype=np.uint64))
            if len(np.intersect1d(own, other)) >= least * len(np.union1d(own, other)) - 1e-9:
                assert len(np.intersect1d(simhash.rarest(own, counts, least), simhash.rarest(other, counts, least)))


def test_stage_links_by_simhash_before_the_rest(docs, monkeypatch):
    """Links come from the pigeonhole on op5's fingerprints; what it can't see comes after."""
    rnd = random.Random(12)
    vocabulary = [f"v{k}" for k in range(2000)]
    texts = []
    for _ in range(12):
        words = [rnd.choice(vocabulary) for _ in range(400)]
        one = list(words)
        one[rnd.randrange(400)] = "other"
        texts += [words, one, words[:340]]
    texts = [" ".join(t) for t in texts]
    links = []

    def recorded(*args, _link=simhash.link, **named):
        edges = _link(*args, **named)
        links.extend((r["a"], r["b"]) for r in edges.collect())
        return edges

    monkeypatch.setattr(simhash, "link", recorded)
    left = simhash.drop_near_copies(docs(*enumerate(texts))).collect()
    at = {int(np.uint64(xxh64_intdigest(t.encode(), 7)).view(np.int64)): k for k, t in enumerate(texts)}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    fps = [fingerprint(t) for t in texts]
    near = {(a, b) for b in range(len(texts)) for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    close = {(a, b) for a, b in near if (fps[a] ^ fps[b]).bit_count() <= 3}
    found = {tuple(sorted((at[a], at[b]))) for a, b in links}
    assert found and found <= close and {b for _, b in found} == {b for _, b in close}
    assert close < near  # the rest is there to be found, and is
    assert sorted(r["doc_id"] for r in left) == list(range(0, 36, 3))


def test_wide_sketches_differ_in_no_more_bits_than_sets_in_hashes():
    rng = np.random.default_rng(6)
    assert simhash.differing(b"", simhash.wide_sketch(np.arange(1000, dtype=np.uint64))) == 0
    for n, other in [(300, 0), (300, 20), (500, 60), (1000, 240), (4000, 900), (900, 5000)]:
        both = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        own = np.unique(rng.integers(0, 1 << 63, other, dtype=np.uint64))
        a, b = simhash.wide_sketch(both), simhash.wide_sketch(np.union1d(both, own))
        assert 8 * len(a) >= 2 * len(both) and 8 * len(b) >= 2 * (n + other)
        differ = simhash.differing(a, b)
        assert differ == simhash.differing(b, a) <= other and (differ > other // 2 or len(a) < len(b) or not other)


def test_stage_keeps_repeated_rows_once(docs):
    rnd = random.Random(2)
    text = " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 9) for _ in range(300))
    rows = [(7, text)] * 5 + [(8, text + " tail")] * 3 + [(None, text)] * 2 + [(9, "alone in the table with its words")] * 2 + [(None, "a text without an id, twice")] * 2
    assert sorted(str(r["doc_id"]) for r in simhash.drop_near_copies(docs(*rows)).collect()) == ["7", "9", "None"]
