import zlib
from collections import Counter, defaultdict

from reptally.llm import sharding


def check(docs, rows, n=8):
    got = sharding.shard(docs(*rows), n).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    counts = Counter(r["shard"] for r in got)
    sizes = [counts.get(s, 0) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    return got


def test_edge_rows(docs, edge_rows):
    check(docs, edge_rows)


def test_empty_table(docs):
    assert sharding.shard(docs((1, "a")).limit(0)).count() == 0


def test_equal_texts_meet(docs):
    rows = [(k, f"text {k}") for k in range(400)] + [(1000 + k, f"copy {k % 40}") for k in range(120)]
    got = check(docs, rows)
    text = dict(rows)
    where = defaultdict(set)
    for r in got:
        where[text[r["doc_id"]]].add(r["shard"])
    assert all(len(v) == 1 for t, v in where.items() if t.startswith("copy"))


def test_hot_group_of_a_third(docs):
    rows = [(k, "same" if k % 3 == 0 else f"text {k}") for k in range(900)]
    got = check(docs, rows)
    # the group fills whole shards and is split as little as the quota of a shard asks for
    inside = Counter(r["shard"] for r in got if r["doc_id"] % 3 == 0)
    assert max(inside.values()) > 300 / 8 * 1.5


def test_links_given(docs, spark):
    rows = [(k, f"t{k}") for k in range(200)]
    members = spark.createDataFrame([(k, f"h{k // 5}") for k in range(100)], "doc_id long, hub string")
    got = sharding.shard(docs(*rows), 4, members=members).collect()
    where = defaultdict(set)
    for r in got:
        if r["doc_id"] < 100:
            where[r["doc_id"] // 5].add(r["shard"])
    assert sum(len(v) == 1 for v in where.values()) >= 18
