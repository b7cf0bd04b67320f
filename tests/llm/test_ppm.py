import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from reptally.llm import ppm

EDGE = 255
SCHEMA = "doc_id long, text string, lang string, source string, data string, held_out string, letters int, id string"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def train(texts, order):
    counts = defaultdict(Counter)
    for t in texts:
        data = [EDGE] * order + list(t.encode()) + [EDGE]
        for i in range(order, len(data)):
            for d in range(order + 1):
                counts[tuple(data[i - d : i])][data[i]] += 1
    return counts


def length(counts, text, order):
    """PPM by its definition: method C with exclusion, all orders counted."""
    data = [EDGE] * order + list(text.encode()) + [EDGE]
    bits = 0.0
    for i in range(order, len(data)):
        gone = set()
        for d in range(order, -1, -1):
            seen = {b: n for b, n in counts.get(tuple(data[i - d : i]), {}).items() if b not in gone}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / whole)
                break
            bits -= math.log2(len(seen) / whole)
            gone |= set(seen)
        else:
            bits += math.log2(256 - len(gone))
    return bits


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "d", "h", 1, "x") for i, t, lang in rows], SCHEMA)


def made(rnd, letters, n):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(n))


def rows_of(seed, n=60):
    rnd = random.Random(seed)
    kinds = {"aa": "abcdeé", "bb": "defghü", "cc": "xyzabc"}
    return [(k, made(rnd, letters, rnd.randint(1, 12)), lang) for k in range(n) for lang, letters in [rnd.choice(list(kinds.items()))]]


@pytest.mark.parametrize("order", [0, 1, 2, 4])
def test_code_lengths_by_definition(spark, order):
    rows = rows_of(order)
    rows += [(100, "??? 7", "aa"), (101, None, "aa"), (102, "unseen ŵ", None), (None, "ab abd", "bb")]
    got = {r["doc_id"]: r for r in ppm.predict(frame(spark, rows), order).collect()}
    assert len(got) == len(rows)
    training = [(t, lang) for i, t, lang in rows if not held(i) and t is not None and lang is not None]
    models = {lang: train([t for t, own in training if own == lang], order) for lang in {x[1] for x in training}}
    shares = Counter(lang for _, lang in training)
    for i, t, _ in rows:
        r = got[i]
        assert r["held_out"] == held(i)
        if t is None or not any(c.isalpha() for c in t):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        costs = {lang: length(m, t, order) - math.log2(shares[lang] / len(training)) for lang, m in models.items()}
        best = min(costs.values())
        assert costs[r["lang_pred"]] == pytest.approx(best, rel=1e-9)
        assert r["score"] == pytest.approx(1 / sum(2 ** (best - c) for c in costs.values()), rel=1e-6)
        assert r["bits_per_byte"] == pytest.approx(best / (len(t.encode()) + 1), rel=1e-9)


def test_probabilities_of_all_bytes_sum_to_one():
    rnd = random.Random(3)
    data = np.frombuffer(bytes([EDGE] * 2) + made(rnd, "abc", 200).encode(), np.uint8)
    keys, n = np.unique(ppm.places(data, 2), return_counts=True)
    tree = ppm.Tree.of(keys, n.astype(float), 2)
    for context in [*np.unique(keys >> 8)[:40], 7 << 8 | 9]:
        total = np.exp2(-tree.bits((int(context) << 8) + np.arange(256))).sum()
        assert total == pytest.approx(1.0)


@pytest.mark.parametrize("chunk", [3, 64, 1 << 20])
def test_pieces_of_any_size_cost_the_same(chunk):
    rnd = random.Random(5)
    texts = [made(rnd, "abcd", rnd.randint(0, 40)).encode() for _ in range(20)] + [b"", b"x" * 500, b""]
    framed = [bytes([EDGE] * 3) + t + bytes([EDGE]) for t in texts]
    data = np.frombuffer(b"".join(framed), np.uint8)
    offsets = np.cumsum([0, *map(len, framed)])
    keys, n = np.unique(ppm.places(data, 3), return_counts=True)
    trees = [ppm.Tree.of(keys, n.astype(float), 3)]
    got = ppm.costs(data, offsets, trees, 3, chunk)[:, 0]
    assert got == pytest.approx([sum(trees[0].bits(ppm.places(np.frombuffer(f, np.uint8), 3))) for f in framed])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in ppm.predict(docs).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in got) >= 0.99 * len(got) > 100


def test_lang_source_and_id_are_no_inputs(spark):
    rows = rows_of(9)
    before = {r["doc_id"]: r for r in ppm.predict(frame(spark, rows), 2).collect()}
    turned = [(i, t, "zz" if held(i) else lang) for i, t, lang in rows]
    assert {r["doc_id"]: r for r in ppm.predict(frame(spark, turned), 2).collect()} == before


def test_edges(spark):
    assert ppm.predict(frame(spark, [])).count() == 0
    assert [tuple(r)[2:4] for r in ppm.predict(frame(spark, [(1, "abc", None)])).collect()] == [("und", 0.0)]
    long = "ab " * 2_000_000
    got = {r["doc_id"]: r["lang_pred"] for r in ppm.predict(frame(spark, [(0, "abab ab", "aa"), (2, "xyz xy", "bb"), (3, long, None), (3, long, None), (4, "xyx", None)])).collect()}
    assert got[3] == "aa" and got[4] == "bb"
