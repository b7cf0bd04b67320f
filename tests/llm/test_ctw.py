import math
import random
import zlib
from collections import Counter

import pytest

from reptally.llm import ctw


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def lower(t):
    return (t or "").encode().lower()


def brute(rows, depth):
    """Context-tree weighting by its definition, on the counts of the training rows."""
    counts, kids = {}, {}

    def places(data):
        full = b"\xff" * depth + data + b"\xff"
        for i in range(depth, len(full)):
            for k in range(8):
                yield full[i - depth : i], (1 << k) | (full[i] >> (8 - k)), (full[i] >> (7 - k)) & 1

    for i, t in rows:
        for context, node, bit in places(lower(t)):
            for d in range(depth + 1):
                c = counts.setdefault((context[depth - d :], node), [0, 0])
                c[bit] += 0 if held(i) else 1
                if d:
                    kids.setdefault((context[depth - d + 1 :], node), set()).add(context[depth - d :])

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    weights = {}

    def log_w(context, node):
        if (context, node) not in weights:
            own = kt(*counts[context, node])
            if len(context) == depth:
                weights[context, node] = (own, 1.0)
            else:
                below = sum(log_w(k, node) for k in kids[context, node])
                top = max(own, below)
                mixed = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(below - top))
                weights[context, node] = (mixed, 0.5 * math.exp(own - mixed))
        return weights[context, node][0]

    out = []
    for _, t in rows:
        total = 0.0
        for context, node, bit in places(lower(t)):
            p, rest = 0.0, 1.0
            for d in range(depth + 1):
                c = context[depth - d :]
                log_w(c, node)
                a, b = counts[c, node]
                stop = weights[c, node][1]
                p += rest * stop * ((b if bit else a) + 0.5) / (a + b + 1)
                rest *= 1 - stop
            total += math.log10(p)
        out.append(total)
    return out


def base(rows):
    tokens = [[*lower(t).split(), None] for _, t in rows]
    counts = Counter(w for (i, _), ws in zip(rows, tokens, strict=True) if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return n, [(len(ws), sum(counts[w] > 0 for w in ws), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for ws in tokens]


@pytest.mark.parametrize("depth", [0, 1, 2, 4])
def test_against_definition(docs, depth):
    rnd = random.Random(depth)
    rows = [(k, "".join(rnd.choice("abé \nAB") for _ in range(rnd.randint(0, 60)))) for k in range(25)] + [(None, "ab"), (30, None)]
    got = ctw.score(docs(*rows), depth, block_bytes=700).collect()
    n, want = base(rows)
    scores = brute(rows, depth)
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for (i, _), (tokens, known, b), s in zip(rows, want, scores, strict=True):
        r = by_id[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), tokens, known, n)
        assert r["base_score"] == pytest.approx(b, rel=1e-9) and r["score"] == pytest.approx(s, rel=1e-8)


def test_edge_rows(docs, edge_rows):
    got = ctw.score(docs(*edge_rows), 2).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in edge_rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert ctw.score(docs((1, "a")).limit(0)).count() == 0


def test_only_held_out_rows(docs):
    i = next(k for k in range(100) if held(k))
    (r,) = ctw.score(docs((i, "ab")), 2).collect()
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
    assert r["score"] == pytest.approx(3 * 8 * math.log10(0.5))


def test_deeper_contexts_predict_held_out_texts_better(docs):
    rnd = random.Random(1)
    parts = ["an", "th", "er", "in", "on", "re"]
    rows = [(k, " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 5))) for _ in range(60))) for k in range(80)]
    cost = [sum(r["bits_per_byte"] for r in ctw.score(docs(*rows), d).collect() if r["held_out"]) for d in (0, 1, 4)]
    assert cost[0] > 1.1 * cost[1] > 1.1 * cost[2] > 0
