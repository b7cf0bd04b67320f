import hashlib
import re

import pytest

from reptally.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items):
    out = []
    for i, t in rows:
        w = words(t)
        hit, found = [False] * len(w), set()
        for item, x in items:
            own = words(x)
            n = min(10, len(own))
            for a in range(len(own) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == own[a : a + n]:
                        hit[b : b + n] = [True] * n
                        found.add(item)
        named = sorted(str(f) for f in found if f is not None)
        out.append((str(i), len(w), sum(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), any(hit)))
    return sorted(out)


ITEMS = [
    ("q1", "Alpha beta, gamma; delta EPSILON zeta eta theta iota kappa lambda mu"),
    ("q2", "short item"),
    ("q3", "alpha beta gamma delta epsilon zeta eta theta iota kappa and more"),
    (None, "nameless item here"),
    ("q2", "short item"),
    ("q4", None),
    ("q5", " ,. "),
    ("q6", "ünïcode Straße"),
]
ROWS = [
    (1, "x alpha beta gamma-delta epsilon zeta eta theta iota kappa lambda y"),
    (2, "a short item and SHORT\nITEM"),
    (3, "nameless item here"),
    (4, "ÜNÏCODE straße, ünïcode strasse, ünïcode STRAßE"),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (6, None),
    (None, ""),
    (7, "short " * 50 + "item"),
    (7, "short " * 50 + "item"),
]


@pytest.fixture
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


@pytest.mark.parametrize("set_bytes", [1 << 20, 40])
def test_against_brute_force(docs, bench, edge_rows, set_bytes):
    rows = ROWS + edge_rows
    got = decontamination.scan(docs(*rows), bench, set_bytes=set_bytes).collect()
    assert sorted((str(r["doc_id"]), *r[1:]) for r in got) == brute(rows, ITEMS)


@pytest.mark.parametrize("set_bytes", [1 << 20, 40])
def test_stage(docs, bench, edge_rows, set_bytes):
    rows = [*ROWS, *((i and i + 200, t) for i, t in edge_rows), (50, "keep " * 30 + "short short item item" + " keep" * 30)]
    df = docs(*rows)
    out = decontamination.decontaminate(df, bench, set_bytes=set_bytes)
    assert out.columns == df.columns
    got = out.collect()
    assert not any(r["contaminated"] for r in decontamination.scan(out, bench).collect())
    ids = [r["doc_id"] for r in got]
    assert 1 not in ids and 3 not in ids and ids.count(7) == 2
    text = {r["doc_id"]: r["text"] for r in got}
    assert text[6] is None and text[5] == ROWS[4][1]
    assert " ".join(text[50].split()) == " ".join(["keep"] * 60)  # what moves together is looked at again
    clean = {i for i, *_, c in brute(rows, ITEMS) if not c}
    same = dict(rows)
    assert all(text[i] == same[i] for i in text if i is not None and str(i) in clean)


def test_empty_tables(docs, bench):
    assert decontamination.scan(docs((1, "a")).limit(0), bench).count() == 0
    (r,) = decontamination.scan(docs((1, "a short item")), bench.limit(0)).collect()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (3, 0, False)
    assert decontamination.decontaminate(docs((1, "a short item")), bench.limit(0)).count() == 1


def test_parts_of_a_large_benchmark(spark, docs):
    """A benchmark of ten times the bound, with an item that comes 40 times: parts stay within the bound,
    one is held at a time, and what is cut is what a single set would cut."""
    items = [(f"i{k}", " ".join(f"w{k}x{j}" for j in range(12))) for k in range(300)] + [("again", "same " * 11 + "end")] * 40
    bench = spark.createDataFrame(items, "item_id string, text string")
    bound = sum(len(t) for _, t in set(items)) // 10
    parts = decontamination.Parts(bench, bound)
    held = [sum(len(t) for _, t in part) for part in parts]
    assert parts.n >= 10 and max(held) <= bound and sum(held) == sum(len(t) for _, t in set(items))
    texts = [(k, f"clean {k} " * 30 + items[k][1] + " and " + items[(k + 7) % 60][1] + " tail" * 20) for k in range(60)]
    texts += [(100, items[3][1]), (101, None), (102, "nothing here")]
    # the first item's removal joins the halves of the second
    a, b = items[5][1], items[9][1].split()
    texts.append((103, "x " * 40 + " ".join(b[:6]) + " " + a + " " + " ".join(b[6:])))
    whole, dealt = (sorted(decontamination.decontaminate(docs(*texts), bench, set_bytes=n).collect()) for n in (1 << 20, bound))
    assert whole == dealt and 100 not in [r["doc_id"] for r in dealt]
    got = {r["doc_id"]: r["text"] for r in dealt}
    assert got[103].split() == ["x"] * 40 and got[101] is None and got[102] == "nothing here"
    assert sorted(decontamination.scan(docs(*texts), bench, set_bytes=bound).collect()) == sorted(decontamination.scan(docs(*texts), bench).collect())
