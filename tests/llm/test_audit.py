import random
from collections import Counter
from itertools import permutations

import pytest

from reptally.llm import audit

BLANKS = " \t\n\x0b\x0c\r"


def fails(i, text, rows):
    t = text or ""
    for b in BLANKS[1:]:
        t = t.replace(b, " ")
    words = [w for w in t.split(" ") if w]
    t = text or ""
    return {
        f
        for f, bad in {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        }.items()
        if bad
    }


def brute(rows, labels):
    marks = [(s or "", fails(i, t, rows), any(i is not None and j == i and q == 1 for j, q, _ in labels), any(i is not None and j == i and x == 1 for j, _, x in labels)) for i, t, s in rows]
    out, shapley = {}, Counter()
    for part in {m[0] for m in marks}:
        own = [m for m in marks if m[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                late = sum(f in m[1] and bool(m[1] & set(order[: k - 1])) for m in own)
                out[part, "".join(order), k] = (len(left), len(gone), late, sum(m[1] == {f} for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone))
                shapley[part, f] += len(gone)
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def result(spark, rows, labels, **options):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, source string, part string, mask int, n long")
    ruled = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = audit.audit(docs, ruled, **options).collect()
    table = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in got}
    assert len(table) == len(got)
    return table


@pytest.mark.parametrize("seed", [0, 1])
def test_every_order_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(90)] + ["ABC", "R&D", "Ünï", "x\x0by"]
    texts = [rnd.choice(BLANKS).join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 49, 50, 80, 200]))) for _ in range(25)]
    texts += [" ".join(words[:60]), " ".join(words[:60]) + " #"] * 3 + [None, ""]
    rows = [(k, rnd.choice(texts), rnd.choice(["hot", "hot", "a", None, ""])) for k in range(80)] + [(None, texts[0], "a"), (3, texts[1], "a"), (3, texts[1], "a")]
    labels = [(rnd.randrange(90), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(60)] + [(None, 1, 1)]
    assert result(spark, rows, labels) == brute(rows, labels)


def test_limits_are_met_exactly(spark):
    word = lambda k: f"w{k}"
    fifty = " ".join(map(word, range(50)))
    repeats = " ".join([word(k % 65) for k in range(100)])  # exactly 65 % distinct
    upper = "A" * 5 + "b" * 95
    rows = [(1, fifty, "s"), (2, repeats, "s"), (3, upper, "s"), (4, "A" * 6 + "b" * 94, "s")]
    got = result(spark, rows, [])
    assert got == brute(rows, []) and got["s", "BCADE", 1][1] == 0 and got["s", "CABDE", 1][1] == 1


def test_hot_group_of_copies_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(k, "same text" if k % 3 else f"text {k}", "hot" if k % 2 else "b") for k in range(60)]
        labels = [(k, k % 2, k % 3 == 0) for k in range(0, 60, 4)]
        labels = [(i, q, int(t)) for i, q, t in labels]
        assert result(spark, rows, labels) == brute(rows, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_very_long_text_and_empty_tables(spark):
    rows = [(1, " ".join(f"w{k}" for k in range(300_000)), "s"), (2, "B " * 200_000, "s")]
    assert result(spark, rows, []) == brute(rows, [])
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_the_row_limit_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    result(spark, [(1, "a", "s")], [])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
