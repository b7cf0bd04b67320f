import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from reptally.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, part string, marks int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "p", 2) for r in rows], SCHEMA)


def order(turn):
    number, role, text = turn
    h = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
    return (number is not None, number or 0, h)


def n_words(text):
    for b in "\t\n\x0b\x0c\r":
        text = text.replace(b, " ")
    return len([w for w in text.split(" ") if w])


def brute(rows):
    own = defaultdict(list)
    for c, *turn in rows:
        if c is not None:
            own[c].append(tuple(turn))
    own = {c: [(r or "", t or "") for _, r, t in sorted(ts, key=order)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (n_words(p[-1][1]) if p else 0)
    return sorted(
        (
            min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(kids[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(ms) if len(whole[c]) == len(p)).encode()).hexdigest(),
        )
        for p, ms in members.items()
    )


def result(spark, rows, **options):
    return sorted(tuple(r) for r in trie.prefix_trie(frame(spark, rows), **options).collect())


def made(seed, convs, depth, kinds):
    rnd = random.Random(seed)
    out = []
    for c in range(convs):
        c = c * rnd.choice([1, 1, 3])
        for t in range(rnd.randint(0, depth)):
            out.append((c, t, rnd.choice(["user", "user", None]), rnd.choice(["a b", "c", "", None, "d  e\tf"][:kinds])))
    return out


@pytest.mark.parametrize(("seed", "parts", "fan"), [(0, 1, 2), (1, 3, 2), (2, 7, 2), (3, 8, 3), (4, 20, 2)])
def test_against_brute_force(spark, seed, parts, fan):
    rows = made(seed, 60, 6, 1 + seed % 4)
    assert result(spark, rows, parts=parts, fan=fan) == brute(rows)


@pytest.mark.parametrize("parts", [1, 6])
def test_copies_over_many_partitions(spark, parts):
    rows = [(c, t, "user", f"turn {t}") for c in range(20, 100) for t in range(5)]
    rows += [(200 + c, t, "user", f"turn {t}" if t < c % 5 else f"own {c}") for c in range(40) for t in range(6)]
    assert result(spark, rows, parts=parts, fan=2) == brute(rows)


def test_ids_of_copies_in_several_pieces(spark):
    rows = [(c, 0, "user", "same") for c in range(3000)]
    assert result(spark, rows, parts=4, fan=2) == brute(rows)


def test_long_and_odd_conversations(spark):
    rows = [(7, t, "user", f"turn {t}") for t in range(900)] + [(8, t, "user", f"turn {t}") for t in range(800)]
    rows += [(9, None, None, None), (9, 2, "a", "x y"), (9, 2, "a", "x y"), (9, 2, "b", "z"), (None, 1, "a", "b"), (-5, 0, "a", "b"), (-20, 0, "q", "r"), (13, 0, "a", "b" * 1_000_000), (45, 0, "u", "v")]
    assert result(spark, rows, parts=3, fan=2) == brute(rows)
    assert result(spark, []) == []


def test_role_and_text_are_kept_apart(spark):
    rows = [(100, 0, "ab", "c"), (200, 0, "a", "bc"), (300, 0, "", "abc")]
    assert result(spark, rows, parts=2) == brute(rows)
