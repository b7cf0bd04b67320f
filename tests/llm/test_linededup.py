import random

from reptally.llm import linededup

RND = random.Random(5)
WORDS = ["w%03d" % k for k in range(500)]


def line(n=20):
    return " ".join(RND.choice(WORDS) for _ in range(n))


def run(docs, rows, **options):
    got = linededup.dedup_lines(docs(*rows), **options).collect()
    return {(r["doc_id"]): r["text"] for r in got}, got


def test_block_goes_from_the_later_document(docs):
    block = "\n".join([line(), "", line(), line()])
    a, b = f"{line()}\n{block}\n{line()}", f"{line()}\n{line()}\n{block}\n{line(5)}"
    got, _ = run(docs, [(2, b), (1, a)])
    assert got[1] == a
    assert got[2] == "\n".join(b.split("\n")[:2] + b.split("\n")[-1:])


def test_short_blocks_stay(docs):
    shared = line(20)
    rows = [(k, f"{line()}\n{shared}\n{line()}") for k in range(6)]
    got, _ = run(docs, rows)
    assert got == dict(rows)
    got, _ = run(docs, rows, min_words=20)
    assert all((shared in got[k]) == (k == 0) for k in got)


def test_block_is_extended_by_lines_that_another_document_had_first(docs):
    common, rest = line(30), [line(15), line(15)]
    rows = [(1, common + "\n" + line()), (2, "\n".join([rest[0], common, rest[1]])), (3, "\n".join([line(), rest[0], common, rest[1], line()]))]
    got, _ = run(docs, rows)
    assert got[2] == rows[1][1]
    assert got[3].split("\n") == [rows[2][1].split("\n")[0], rows[2][1].split("\n")[-1]]


def test_order_matters_for_alignment():
    own = [1, 2, 3, 4]
    hits = [(9, there, True, [], [], here) for there, here in ((10, 0), (3, 1), (4, 2), (5, 3))]
    assert linededup.aligned(own, [10] * 4, hits, 30) == {1, 2, 3}
    assert linededup.aligned(own, [10] * 4, hits, 31) == set()
    assert linededup.aligned(own, [30] * 4, hits, 30) == {0, 1, 2, 3}  # a block that moved


def test_hot_passage(docs):
    passage = line(60)
    rows = [(k, f"{line()}\n{passage}\n{line()}") for k in range(120)]
    got, _ = run(docs, rows)
    assert sum(passage in t for t in got.values()) == 1 and passage in got[0]
    assert all(got[k].replace("\n", " ") == rows[k][1].replace("\n" + passage, "").replace("\n", " ") for k in range(1, 120))


def test_edge_rows(docs, edge_rows):
    _, got = run(docs, edge_rows)
    assert len(got) == len(edge_rows)
    text = {}
    for r in got:
        text.setdefault(r["doc_id"], []).append(r["text"])
    assert text[1] == [None] and text[2] == [""] and text[3] == ["  \n\t "]
    assert len(text[4]) == 1 and text[4][0] != "" and text[5] == ["", ""] and sorted(text[None], key=str) == ["", None]
    assert set(got[0].asDict()) >= {"row", "size", "gone"}
    assert linededup.dedup_lines(docs((1, "a")).limit(0)).count() == 0


def test_against_brute_force(docs):
    """Every line of 50 words stays in the first document that has it, and nothing else goes."""
    pool = [line(50 + k % 7) for k in range(40)]
    rows = [(k, "\n".join(RND.choice(pool) if RND.random() < 0.4 else line(12) for _ in range(6))) for k in range(60)]
    got, _ = run(docs, rows)
    seen = set()
    for k, t in rows:
        own = t.split("\n")
        for x in own:
            if x in pool and x not in seen:
                assert x in got[k].split("\n")
        gone = [x for x in own if x not in got[k].split("\n")]
        assert all(x in seen for x in gone if x in pool)
        assert not [x for x in set(got[k].split("\n")) if x in pool and x in seen]
        seen |= set(own)


def test_moved_and_reversed_lines_take_linear_time():
    """50,000 lines in reverse order of an earlier document, and runs set against other places."""
    n = 50_000
    own = list(range(n))
    hits = [(9, n - 1 - i, True, [], [], i) for i in range(n)]
    assert linededup.aligned(own, [10] * n, hits, 11) == set()
    assert linededup.aligned(own, [10] * n, hits, 11, [(9, 7, 100, 3), (8, 0, 200, 2)]) == {100, 101, 102, 200, 201}
    assert linededup.kept_ranges([1, 2, 4], [0, 2, 5, 6, 8, 9]) == [{"a": 0, "n": 2}, {"a": 6, "n": 2}, {"a": 9, "n": linededup._REST}]


def test_document_of_many_lines(docs):
    """A text of 50,000 lines that a second document repeats but for its ends and one line in between."""
    own = [f"{k} one two three four" for k in range(50_000)]
    copy = ["first line of its own", *own[:20_000], "", "a line between", *own[20_000:], "last line of its own"]
    got, _ = run(docs, [(1, "\n".join(own)), (2, "\n".join(copy)), (3, "\n".join(own[30_000:30_009]))])
    assert got[1] == "\n".join(own)
    assert got[2] == "first line of its own\n\na line between\nlast line of its own"
    assert got[3].split("\n") == own[30_000:30_009]  # 45 words


def test_passage_whose_lines_all_came_first_elsewhere(docs):
    own = [line(6) for _ in range(10)]
    rows = [(1, "\n".join(own[:5])), (2, "\n".join(own[5:]))] + [(k, "\n".join([line(), *own, line()])) for k in (3, 4, 5)]
    many = [line(7) for _ in range(20)]
    rows += [(10 + k, f"{line()}\n{x}\n{line()}") for k, x in enumerate(many)]
    rows += [(40 + k, "\n".join([line(), *many, line()])) for k in range(5)]
    got, _ = run(docs, rows)
    for k, t in rows:
        lines = t.split("\n")
        assert got[k].split("\n") == ([lines[0], lines[-1]] if k in (4, 5) or k > 40 else lines)


def test_all_shared_runs_of_lines_go(docs, no_broadcast):
    """What goes are the lines of all runs of 50 words that an earlier document has."""
    pool = [line(RND.randint(3, 30)) for _ in range(60)]
    rows = []
    for k in range(80):
        own = []
        for _ in range(RND.randint(1, 5)):
            a = RND.randrange(55)
            own += pool[a : a + RND.randint(1, 8)] + ([line(9)] if RND.random() < 0.5 else [])
        rows.append((k, "\n".join(own)))
    got, _ = run(docs, rows)
    seen = set()
    for k, t in rows:
        own = t.split("\n")
        spans = [(a, b) for a in range(len(own)) for b in range(a + 1, len(own) + 1) if sum(len(x.split()) for x in own[a:b]) >= 50]
        gone = {i for a, b in spans if tuple(own[a:b]) in seen for i in range(a, b)}
        assert got[k].split("\n") == [x for i, x in enumerate(own) if i not in gone] or (len(gone) == len(own) and got[k] == "")
        seen |= {tuple(own[a:b]) for a, b in spans}
