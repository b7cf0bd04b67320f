import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reptally.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids():
    model = Tokenizer.from_file(PATH)
    return lambda t: [*model.encode(t or "", add_special_tokens=False).ids, 1]


def check(got, rows, ids, length):
    """Every id in exactly one piece, pieces gapless in sequences, none above the length."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for i, t in rows:
        own = ids(t)
        want[i, len(own)].append(own)
    assert set(pieces) == set(want)
    for key, own in pieces.items():
        have = Counter((r["start"], r["length"]) for r in own)
        assert sum(n * size for (_, size), n in have.items()) == key[1] * len(want[key])
        sums = {(r["start"], r["length"], r["ids_crc32"]) for r in own}
        for start, size, crc in sums:
            assert crc in {zlib.crc32(np.array(w[start : start + size], "<u4").tobytes()) for w in want[key]}
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    return len(sequences)


def test_edge_rows(docs, edge_rows, ids):
    got = packing.pack(docs(*edge_rows), PATH, length=64).collect()
    check(got, edge_rows, ids, 64)
    assert packing.pack(docs((1, "a")).limit(0), PATH).count() == 0


@pytest.mark.parametrize("most", [1, 4, 64])
def test_little_padding(docs, ids, most):
    rnd = random.Random(most)
    rows = [(k, " ".join(rnd.choice(["tree", "of", "hand", "x1y"]) for _ in range(rnd.randint(0, 400)))) for k in range(300)]
    n = check(packing.pack(docs(*rows).repartition(6), PATH, 256, most).collect(), rows, ids, 256)
    total = sum(len(ids(t)) for _, t in rows)
    assert total / 256 <= n <= 1.06 * total / 256 + 2


def test_windows_are_bounded_and_best_fit():
    w = packing.Windows(100, 2, 0)
    assert not [*w.add(60, ("a", 0))] and not [*w.add(80, ("b", 0))]
    assert not [*w.add(15, ("c", 0))]  # into the fuller window that takes it
    closed = [*w.add(50, ("d", 0))]  # fits nowhere: the fullest is filled and closed
    assert closed == [(1, [("b", 0, 80), ("c", 0, 15), ("d", 0, 5)])] and len(w.open) == 2


def test_words_one_by_one_are_the_whole_text(ids):
    texts = ["It's  a\n\ntest of HELLO's <|endoftext|>x y z   é é ΣΑΣ 12a", "", None, " ́a", "the*** The&&& THE, no.. a<b> x|y İstanbul ŞİŞ Å क़ ﬁn ǆ", "don't can't's 'll b's!"]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.token_bytes(texts, PATH)] == [ids(t)[:-1] for t in texts]
