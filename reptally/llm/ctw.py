"""Language-model scoring by context-tree weighting.

Each byte is predicted bit by bit; a bit's context is the bits of its byte so far and up to
``DEPTH`` bytes before it. Every context has a Krichevsky-Trofimov estimate from the counts of all
training texts, and the weighting mixes the estimates of all depths: a context's weight is its
own probability of the training bits against that of the longer contexts below it. A text's score
is the probability of its bytes and an end mark; contexts before its first byte are end marks.

Texts are dealt to blocks of about equal bytes by hash. A block gives each different byte string
of a context and its byte (and each different word) once, with counts; these are summed over the
corpus, the tree is weighted level by level, and each block gets back the values of its own
strings only. So no task and no broadcast holds the model, which grows with the corpus.

Defined cases: null and empty texts are the end mark alone; a null id trains, as its remainder
isn't that of held-out rows; repeated rows count and are scored each; without training texts all
estimates are one half and the base of a token is 1; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reptally.llm.common import stored

DEPTH = 4
BLOCK_BYTES = 16 << 20
#: Bytes that one array operation works on.
_CHUNK = 2 << 20
_END = b"\xff"
#: The end token of the words; no word contains a blank.
_END_WORD = " "


def _grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and byte at every place of the texts and their end marks, as one number each, and
    where each text begins."""
    pad = _END * depth
    data = np.frombuffer(pad + (_END + pad).join(texts) + _END, np.uint8).astype(np.int64)
    sizes = np.array([len(t) + 1 for t in texts])
    total = np.zeros(len(data) - depth, np.int64)
    for k in range(depth + 1):
        total |= data[depth - k : len(data) - k] << (8 * k)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.ones(len(total), bool)
    for i in range(depth):  # the pads between texts
        inside[starts[1:-1] + depth * np.arange(len(texts) - 1) + i] = False
    return total[inside], starts


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > _CHUNK:
            yield at, k
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def _symbols(depth: int):
    """Each different gram and word of a block with its training count."""

    def count(block: pd.DataFrame) -> pd.DataFrame:
        words: dict[str, int] = {}
        grams = []
        for held, part in block.groupby("held_out"):
            texts = [t.encode().lower() for t in part["text"]]
            own = 0 if held else 1
            for a, b in _chunks(texts):
                keys, n = np.unique(_grams(texts[a:b], depth)[0], return_counts=True)
                grams.append((keys, n * own))
                if len(grams) > 16:
                    grams = [_summed(grams)]
            for t in texts:
                for w in t.split():
                    words[w] = words.get(w, 0) + own
            words[_END_WORD.encode()] = words.get(_END_WORD.encode(), 0) + own * len(texts)
        keys, n = _summed(grams)
        return pd.DataFrame(
            {
                "block": block["block"].iloc[0],
                "gram": pd.array([*keys, *[None] * len(words)], "Int64") if len(words) == 0 else np.concatenate([keys, np.full(len(words), -1)]),
                "word": [None] * len(keys) + [w.decode() for w in words],
                "n": np.concatenate([n, np.fromiter(words.values(), np.int64, len(words))]),
            }
        )

    return count


def _log_gamma(x: Column) -> Column:
    """For x >= 0.5, by Stirling's series at x + 6; good to 1e-11."""
    z = x + 6
    product = x
    for k in range(1, 6):
        product = product * (x + k)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - F.log(product)


def _log_kt(zeros: Column, ones: Column) -> Column:
    """Log probability of a bit sequence by the Krichevsky-Trofimov estimator."""
    a, b = zeros.cast("double"), ones.cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1)


def weigh(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, value): log10 probability of the gram's byte after its context, for ``grams``
    (gram, n). A node is a context, 8 bits each byte, and the byte's bits so far after a 1."""

    def node(k: int) -> Column:
        byte = F.col("gram").bitwiseAND(255)
        so_far = F.lit(1 << k).cast("long").bitwiseOR(F.shiftright(byte, 8 - k))
        return F.shiftleft(F.shiftright(F.col("gram"), 8), 8).bitwiseOR(so_far)

    def bit(k: int) -> Column:
        return F.shiftright(F.col("gram"), 7 - k).bitwiseAND(1)

    bits = F.array(*[F.struct(node(k).alias("node"), bit(k).alias("bit")) for k in range(8)])
    each = grams.select("gram", "n", F.explode(bits).alias("x")).select("gram", "n", "x.node", "x.bit")
    leaves = each.groupBy("node").agg(F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
    kt = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
    levels = {depth: stored(leaves.select("node", "n0", "n1", _log_kt(F.col("n0"), F.col("n1")).alias("log_w"), F.lit(1.0).alias("stop")), "level")}
    for d in range(depth - 1, -1, -1):
        above = levels[d + 1].groupBy(F.col("node").bitwiseAND((1 << (8 * d + 8)) - 1).alias("node")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_w").alias("below"))
        above = above.withColumn("own", _log_kt(F.col("n0"), F.col("n1")))
        apart = F.col("below") - F.col("own")
        log_w = F.greatest("below", "own") + F.log1p(F.exp(-F.abs(apart))) - math.log(2)
        levels[d] = stored(above.select("node", "n0", "n1", log_w.alias("log_w"), (1 / (1 + F.exp(F.least(apart, F.lit(700.0))))).alias("stop")), "level")
    # from the top: what the depths so far say, and the weight that is left for deeper ones
    so_far = levels[0].select("node", (F.col("stop") * kt).alias("p"), (1 - F.col("stop")).alias("rest"))
    for d in range(1, depth + 1):
        upper = so_far.withColumnsRenamed({"node": "parent"})
        own = levels[d].withColumn("parent", F.col("node").bitwiseAND((1 << (8 * d)) - 1))
        so_far = own.join(upper, "parent").select("node", (F.col("p") + F.col("rest") * F.col("stop") * kt).alias("p"), (F.col("rest") * (1 - F.col("stop"))).alias("rest"))
        so_far = stored(so_far, "mixed")
    chance = each.select("gram", "node", "bit").join(so_far.select("node", "p"), "node")
    return chance.groupBy("gram").agg(F.sum(F.log10(F.when(F.col("bit") == 1, F.col("p")).otherwise(1 - F.col("p")))).alias("value"))


def score(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    # workers lower A-Z in the bytes, where a text is encoded anyway
    plain = docs.select(F.col("doc_id").cast("string").alias("id"), held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = plain.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    symbols = stored(dealt.groupBy("block").applyInPandas(_symbols(depth), "block long, gram long, word string, n long"), "symbols")
    grams = symbols.filter("word is null").groupBy("gram").agg(F.sum("n").alias("n"))
    gram_values = stored(weigh(stored(grams, "grams"), depth), "gram-values")
    words = stored(symbols.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    back = symbols.filter("word is null").join(gram_values, "gram").select("block", "gram", "word", "value", F.lit(False).alias("known"))
    word_value = F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))
    back = back.unionByName(
        symbols.filter("word is not null").drop("n").join(words, "word").select("block", "gram", "word", word_value.alias("value"), (F.col("n") > 0).alias("known"))
    )

    def rate(block: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        own = values[values["word"].isna()].sort_values("gram")
        keys, logs = own["gram"].to_numpy(np.int64), own["value"].to_numpy()
        known_words = values[values["word"].notna()]
        value = dict(zip((w.encode() for w in known_words["word"]), known_words["value"], strict=True))
        unknown = {w.encode() for w in known_words["word"][~known_words["known"].astype(bool)]}
        texts = [t.encode().lower() for t in block["text"]]
        scores = np.zeros(len(texts))
        for a, b in _chunks(texts):
            found, starts = _grams(texts[a:b], depth)
            scores[a:b] = np.add.reduceat(logs[np.searchsorted(keys, found)], starts[:-1])
        end = _END_WORD.encode()
        tokens = [[*t.split(), end] for t in texts]
        base = [math.fsum(map(value.__getitem__, ws)) for ws in tokens]
        size = np.array([len(t) + 1 for t in texts])
        return pd.DataFrame(
            {
                "id": block["id"],
                "held_out": block["held_out"],
                "n_tokens": [len(ws) for ws in tokens],
                "n_known": [len(ws) - sum(map(unknown.__contains__, ws)) for ws in tokens] if unknown else [len(ws) for ws in tokens],
                "base_score": base,
                "score": scores,
                "bits_per_byte": -scores * math.log2(10) / size,
            }
        )

    rated = dealt.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(
        rate, "id string, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"
    )
    kind = docs.schema["doc_id"].dataType
    return rated.select(
        F.col("id").cast(kind).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte"
    )
