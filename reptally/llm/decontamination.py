"""Benchmark decontamination: a broadcast set of normalised test n-grams, a scan of each
document's windows, exact verification of hits, and removal of spans or documents.

Defined cases: a null or empty text has no words and stays as it is; a null or empty item has
no window; an item without id marks words but is not counted; items that repeat an id count
once; extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import discard, stored

WINDOW = 10
#: Bytes of benchmark text in one broadcast set; a larger benchmark is dealt to parts, one pass each.
SET_BYTES = 32 << 20

_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_CLEANED = "struct<hit: boolean, keep: boolean, text: string>"
_SPLIT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_SPLIT).split()


class NgramSet:
    """Windows of benchmark items by length, found by rolling hash and verified word by word."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.grams: dict[int, dict[tuple, set]] = {}
        for item, data in items:
            ids = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(data)]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                self.grams.setdefault(n, {}).setdefault(tuple(ids[i : i + n]), set()).add(item)
        self.filters = {}
        for n, grams in self.grams.items():
            marks = np.zeros(1 << 20, bool)
            marks[self._hash(np.array(list(grams), np.uint64).reshape(-1, n).T) >> np.uint64(44)] = True
            self.filters[n] = marks

    @staticmethod
    def _hash(columns) -> np.ndarray:
        total = None
        for c in columns:
            total = c.copy() if total is None else total * _MULTIPLIER + c
        return total * _MULTIPLIER

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie in an occurrence of a window, and the items of those windows."""
        hit, found = np.zeros(len(words), bool), set()
        ids = np.array(list(map(self.ids.get, words, [0] * len(words))), np.uint64)
        for n, grams in self.grams.items():
            if len(ids) < n:
                continue
            hashes = self._hash([ids[k : len(ids) - n + 1 + k] for k in range(n)])
            for i in np.flatnonzero(self.filters[n][hashes >> np.uint64(44)]):
                items = grams.get(tuple(ids[i : i + n].tolist()))
                if items is not None:
                    hit[i : i + n] = True
                    found |= items
        return hit, found

    def clean(self, data: bytes) -> bytes:
        """The text without its hit words; looks again, as what is left moves together."""
        while True:
            hit, _ = self.scan(words_of(data))
            if not hit.any():
                return data
            data = _cut(data, hit)


def _items(rows: list) -> list[tuple[str | None, bytes]]:
    return [(r["i"], r["t"].encode()) for r in rows]


class Parts:
    """The benchmark dealt to parts of at most ``set_bytes`` by a hash of its distinct items.

    One part at a time is read and broadcast. A part above the bound is one single item.
    """

    def __init__(self, benchmark: DataFrame, set_bytes: int):
        items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).filter("t <> ''")
        total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        self.n, self.items = 1, items
        if total <= set_bytes:
            return
        items = stored(items.distinct(), "benchmark")
        self.n = -(-2 * total // set_bytes)
        while True:  # hashes don't deal evenly: finer, until the bound holds
            self.items = items.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(self.n)).cast("int"))
            sizes = self.items.groupBy("part").agg(F.sum(F.octet_length("t")).alias("bytes"), F.count(F.lit(1)).alias("n"))
            if sizes.filter((F.col("bytes") > set_bytes) & (F.col("n") > 1)).isEmpty():
                break
            self.n *= 2

    def __iter__(self) -> Iterator[list[tuple[str | None, bytes]]]:
        for k in range(self.n):
            yield _items((self.items.filter(F.col("part") == k) if self.n > 1 else self.items).collect())


def _ranges(hit: np.ndarray) -> list[dict[str, int]]:
    """(first word, end) of the runs of hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    return [{"a": int(a), "b": int(b)} for a, b in edges.reshape(-1, 2)]


def _finder(shared, window: int):
    """Column function from texts to the hit words and the items of one broadcast part."""

    @F.pandas_udf("struct<spans: array<struct<a: int, b: int>>, items: array<string>>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams = NgramSet(shared.value, window)
        for batch in batches:
            out = [grams.scan(words_of(t.encode()) if t else []) for t in batch]
            yield pd.DataFrame({"spans": [_ranges(h) for h, _ in out], "items": [[i for i in s if i is not None] for _, s in out]})

    return look


def _hits(texts: DataFrame, parts: Parts, window: int) -> DataFrame:
    """(rid, spans, items) for the rows of ``texts`` (rid, text) that have hits in any part: one pass
    per part, hits united by row."""
    spark, found = texts.sparkSession, []
    for items in parts:
        if not items:
            continue
        shared = spark.sparkContext.broadcast(items)
        seen = texts.select("rid", _finder(shared, window)("text").alias("r")).select("rid", "r.*").filter(F.size("spans") > 0)
        found.append(stored(seen, "part-hits"))
        shared.destroy()
    if not found:
        return texts.select("rid", F.lit(None).cast("array<struct<a: int, b: int>>").alias("spans"), F.lit(None).cast("array<string>").alias("items")).limit(0)
    # a row has at most one entry per part
    united = reduce(DataFrame.unionByName, found).groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    united = stored(united, "hits")
    discard(*found)
    return united


def _marks(n: int, spans) -> np.ndarray:
    hit = np.zeros(n, bool)
    for s in spans if spans is not None else []:
        hit[s["a"] : s["b"]] = True
    return hit


def _cut(data: bytes, hit: np.ndarray) -> bytes:
    """``data`` without its hit words and what separates neighbours of them."""
    spans, kept, at = [m.span() for m in _WORD.finditer(data)], [], 0
    for r in _ranges(hit):
        kept.append(data[at : spans[r["a"]][0]])
        at = spans[r["b"] - 1][1]
    return b"".join(kept) + data[at:]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_bytes: int = SET_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    parts = Parts(benchmark, set_bytes)

    def described(words: list[int], hits: list[np.ndarray], named: list[list[str]]) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "n_words": words,
                "n_hit": [int(h.sum()) for h in hits],
                "n_items": [len(n) for n in named],
                "items_sha256": [hashlib.sha256(",".join(n).encode()).hexdigest() for n in named],
                "contaminated": [bool(h.any()) for h in hits],
            }
        )

    if parts.n == 1:
        shared = docs.sparkSession.sparkContext.broadcast(next(iter(parts)))

        @F.pandas_udf(_RESULT)
        def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            grams = NgramSet(shared.value, window)
            for batch in batches:
                words = [words_of(t.encode()) if t else [] for t in batch]
                found = [grams.scan(w) for w in words]
                yield described([len(w) for w in words], [h for h, _ in found], [sorted(i for i in s if i is not None) for _, s in found])

        return docs.select("doc_id", look("text").alias("r")).select("doc_id", "r.*")

    rows = stored(docs.select("doc_id", "text").withColumn("rid", F.monotonically_increasing_id()), "scanned")

    @F.pandas_udf(_RESULT)
    def summed(texts: pd.Series, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
        n = [len(words_of(t.encode())) if t else 0 for t in texts]
        return described(n, [_marks(k, s) for k, s in zip(n, spans, strict=True)], [sorted(i) if i is not None else [] for i in items])

    joined = attach(rows, _hits(rows.select("rid", "text"), parts, window), ["rid"], "left")
    return joined.select("doc_id", summed("text", "spans", "items").alias("r")).select("doc_id", "r.*")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, drop_share: float = 0.5, set_bytes: int = SET_BYTES
) -> DataFrame:
    """``docs`` without the words that lie in benchmark windows; a document of which at least
    ``drop_share`` is hit goes. Clean rows come out byte for byte."""
    parts = Parts(benchmark, set_bytes)
    text = F.when(F.col("out.hit"), F.col("out.text")).otherwise(F.col("row")["text"])
    if parts.n == 1:
        shared = docs.sparkSession.sparkContext.broadcast(next(iter(parts)))

        @F.pandas_udf(_CLEANED)
        def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            grams = NgramSet(shared.value, window)
            for batch in batches:
                out = []
                for t in batch:
                    data = t.encode() if t else b""
                    hit, _ = grams.scan(words_of(data))
                    some = bool(hit.any())
                    out.append((some, not some or hit.mean() < drop_share, grams.clean(data).decode() if some else None))
                yield pd.DataFrame(out, columns=["hit", "keep", "text"])

        inner = docs.select(F.struct("*").alias("row"), cleaned("text").alias("out")).filter("out.keep")
        return inner.select(*[(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])

    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid")), "decontaminated")

    @F.pandas_udf(_CLEANED)
    def without(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(texts, spans, strict=True):
            hit = _marks(len(words_of(t.encode())), s)
            out.append((True, hit.mean() < drop_share, _cut(t.encode(), hit).decode()))
        return pd.DataFrame(out, columns=["hit", "keep", "text"])

    def less(texts: DataFrame) -> DataFrame:
        found = _hits(texts, parts, window).select("rid", "spans")
        both = attach(texts, found, ["rid"], "inner").withColumn("out", without("text", "spans"))
        return stored(both.select("rid", "out.*"), "changed")

    # rows that lost words are looked at again, in all parts, until none loses any
    first = less(rows.select("rid", F.col("row")["text"].alias("text")))
    rounds, left = [], first.filter("keep")
    while not left.isEmpty():
        left = less(left.select("rid", "text"))
        rounds.append(left.select("rid", "text", F.lit(len(rounds) + 1).alias("round")))
    final = reduce(DataFrame.unionByName, rounds, first.filter("keep").select("rid", "text", F.lit(0).alias("round")))
    final = final.groupBy("rid").agg(F.max_by("text", "round").alias("text"))
    out = stored(first.select("rid", "hit", "keep").join(final, "rid", "left").select("rid", F.struct("hit", "keep", "text").alias("out")), "cleaned")
    inner = attach(rows, out, ["rid"], "left").filter(F.coalesce("out.keep", F.lit(True)))
    return inner.select(*[(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
