"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of 0 to ``ORDER`` bytes with the counts of the bytes
that followed. A text costs each language the exact length of its code: a byte is coded in the
longest known context; where that context has not seen the byte, an escape (as probable as the
number of different bytes it has seen: method C) leads to the next shorter one, in which all bytes
of the longer one are excluded; below order 0 all bytes that are left are even. Statistics are
frozen after training, so that texts are scored apart from each other. The cost of the language
itself, by its share of the training documents, is added; the cheapest language is predicted, and
the score is its share of the probability of the text under all languages.

The trees are fitted on a bounded sample: of each language about ``ROWS`` documents, taken by hash
of id and text, and of these passages of ``PASSAGE`` bytes, taken by hash of id and place, about
``MODEL_BYTES`` over all languages together. That bounds the trees, which Spark counts (map side
combined) and every worker holds: 5 numbers a byte of the sample at most. Shares of the languages
count all training documents, and all texts are scored, whole.

Defined cases: a text without a letter, null or empty, and every text where no language was
learned, is ``und`` with score 0; texts with a null lang aren't learned from; a null id trains, as
its remainder isn't that of held-out rows; repeated rows count and are predicted each; equal costs
go to the smaller name; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reptally.llm.common import stored

ORDER = 4
ROWS = 4096
PASSAGE = 1024
MODEL_BYTES = 4 << 20
UNKNOWN = "und"
#: Bytes that one array operation works on.
_CHUNK = 4 << 20
#: No byte of UTF-8: before the first byte of a text and after its last.
_EDGE = 255


def framed(text: Column, order: int) -> Column:
    """The bytes of a text with ``order`` edges before and one after."""
    edge = lambda n: F.unhex(F.lit(f"{_EDGE:02X}" * n))
    return F.concat(edge(order), text.cast("binary"), edge(1)) if order else F.concat(text.cast("binary"), edge(1))


def places(data: np.ndarray, order: int) -> np.ndarray:
    """For every place from ``order`` on, its byte and the ``order`` bytes before it as one number."""
    out = np.zeros(len(data) - order, np.int64)
    for k in range(order + 1):
        out |= data[order - k : len(data) - k].astype(np.int64) << (8 * k)
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.intp), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Tree:
    """Frozen statistics of one language: per order the grams (context and byte) with counts, and
    the contexts with their totals, numbers of different bytes, and what of the totals of the
    next shorter context their bytes hold there."""

    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    kinds: list[np.ndarray]
    excluded: list[np.ndarray]

    @classmethod
    def of(cls, grams: np.ndarray, n: np.ndarray, order: int) -> Tree:
        tree = cls([], [], [], [], [], [])
        for d in range(order + 1):
            keys, where = np.unique(grams & ((1 << (8 * d + 8)) - 1), return_inverse=True)
            counts = np.bincount(where, n, len(keys))
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            tree.grams.append(keys)
            tree.counts.append(counts)
            tree.contexts.append(contexts)
            tree.totals.append(np.bincount(of, counts, len(contexts)))
            tree.kinds.append(np.bincount(of, minlength=len(contexts)).astype(float))
            shorter = tree.counts[d - 1][np.searchsorted(tree.grams[d - 1], keys & ((1 << (8 * d)) - 1))] if d else counts * 0
            tree.excluded.append(np.bincount(of, shorter, len(contexts)))
        return tree

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of each gram's byte after its context."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        gone, gone_kinds = np.zeros(len(grams)), np.zeros(len(grams))
        for d in range(len(self.grams) - 1, -1, -1):
            own = grams[left] & ((1 << (8 * d + 8)) - 1)
            at, known = _find(self.contexts[d], own >> 8)
            gram, seen = _find(self.grams[d], own)
            total = np.where(known, self.totals[d][at] - gone, 0.0)
            escape = np.where(known, self.kinds[d][at] - gone_kinds, 0.0)
            # a context all of whose bytes are excluded passes on at no cost
            choice = np.where(seen, self.counts[d][gram], escape)
            costs = known & (total + escape > 0)
            out[left[costs]] += np.log2((total + escape)[costs] / choice[costs])
            stay = ~seen
            gone, gone_kinds = np.where(known, self.excluded[d][at], gone)[stay], np.where(known, self.kinds[d][at], gone_kinds)[stay]
            left = left[stay]
        out[left] += np.log2(256 - len(self.grams[0]))
        return out


def _sampled(docs: DataFrame, order: int, rows: int, model_bytes: int) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(lang, gram, n) of the sample, and the languages with their training documents."""
    training = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.col("held_out"))
    learned = [(r["lang"], r["n"]) for r in training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()]  # one row a language
    unit = 1 << 20
    row_share = {lang: min(unit, -(-rows * unit // n)) for lang, n in learned}
    limit = _by_lang(row_share, unit)
    taken = training.filter(F.pmod(F.xxhash64("id", "text", F.lit(17)), F.lit(unit)) < limit).select("lang", F.xxhash64("id", "text").alias("seed"), "text")
    taken = stored(taken, "language-sample")
    sizes = {r["lang"]: r["size"] for r in taken.groupBy("lang").agg(F.sum(F.octet_length("text") + 1).alias("size")).collect()}
    each = model_bytes // max(1, len(sizes))
    share = {lang: min(1.0, each / size) for lang, size in sizes.items()}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                found = []
                for data, seed in zip(part["data"], part["seed"], strict=True):
                    grams = places(np.frombuffer(data, np.uint8), order)
                    starts = np.arange(0, len(grams), PASSAGE, dtype=np.uint64)
                    mixed = (starts + np.uint64(seed % (1 << 64))) * np.uint64(0x9E3779B97F4A7C15)
                    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                    keep = (mixed >> np.uint64(11)).astype(float) / (1 << 53) < share[lang]
                    found += [grams[s : s + PASSAGE] for s in starts[keep].astype(int)]
                if found:
                    keys, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": keys, "n": n})

    counted = taken.select("lang", "seed", framed(F.col("text"), order).alias("data")).mapInPandas(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), learned


def _by_lang(values: dict[str, int], default: int) -> Column:
    """A number per language; languages are few, as each is a class of the classifier."""
    pairs = [x for lang, v in values.items() for x in (F.lit(lang), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("lang")), F.lit(default)) if pairs else F.lit(default)


def _array_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and where each value begins, with the end."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8), offsets - offsets[0]


def costs(data: np.ndarray, offsets: np.ndarray, trees: list[Tree], order: int, chunk: int = _CHUNK) -> np.ndarray:
    """Code length of every framed text under every tree."""
    out = np.zeros((len(offsets) - 1, len(trees)))
    row_of_end = offsets[1:]
    for begin in range(0, max(0, len(data) - order), chunk):
        end = min(begin + chunk, len(data) - order)
        where, keys = pd.factorize(places(data[begin : end + order], order))
        sorted_ = np.argsort(keys)
        # a place belongs to the row of its byte; those of the edges before a text cost nothing
        first, last = np.searchsorted(row_of_end, [begin + order, end + order - 1], side="right")
        starts = np.maximum(offsets[first : last + 1] - order - begin, 0)
        edge = (offsets[first : last + 1, None] + np.arange(order)[None, :]).ravel() - order - begin
        edge = edge[(edge >= 0) & (edge < end - begin)]
        for k, tree in enumerate(trees):
            each = np.empty(len(keys))
            each[sorted_] = tree.bits(keys[sorted_])
            bits = each[where]
            bits[edge] = 0
            out[first : last + 1, k] += np.add.reduceat(bits, starts)
    return out


def predict(docs: DataFrame, order: int = ORDER, rows: int = ROWS, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) for every document."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    plain = docs.select("doc_id", F.col("doc_id").cast("string").alias("id"), held.alias("held_out"), "lang", "text")
    counted, learned = _sampled(plain, order, rows, model_bytes)
    # the sample's grams: at most one a sampled byte, so about model_bytes rows of 16 bytes
    model: dict[str, list[np.ndarray]] = {}
    for lang, part in counted.toPandas().groupby("lang"):
        model[lang] = [part["gram"].to_numpy(np.int64), part["n"].to_numpy(float)]
    names = [lang for lang, _ in learned if lang in model]
    total = sum(n for lang, n in learned if lang in model)
    prior = np.array([-np.log2(n / total) for lang, n in learned if lang in model])
    shared = docs.sparkSession.sparkContext.broadcast([model[x] for x in names])
    out = "held_out boolean, lang_pred string, score double, bits_per_byte double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree.of(grams, n, order) for grams, n in shared.value]
        for batch in batches:
            data, offsets = _array_of(batch["data"])
            letters = batch["letters"].to_numpy(zero_copy_only=False).astype(bool)
            if trees:
                spent = costs(data, offsets, trees, order) + prior
                best = spent.argmin(1)
                least = spent.min(1)
                sure = 1 / np.exp2(np.maximum(least[:, None] - spent, -1000)).sum(1)
            else:
                letters, best, least, sure = letters & False, np.zeros(len(letters), int), np.zeros(len(letters)), np.zeros(len(letters))
            names_of = np.array([*names, UNKNOWN], object)[np.where(letters, best, len(names))]
            rate = np.where(letters, least / np.maximum(np.diff(offsets) - order, 1), 0.0)
            columns = [batch["doc_id"], batch["held_out"], pa.array(names_of, pa.string()), pa.array(np.where(letters, sure, 0.0)), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    # texts without a letter needn't travel
    has = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    sent = plain.select("doc_id", "held_out", has.alias("letters"), framed(F.when(has, F.col("text")).otherwise(""), order).alias("data"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return sent.mapInArrow(score, f"doc_id {kind}, {out}")
