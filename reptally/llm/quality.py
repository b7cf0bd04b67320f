"""Quality classifier with hierarchical empirical Bayes.

A linear classifier of words and of the shape of a text gives each document's evidence. Sites
(host, and path within host) get the posterior mean share of good documents: a host's own mean is
shrunk towards the global one, a path's towards its host's, the more, the fewer documents it has;
how strongly is estimated from the spread between hosts and between paths. A document's score
is its own odds with the corpus' prior odds replaced by those of its path. Sites are only grouped
and summed, so that a site may hold any part of all rows.

A document counts as good if its labels say quality 1 and not toxic. The classifier is fitted on
at most about ``SAMPLE`` labelled documents, taken by hash of the id; everything else counts all
rows.

Defined cases: null and empty texts are scored by their shape alone; a null host or path is a site
of its own; an id with several labels is good if all are; labels with a null quality, and labels of
no document, are ignored; without labels of both kinds every document's evidence is even and all
are kept; extra columns pass through.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import stored

#: Labelled documents that the classifier is fitted on, at most (in expectation).
SAMPLE = 20_000
#: Words that it knows, at most: those that tell most, in so many sampled documents or more.
WORDS, SEEN = 4096, 4
_SHAPES = 10
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANK, _SYMBOL, _UPPER, _DIGIT = 1, 2, 3, 4
_KIND = np.array(
    [
        _BLANK if c in b" \t\n\r\x0b\x0c" else _UPPER if 65 <= c <= 90 else _DIGIT if 48 <= c <= 57 else _SYMBOL if 33 <= c <= 126 and not 97 <= c <= 122 else 0
        for c in range(256)
    ],
    np.uint8,
)
_LIMIT = 30.0


def features(text: str | None) -> tuple[set[str], list[float]]:
    """The different words (lower case, without marks around them), and the shape of a text."""
    text = text or ""
    words = text.lower().split()
    counts = Counter(words)
    kinds = _KIND[np.frombuffer(text.encode(), np.uint8)]
    many = np.bincount(kinds, minlength=5)
    ends = np.count_nonzero((kinds[:-1] == _SYMBOL) & (kinds[1:] == _BLANK))
    n, size = max(1, len(words)), max(1, len(kinds))
    shape = [
        np.log1p(len(words)),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        np.log((size - many[_BLANK] + 1) / n),
        many[_SYMBOL] / size,
        many[_UPPER] / size,
        many[_DIGIT] / size,
        ends / n,
        text.count("\n") / n,
    ]
    return {w.strip(_EDGE) for w in counts} - {""}, [float(x) for x in shape]


@dataclass
class Model:
    """Weights of words and of standardised shapes."""

    words: dict[str, float]
    shapes: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    offset: float

    def logit(self, text: str | None) -> float:
        words, shape = features(text)
        z = np.clip((np.array(shape) - self.centre) / self.scale, -6, 6) @ self.shapes + self.offset
        known = self.words.keys() & words if len(words) > len(self.words) else filter(self.words.__contains__, words)
        return float(np.clip(z + sum(map(self.words.__getitem__, sorted(known))), -_LIMIT, _LIMIT))


def train(found: list[list[int]], n_words: int, shapes: np.ndarray, good: np.ndarray, rounds: int = 600, sparse: float = 1e-4) -> tuple:
    """Logistic regression by full-batch Adam, whose steps are shrunk towards zero so that words
    that tell nothing get no weight: weights of words and shapes, centre, scale, offset."""
    centre, scale = shapes.mean(0), shapes.std(0) + 1e-6
    x = np.clip((shapes - centre) / scale, -6, 6)
    flat = np.concatenate([np.asarray(f, int) for f in found])
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    theta = np.zeros(n_words + _SHAPES + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, s, b = theta[:n_words], theta[n_words:-1], theta[-1]
        z = np.bincount(row, w[flat], len(good)) + x @ s + b
        error = (1 / (1 + np.exp(-np.clip(z, -_LIMIT, _LIMIT))) - good) / len(good)
        grad = np.concatenate([np.bincount(flat, error[row], n_words), x.T @ error, [error.sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        step = 0.05 / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        theta -= step * m / (1 - 0.9**k)
        theta[:n_words] = np.sign(theta[:n_words]) * np.maximum(np.abs(theta[:n_words]) - step[:n_words] * sparse, 0)
    return theta[:n_words], theta[n_words:-1], centre, scale, float(theta[-1])


def _even() -> Model:
    return Model({}, np.zeros(_SHAPES), np.zeros(_SHAPES), np.ones(_SHAPES), 0.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The classifier, fitted in one task on a bounded sample of the labelled documents."""
    bad = (F.col("quality") != 1) | (F.coalesce("toxic", F.lit(0)) != 0)
    ruled = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((1 - F.max(bad.cast("int"))).alias("good"))
    ruled = stored(ruled, "labels")
    share = sample / max(sample, ruled.count())
    # at most `sample` rows of 12 bytes in expectation, whatever the input
    taken = ruled.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))

    @F.pandas_udf("struct<words: array<string>, shape: array<double>>")
    def described(texts: pd.Series) -> pd.DataFrame:
        both = [features(t) for t in texts]
        return pd.DataFrame({"words": [sorted(w) for w, _ in both], "shape": [s for _, s in both]})

    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("doc_id", "good", described("text").alias("x")).select("doc_id", "good", "x.*")
    rows = stored(rows, "sample")
    n, n_good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("good"), F.lit(0))).first()
    if not 0 < n_good < n:
        return _even()
    # how much a word tells: the likelihood ratio of its share in good and bad documents
    a, b = F.col("in_good") + 0.5, F.col("in_bad") + 0.5
    even = (a + b) / (n + 1.0)
    ratio = a * F.log(a / (even * (n_good + 0.5))) + b * F.log(b / (even * (n - n_good + 0.5)))
    counted = rows.select("good", F.explode("words").alias("word")).groupBy("word").agg(F.sum("good").alias("in_good"), F.sum(1 - F.col("good")).alias("in_bad"))
    telling = counted.filter(F.col("in_good") + F.col("in_bad") >= SEEN).orderBy(ratio.desc(), "word").limit(WORDS).select("word")
    vocabulary = [r["word"] for r in telling.collect()]  # at most WORDS
    places = {w: k for k, w in enumerate(vocabulary)}

    @F.pandas_udf("array<int>")
    def known(words: pd.Series) -> pd.Series:
        return words.map(lambda ws: [places[w] for w in ws if w in places])

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", kind="stable")
        w, *rest, offset = train(list(group["found"]), len(places), np.stack(list(group["shape"])), group["good"].to_numpy(float))
        return pd.DataFrame({"w": [w], "rest": [np.concatenate([*rest, [offset]])]})

    sampled = rows.select("doc_id", "good", "shape", known("words").alias("found"))
    (got,) = sampled.groupBy(F.lit(1).alias("all")).applyInPandas(solve, "w array<double>, rest array<double>").collect()
    rest, k = np.array(got["rest"]), _SHAPES
    return Model(dict(zip(vocabulary, got["w"], strict=True)), rest[:k], rest[k : 2 * k], rest[2 * k : 3 * k], float(rest[-1]))


def evidence(docs: DataFrame, model: Model, text: Column) -> Column:
    """Probability that a document is good by its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # at most WORDS weights, whatever the input

    @F.pandas_udf("double")
    def chance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = Model(**shared.value)
        for batch in batches:
            z = np.array([fitted.logit(t) for t in batch])
            yield pd.Series(1 / (1 + np.exp(-z)))

    return chance(text)


def _strength(mean_square: float, mean: float, within: float) -> float:
    """Documents that a prior is worth, from the spread of site means beyond their own noise."""
    between = max(mean_square - mean**2 - within, 1e-9)
    return float(np.clip(mean * (1 - mean) / between - 1, 1.0, 1e6))


def sites(scored: DataFrame) -> DataFrame:
    """(host, path, p_host, p_path, prior) from (host, path, p) of all documents."""
    each = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") ** 2).alias("q")), "sites")
    hosts = each.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))

    def spread(groups: DataFrame) -> tuple[float, float]:
        """Global mean and prior strength: five sums over the groups."""
        n, s, square, noise = groups.agg(
            F.sum("n"), F.sum("s"), F.sum(F.col("s") ** 2 / F.col("n")), F.sum((F.col("q") - F.col("s") ** 2 / F.col("n")) / F.col("n"))
        ).first()
        if not n:
            return 0.5, 1.0
        mean = min(max(s / n, 1e-6), 1 - 1e-6)
        return mean, _strength(square / n, mean, noise / n)

    mean, by_host = spread(hosts)
    _, by_path = spread(each)
    hosts = hosts.select("host", ((F.col("s") + mean * by_host) / (F.col("n") + by_host)).alias("p_host"))
    both = attach(each, stored(hosts, "hosts"), ["host"], "inner")
    p_path = (F.col("s") + F.col("p_host") * by_path) / (F.col("n") + by_path)
    return stored(both.select("host", "path", "p_host", p_path.alias("p_path"), F.lit(mean).alias("prior")), "posteriors")


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return F.log(q / (1 - q))


def _site(c: str) -> Column:
    """Null is a site of its own, apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col("row")[c].cast("string")), F.lit("")) if c else F.lit("")


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE, columns: bool = False) -> DataFrame:
    """Each document with p_document, p_host, p_path, score and keep; with ``columns`` the kept
    documents with their own columns instead."""
    model = fit(docs, labels, sample)
    rows = docs.select(F.struct("*").alias("row")).select("row", _site(host).alias("host"), _site(path).alias("path"))
    # equal rows have equal names, and are judged alike
    named = [F.col("row")["doc_id"], F.col("row")["text"], "host", "path"]
    rows = rows.select("row", "host", "path", F.xxhash64(*named).alias("rk"), F.hash(*named).alias("rk2"))
    scored = stored(rows.select(F.col("row")["doc_id"].alias("doc_id"), "rk", "rk2", "host", "path", evidence(docs, model, F.col("row")["text"]).alias("p")), "scored")
    known = sites(scored.select("host", "path", "p"))
    odds = _logit(F.col("p")) + _logit(F.col("p_path")) - _logit(F.col("prior"))
    rated = attach(scored, known, ["host", "path"], "inner", by=["rk"]).withColumn("score", 1 / (1 + F.exp(-odds)))
    if columns:
        # texts are read once more, without the classifier beside them
        gone = stored(rated.filter("score < 0.5").select("rk", "rk2").distinct(), "rejected")
        left = attach(rows, gone, ["rk", "rk2"], "left_anti", by=["host", "path"], weights=scored.groupBy("rk", "rk2").agg(F.count(F.lit(1)).alias("n_rows")))
        return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
    return rated.select("doc_id", F.col("p").alias("p_document"), "p_host", "p_path", "score", (F.col("score") >= 0.5).alias("keep"))
