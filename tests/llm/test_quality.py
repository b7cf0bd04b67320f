import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reptally.llm import quality

RND = random.Random(11)
GOOD = [f"word{k}" for k in range(300)]


def text(kind):
    words = [RND.choice(GOOD) for _ in range(RND.randint(30, 120))]
    if kind == "junk":
        words = [w.upper() + "!!" for w in words]
    if kind == "toxic":
        words[RND.randrange(len(words))] = RND.choice(["slur", "insult"])
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark):
    kinds = ["good"] * 6 + ["junk"] * 2 + ["toxic"] * 2
    rows = [(k, text(kinds[k % 10]), "en", f"host{k % 7}", kinds[k % 10]) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kind string")
    labels = docs.filter("doc_id < 600").select("doc_id", F.expr("int(kind <> 'junk')").alias("quality"), F.expr("int(kind = 'toxic')").alias("toxic"))
    return docs, labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    got = quality.judge(docs, labels).join(docs.select("doc_id", "kind"), "doc_id").filter("doc_id >= 600").collect()
    assert len(got) == 300
    assert sum(r["keep"] == (r["kind"] == "good") for r in got) >= 295


def test_stage_keeps_whole_rows(corpus):
    docs, labels = corpus
    out = quality.judge(docs, labels, columns=True)
    assert out.columns == docs.columns
    kept = {r["doc_id"] for r in quality.judge(docs, labels).filter("keep").collect()}
    assert {r["doc_id"] for r in out.collect()} == kept


def test_real_labels_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    known = labels.filter("doc_id % 3 > 0")
    got = quality.judge(docs, known).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    assert np.mean([r["keep"] == (r["quality"] == 1 and r["toxic"] == 0) for r in got]) > 0.85


def test_posteriors_by_definition(spark):
    scored = spark.createDataFrame([("a", "x", 0.9)] * 50 + [("a", "y", 0.2), ("b", "x", 0.1), ("b", "x", 0.3)], "host string, path string, p double")
    rows = {(r["host"], r["path"]): r for r in quality.sites(scored).collect()}
    mean = (45 + 0.2 + 0.4) / 53
    assert rows["a", "x"]["prior"] == pytest.approx(mean)
    # each level lies between its own mean and that of the level above, a path with one document nearer to its host
    assert mean <= rows["a", "x"]["p_host"] <= 45.2 / 51 and 0.2 <= rows["b", "x"]["p_host"] <= mean
    assert 0.2 < rows["a", "y"]["p_path"] < rows["a", "y"]["p_host"]


def test_edge_rows(docs, edge_rows, spark):
    df = docs(*edge_rows).withColumn("source", F.when(F.col("doc_id") > 25, F.col("source")))
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (20, 0, None), (21, 1, 0), (22, 1, 0), (23, None, 1), (None, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(df, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in got)
    out = quality.judge(df, labels.limit(0), columns=True)
    assert out.columns == df.columns and out.count() == len(edge_rows)  # nothing known: all stay
    assert quality.judge(df.limit(0), labels).count() == 0
