"""Filter interaction audit: what each filter removes in every order of the filters.

Documents are counted into cells: per part, which of the filters they fail (a bit each). A
recursive query then extends prefixes of filters by every unused letter, from the empty prefix
on; it carries the bits applied so far, by which it joins the cells, and every level of the
recursion gives out the metrics of its step. Cells are counts (32 a part at most), so that a part
may hold any share of the documents, and the recursion has 326 rows a part at every size.

Filters (a document that meets the condition fails): A under 50 words; B fewer than 65 % of the
words distinct; C more than 5 % of the characters in A-Z; D holds one of # $ % & * |; E identical
to the text of a smaller doc_id, removed or not.

Defined cases: null texts are empty (and so copies of each other and of empty texts); a null
source is the part of the empty string; a row with a null id is no copy and gives none, and has
no label; repeated rows count each, and aren't copies of each other, as no id is smaller; an id
with several labels is good or toxic if any says so, null labels say nothing; no documents, no
rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import stored

FILTERS = "ABCDE"
_BITS = {f: 1 << k for k, f in enumerate(FILTERS)}
_BLANKS = "[\\x20\\x09-\\x0D]+"
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

_WALK = """
WITH RECURSIVE walk(part, prefix, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) AS (
  SELECT part, '', 0, 0, kept, 0L, 0L, 0L, 0L, 0L, 0L FROM {begin}
  UNION ALL
  SELECT w.part, concat(w.prefix, c.letter), w.applied | c.bit, w.step + 1,
         c.kept, c.removed, c.redundant, c.unique_fails, c.good_lost, c.toxic_lost, c.shapley
  FROM walk w JOIN {cells} c ON c.part = w.part AND c.applied = w.applied
)
SELECT * FROM walk WHERE step > 0
"""


def _failures(text: Column) -> Column:
    """Bits of the filters A to D."""
    words = F.array_remove(F.split(text, _BLANKS), "")

    def bits(ws: Column) -> Column:
        n, distinct = F.size(ws), F.size(F.array_distinct(ws))
        tests = {
            "A": n < 50,
            "B": distinct.cast("long") * 100 < n.cast("long") * 65,
            "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 5,
            "D": text.rlike("[#$%&*|]"),
        }
        out = F.lit(0)
        for letter, fails in tests.items():
            out = out + F.when(fails, _BITS[letter]).otherwise(0)
        return out

    # the words are bound to a variable, so that they are split once
    return F.element_at(F.transform(F.array(words), bits), 1)


def cells(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail."""
    text = F.coalesce("text", F.lit(""))
    facts = docs.select(
        F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), _failures(text).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key")
    )
    facts = stored(facts, "facts")
    copies = facts.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1 and least is not null")
    facts = attach(facts, copies, ["key"], by=["id"], counted="n_rows")
    facts = facts.select("id", "part", F.when(F.col("id") > F.col("least"), F.col("mask") + _BITS["E"]).otherwise(F.col("mask")).alias("mask"))
    ruled = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    facts = attach(facts, ruled, ["id"], by=["part", "mask"])
    return facts.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def by_applied(found: DataFrame) -> DataFrame:
    """The cells summed for each set of filters applied before and each filter not in it: 80 rows a part."""
    ways = F.array(*[F.struct(F.lit(a).alias("applied"), F.lit(f).alias("letter"), F.lit(b).alias("bit")) for a in range(1 << len(FILTERS)) for f, b in _BITS.items() if not a & b])
    mask, applied, bit = F.col("mask"), F.col("w.applied"), F.col("w.bit")
    fails, before = mask.bitwiseAND(bit) > 0, mask.bitwiseAND(applied) > 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    orders = 1
    for k in range(2, len(FILTERS) + 1):
        orders *= k
    # of all orders, each filter that a document fails comes first in an equal share
    turns = F.when(fails, F.col("n") * F.lit(orders) / F.bit_count(mask)).otherwise(0).cast("long")
    return (
        found.withColumn("w", F.explode(ways))
        .groupBy("part", "w.applied", "w.letter", "w.bit")
        .agg(
            total(~fails & ~before).alias("kept"),
            total(fails & ~before).alias("removed"),
            total(fails & before).alias("redundant"),
            total(mask == bit).alias("unique_fails"),
            total(fails & ~before, "good").alias("good_lost"),
            total(fails & ~before, "toxic").alias("toxic_lost"),
            F.sum(turns).alias("shapley"),
        )
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    found = stored(cells(docs, labels, part), "cells")
    begin = found.groupBy("part").agg(F.sum("n").alias("kept"))
    steps = stored(by_applied(found), "cells-by-applied")
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")  # the rows grow with the parts, the levels don't
    try:
        walk = stored(spark.sql(_WALK, begin=stored(begin, "begin"), cells=steps), "walk")
    finally:
        spark.conf.unset(_ROW_LIMIT) if before is None else spark.conf.set(_ROW_LIMIT, before)
    orders = ["".join(p) for p in permutations(FILTERS)]
    ways = spark.sql("SELECT col1 AS prefix, col2 AS filter_order FROM VALUES " + ", ".join(f"('{o[:k]}', '{o}')" for o in orders for k in range(1, len(o) + 1)))
    metrics = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    # 600 rows, whatever the input
    return walk.join(F.broadcast(ways), "prefix").select("part", "filter_order", F.col("step").cast("int").alias("step"), *metrics)
