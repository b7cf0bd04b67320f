"""Line dedup by pairwise alignment.

Each line that several documents share nominates one pair per later document: that document
and the first one that has the line. So every shared line, however rare or frequent, leads to a
pair, and no line makes more pairs than it has occurrences. A pair is aligned by patience diff:
lines that are unique in both documents and in the same order are anchors, and equal lines
around them extend the blocks; what is left, as blocks that changed places, is aligned after that.
Common blocks of at least ``min_words`` words are deleted from the later document.

The lines of a block may all have come first elsewhere, each in another document. So the shortest
runs of lines that reach ``min_words`` nominate their first document too, with the place there, and
are blocks of that pair. Of a block that two documents share, each line lies in such a run within the
block, from its own start on or up to its end; the first document that has the run is no later than
the earlier of the two. Lines and runs are found by one hash of 64 bits and compared by a second,
independent one before they count as equal. Documents are ordered by id; blank lines are not compared
and go with a block that encloses them.

All that is made, shuffled or looped over is in proportion to the lines of a document.

Defined cases: null and empty texts stay as they are; null ids come last, then by hash of the
text; rows that repeat both id and text are the same document and come out alike; a document
that is all copied becomes empty; extra columns pass through.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import discard, same_row, stored, text_key

MIN_WORDS = 50
#: Lines around an anchor's place in the first document that come along to extend its block.
CONTEXT = 4
#: More lines than any text has.
_REST = 1 << 30


def _increasing(pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The longest run of pairs, sorted by second place, whose first places increase."""
    tails, at, back = [], [], [-1] * len(pairs)
    for k, (first, *_rest) in enumerate(pairs):
        j = bisect.bisect_left(tails, first)
        back[k] = at[j - 1] if j else -1
        if j == len(tails):
            tails.append(first)
            at.append(k)
        else:
            tails[j], at[j] = first, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def aligned(own: list[int], words: list[int], hits: list, min_words: int, runs: list = ()) -> set[int]:
    """Lines of a document that lie in long enough blocks shared with earlier documents.

    ``own`` are its line hashes. ``hits`` are (earlier document, line there, whether it is there
    once, hashes before, hashes after, line here), ``runs`` are (earlier document, line there, line
    here, lines), blocks that are long enough by themselves.
    """
    times: dict[int, int] = {}
    for h in own:
        times[h] = times.get(h, 0) + 1
    by_doc: dict[int, tuple[list, list]] = {}
    for doc, there, once, before, after, here in hits:
        by_doc.setdefault(doc, ([], []))[0].append((there, here, once and times[own[here]] == 1, before, after))
    for doc, there, here, n in runs:
        by_doc.setdefault(doc, ([], []))[1].append((there, here, n))
    gone: set[int] = set()
    for found, whole in by_doc.values():
        found.sort(key=lambda x: (x[1], x[0]))
        around = {(x[0], x[1]): x for x in found}
        shift: dict[int, int] = {}  # line here -> how far its partner lies ahead
        anchors = _increasing([x[:2] for x in found if x[2]] or [x[:2] for x in found])
        # blocks that moved past each other, and lines that come several times, are aligned after that
        for there, here in [*anchors, *(x[:2] for x in found)]:
            if here in shift:
                continue
            *_, before, after = around[there, here]
            shift[here] = there - here
            for step, hashes in ((1, after), (-1, before)):
                at = here + step
                for h in hashes:
                    if not 0 <= at < len(own) or own[at] != h or at in shift:
                        break
                    shift[at] = there - here
                    at += step
        # a run whose lines the alignment has set against other places is a block of its own
        for there, here, n in whole:
            if any(shift.get(i) != there - here for i in range(here, here + n)):
                gone.update(range(here, here + n))
        block: list[int] = []
        for here in [*sorted(shift), None]:
            if block and (here is None or here != block[-1] + 1 or shift[here] != shift[block[-1]]):
                if sum(words[i] for i in block) >= min_words:
                    gone.update(block)
                block = []
            if here is not None:
                block.append(here)
    return gone


def runs_of(hashes: list[int], checks: list[int], words: list[int], min_words: int) -> list[tuple[int, int, int, int]]:
    """(hash, second hash, first line, lines) of the shortest runs of several lines that reach
    ``min_words``, from each line on and up to each line. Single lines nominate by themselves."""
    from xxhash import xxh64_intdigest

    found, end, n = set(), 0, 0
    for start in range(len(words)):
        while end < len(words) and n < min_words:
            n += words[end]
            end += 1
        if n < min_words:
            break
        found.add((start, end))
        n -= words[start]
    start, n = 0, 0
    for end in range(len(words)):
        n += words[end]
        while n - words[start] >= min_words and start < end:
            n -= words[start]
            start += 1
        if n >= min_words:
            found.add((start, end + 1))
    data, other = np.asarray(hashes, "<i8").tobytes(), np.asarray(checks, "<i8").tobytes()
    signed = lambda d, a, b, seed: int(np.uint64(xxh64_intdigest(d[8 * a : 8 * b], seed)).view(np.int64))
    return [(signed(data, a, b, 42), signed(other, a, b, 7), a, b - a) for a, b in sorted(found) if b - a > 1]


def kept_ranges(gone: list[int], at: list[int]) -> list[dict[str, int]]:
    """(first line, lines) of what stays, by lines of the text, of which ``at`` are those that aren't
    blank; blank lines between two deleted neighbours go as well."""
    kept, start = [], 0
    for k, i in enumerate(gone):
        if int(at[i]) > start:
            kept.append({"a": start, "n": int(at[i]) - start})
        start = int(at[i + 1]) if k + 1 < len(gone) and gone[k + 1] == i + 1 else int(at[i]) + 1
    return [*kept, {"a": start, "n": _REST}]


def cuts(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, h, gone): the ranges of lines that stay and how many go, for the documents that lose any."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("at"), F.trim(x).alias("line"))), lambda x: x["line"] != "")
    rows = docs.select(F.col("doc_id").alias("id"), text_key(F.col("text")).alias("h"), F.transform(lines, lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["line"]).alias("hash"), F.xxhash64(F.lit(7), x["line"]).alias("check"), F.regexp_count(x["line"], F.lit(r"\S+")).alias("words"))).alias("l"))
    docs_lines = stored(
        rows.filter(F.size("l") > 0).select("id", "h", *[F.col(f"l.{c}").alias(c) for c in ("at", "hash", "check", "words")]), "lines"
    )
    order = F.struct(F.col("id").isNull().alias("nil"), F.col("id").alias("id"), F.col("h").alias("h"))
    # lines with what lies around them; a document's list stays with the document
    around = F.transform("hash", lambda x, i: F.struct(
        x.alias("line"),
        F.get("check", i).alias("check"),
        F.reverse(F.slice("hash", F.greatest(i - CONTEXT, F.lit(0)) + 1, F.least(i, F.lit(CONTEXT)))).alias("before"),
        F.slice("hash", i + 2, F.lit(CONTEXT)).alias("after"),
    ))
    repeated = docs_lines.select("id", "h", F.explode("hash").alias("line")).groupBy("line").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    repeated = stored(repeated.filter("first <> last").select("line", "first"), "repeated")
    # where the first document has the line, and what lies around it there
    each = docs_lines.select("id", "h", F.posexplode(around).alias("i", "l")).select("id", "h", "i", "l.*")
    shared = stored(attach(each, repeated, ["line"], "inner", by=["id", "h"]).withColumn("is_first", order == F.col("first")), "shared")
    firsts = shared.filter("is_first").groupBy("line", "first").agg(F.min(F.struct("i", "check", "before", "after")).alias("place"), (F.count(F.lit(1)) == 1).alias("once"))
    firsts = stored(firsts, "firsts")
    hits = attach(shared.filter("not is_first").select("id", "h", "line", "check", "i"), firsts, ["line"], "inner", by=["id", "h"]).filter("check = place.check")
    doc = F.xxhash64("first.id", "first.h").alias("doc")
    hit = F.struct(doc, F.col("place.i").alias("there"), "once", F.col("place.before").alias("before"), F.col("place.after").alias("after"), F.col("i").alias("here"))

    @F.pandas_udf("array<struct<run: long, check: long, i: int, n: int>>")
    def runs(hashes: pd.Series, checks: pd.Series, words: pd.Series) -> pd.Series:
        names = ("run", "check", "i", "n")
        return pd.Series([[dict(zip(names, r, strict=True)) for r in runs_of(*own, min_words)] for own in zip(hashes, checks, words, strict=True)])

    each_run = stored(docs_lines.select("id", "h", F.explode(runs("hash", "check", "words")).alias("r")).select("id", "h", "r.*"), "runs")
    firsts_of = each_run.groupBy("run").agg(F.min(F.struct(order.alias("doc"), "i", "check")).alias("place"), F.max(order).alias("last")).filter("place.doc <> last")
    firsts_of = stored(firsts_of.select("run", F.col("place.doc").alias("first"), F.col("place.i").alias("there"), F.col("place.check").alias("first_check")), "repeated-runs")
    later = attach(each_run, firsts_of, ["run"], "inner", by=["id", "h"]).filter((order != F.col("first")) & F.expr("check = first_check"))
    run = F.struct(doc, "there", F.col("i").alias("here"), "n")
    both = hits.select("id", "h", hit.alias("hit"), F.lit(None).cast("struct<doc: long, there: int, here: int, n: int>").alias("run"))
    both = both.unionByName(later.select("id", "h", run.alias("run")), allowMissingColumns=True)
    per_doc = both.groupBy("id", "h").agg(F.collect_set("hit").alias("hits"), F.collect_set("run").alias("runs"))

    @F.pandas_udf("struct<keep: array<struct<a: int, n: int>>, n_gone: int>")
    def align(hashes: pd.Series, words: pd.Series, at: pd.Series, found: pd.Series, known: pd.Series) -> pd.DataFrame:
        out = []
        for own, w, places, rows, whole in zip(hashes, words, at, found, known, strict=True):
            pairs = [(r["doc"], r["there"], r["once"], list(r["before"]), list(r["after"]), r["here"]) for r in rows]
            gone = sorted(aligned(list(own), list(w), pairs, min_words, [(r["doc"], r["there"], r["here"], r["n"]) for r in whole]))
            n = sum(int(places[j] - places[i]) if j == i + 1 else 1 for i, j in zip(gone, [*gone[1:], -1], strict=True)) if gone else 0
            out.append((kept_ranges(gone, places), n))
        return pd.DataFrame(out, columns=["keep", "n_gone"])

    both = per_doc.join(docs_lines.alias("d"), same_row(per_doc, docs_lines, "id", "h")).select(per_doc["id"], per_doc["h"], align("hash", "words", "at", "hits", "runs").alias("gone"))
    found = stored(both.filter("gone.n_gone > 0").dropDuplicates(["id", "h"]), "cuts")
    discard(docs_lines, repeated, shared, firsts, each_run, firsts_of)
    return found


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, report: bool = False) -> DataFrame:
    """``docs`` with common blocks deleted from the later documents; with ``report`` (doc_id,
    text, n_lines_deleted) instead of all columns."""
    gone = cuts(docs, min_words)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("h"))
    # rows of unique keys: a shuffle that grows as the input does, at every size
    joined = rows.join(gone.hint("merge"), same_row(rows, gone, "id", "h"), "left").select(rows["row"], "gone")
    # the text is cut in lines once, outside the function over ranges
    kept = F.transform(F.array(F.split(F.col("row")["text"], "\n")), lambda own: F.flatten(F.transform("gone.keep", lambda r: F.slice(own, r["a"] + 1, r["n"]))))
    left = F.array_join(F.element_at(kept, 1), "\n")
    text = F.when(F.col("gone").isNull(), F.col("row")["text"]).otherwise(left)
    if report:
        return joined.select(F.col("row")["doc_id"].alias("doc_id"), text.alias("text"), F.coalesce("gone.n_gone", F.lit(0)).alias("n_lines_deleted"))
    return joined.select(*[(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
