"""Prefix trie of conversations.

Every conversation is rebuilt (:func:`rebuild`) and becomes one row: the hashes of its turns as one
binary key, and the words of each turn. Rows are sorted over range partitions, so that copies of
one conversation, however many, are spread over several. In each partition neighbours with a
common prefix are joined by edges of that length, which are merged by union-find in descending
depth: each merge makes the branching node of its depth, out of the components as children, and
closes these. A node whose depth is not beyond the common prefix with the neighbouring partition
may have members there; it stays open, and only what its partition has closed below it is kept,
as marks on the partition's first and last prefix. These contracted forests, two rows a
partition at most, are merged in the same way, ``FAN`` partitions at a time, level by level,
until nothing is open.

Turns are compared by MD5 of role and text. A conversation is one row of 24 bytes a turn. SHA-256
must read the ids of equal conversations in order; where these are spread over partitions, each
packs its own into pieces of about 8 kB, which one task reads as a stream.

Defined cases: null roles and texts are empty; turns of one number (repeated rows too) are ordered
by their hash; a null turn comes first; rows with a null conv_id belong to no conversation; a
conversation whose own turns are all replaced by those of an absent one has no turn and ends at
the root; the group of a negative conv_id is by SQL's remainder, towards zero; no conversations, no
nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.llm.common import stored

GROUP = 20
HEADS = 4
FAN = 256
PART_BYTES = 16 << 20
_HASH = 16
_PIECE = 1 << 13
_NOTHING = hashlib.sha256(b"").hexdigest()

_MARK = "array<struct<depth: int, n: long, least: long, kids: long, leaves: long, saved: long, sha: string, seq: string>>"
_OUT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, sha string, seq string, "
    f"node string, under string, part long, left boolean, ll int, rl int, key binary, words array<long>, marks {_MARK}, piece long, ids binary"
)
_OUT_NAMES = [c.split()[0] for c in _OUT.replace(_MARK, "x").split(", ")]


def rebuild(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, words): the turns of every conversation, of which the first few are those of
    the first conversation of its group of ``GROUP``."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    turn = F.struct(
        F.col("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("h"),
        F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("long").alias("w"),
    )
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    own = stored(rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["h"].alias("h"), t["w"].alias("w"))).alias("ts")), "turns")
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("first"), F.slice("ts", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    # a first conversation has 20 partners at most
    both = own.withColumn("first", first).join(heads, "first", "left").withColumn("h", h)
    turns = F.concat(F.slice(F.coalesce("head", F.array().cast("array<struct<h:string,w:long>>")), F.lit(1), F.col("h")), F.slice("ts", F.col("h") + 1, F.greatest(F.size("ts"), F.lit(1))))
    made = both.select("conv_id", turns.alias("ts"))
    return made.select("conv_id", F.unhex(F.array_join("ts.h", "")).alias("key"), F.col("ts.w").alias("words"))


def common_turns(a: bytes, b: bytes) -> int:
    """Length of the common prefix in turns, by halving."""
    low, high = 0, min(len(a), len(b)) // _HASH
    while low < high:
        mid = (low + high + 1) // 2
        if a[_HASH * low : _HASH * mid] == b[_HASH * low : _HASH * mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _name(key: bytes, depth: int) -> str:
    return hashlib.md5(key[: _HASH * depth]).hexdigest()


class Forest:
    """Union-find over sorted rows; closed nodes go to ``nodes``, what stays open to ``open``.

    ``keys`` and ``words`` describe the rows, ``marks`` what lies on each row's prefix (depth -> n,
    least, kids, leaves, saved, sha, seq). ``left`` and ``right`` are the rows next to other
    partitions and ``ll`` and ``rl`` the common prefixes with these, -1 without a neighbour.
    """

    def __init__(self, keys: list[bytes], words: list[np.ndarray], marks: list[dict[int, tuple]], left: int, right: int, ll: int, rl: int, named: bool) -> None:
        self.keys, self.words, self.marks, self.named = keys, words, marks, named
        self.up_to = [np.concatenate([[0], np.cumsum(w, dtype=np.int64)]).tolist() for w in words]
        self.ll, self.rl, self.rows = ll, rl, (left, right)
        self.root = list(range(len(keys)))
        self.flags = [(k == left) + 2 * (k == right) for k in range(len(keys))]
        #: top of each component: depth, n, least, kids, leaves, saved, sha, seq; None if open or not begun
        self.top: list[tuple | None] = [None] * len(keys)
        self.nodes: list[tuple] = []
        self.open: dict[tuple[int, int], list] = {}

    def find(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = self.root[self.root[k]]
            k = self.root[k]
        return k

    def run(self) -> None:
        events: dict[int, tuple[list[int], list[int]]] = {}
        for k, own in enumerate(self.marks):
            for d in own:
                events.setdefault(d, ([], []))[0].append(k)
        for row, depth in zip(self.rows, (self.ll, self.rl), strict=True):
            if depth >= 0:
                events.setdefault(depth, ([], []))[0].append(row)
        if self.ll < 0 and self.rl < 0:
            events.setdefault(0, ([], []))[0].append(0)
        for k in range(len(self.keys) - 1):
            events.setdefault(common_turns(self.keys[k], self.keys[k + 1]), ([], []))[1].append(k)
        for depth in sorted(events, reverse=True):
            self.merge(depth, *events[depth])

    def merge(self, depth: int, marked: list[int], edges: list[int]) -> None:
        """Everything that meets at one depth."""
        before = {self.find(k) for k in marked} | {self.find(k) for k in edges} | {self.find(k + 1) for k in edges}
        for k in edges:
            a, b = sorted((self.find(k), self.find(k + 1)))
            self.root[b] = a
            self.flags[a] |= self.flags[b]
        groups: dict[int, tuple[list[int], list[tuple]]] = {}
        for k in sorted(before):
            groups.setdefault(self.find(k), ([], []))[0].append(k)
        for k in dict.fromkeys(marked):
            if depth in self.marks[k]:
                groups[self.find(k)][1].append(self.marks[k][depth])
        for row, (parts, marks) in groups.items():
            self.node(depth, row, [self.top[k] for k in parts if self.top[k] is not None], marks)

    def node(self, depth: int, row: int, below: list[tuple], marks: list[tuple]) -> None:
        flags = self.flags[row]
        is_open = (flags & 1 and depth <= self.ll) or (flags & 2 and depth <= self.rl)
        own = [(c[1], c[2], 1, c[4], self.lifted(c, depth + 1)) for c in below] + [m[:5] for m in marks]
        if not own:  # a neighbour's prefix that only passes
            self.top[row] = None
            return
        n = sum(x[0] for x in own)
        least = min(x[1] for x in own)
        kids, leaves, saved = (sum(x[i] for x in own) for i in (2, 3, 4))
        ends = [m[5:] for m in marks if m[5] or m[6]]
        sha, seq = ends[0] if ends else (None, None)
        under = _name(self.keys[row], depth) if is_open and below else None
        for c in below:
            self.close(c, depth, None if is_open else least, under)
        if is_open:
            # on the first prefix, or on the last where only that reaches it
            side = 0 if flags & 1 and depth <= self.ll else 1
            self.open[side, depth] = [n, least, kids, leaves, saved, sha, seq]
            self.top[row] = None
            return
        if depth:
            saved += (n - 1) * int(self.words[row][depth - 1])
        self.top[row] = (depth, n, least, kids, leaves if kids else 1, saved, sha, seq, row)
        if depth == 0:
            self.close(self.top[row], -1, None, None)

    def lifted(self, c: tuple, depth: int) -> int:
        """Tokens saved in the subtree of the node at ``depth`` above component ``c``, on its own prefix."""
        return c[5] + (c[1] - 1) * (self.up_to[c[8]][c[0] - 1] - self.up_to[c[8]][depth - 1]) if c[0] > depth else c[5]

    def close(self, c: tuple, depth: int, parent: int | None, under: str | None) -> None:
        """Gives out the top of ``c`` and the single nodes between it and ``depth``."""
        top, n, least, kids, leaves, saved, sha, seq, row = c
        node = _name(self.keys[row], top) if self.named else None
        for d in range(top, depth, -1):
            last = d == depth + 1
            self.nodes.append((least, d, parent if last else least, n, kids, leaves, saved, sha, seq, node, under if last else None))
            if d > 1:
                saved += (n - 1) * int(self.words[row][d - 2])
            kids, sha, seq, node = 1, None, None, None


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in _OUT_NAMES})


def _given(forest: Forest, part: int) -> list[dict]:
    """Closed nodes and the contracted forest as rows."""
    names = _OUT_NAMES[:11]
    out = [dict(zip(names, n, strict=True)) for n in forest.nodes]
    for side, depth in ((0, forest.ll), (1, forest.rl)):
        if depth >= 0:
            row = forest.rows[side]
            marks = [
                dict(zip(("depth", "n", "least", "kids", "leaves", "saved", "sha", "seq"), (d, *m), strict=True)) for (s, d), m in sorted(forest.open.items()) if s == side
            ]
            out.append(
                {"part": part, "left": side == 0, "ll": forest.ll, "rl": forest.rl, "key": forest.keys[row][: _HASH * depth], "words": list(forest.words[row][:depth]), "marks": marks}
            )
    return out


def _pieces(ids: list[int]) -> list[bytes]:
    each = _PIECE // 8
    return [",".join(map(str, ids[k : k + each])).encode() for k in range(0, len(ids), each)]


def _of_conversations(rows: pd.DataFrame) -> pd.DataFrame:
    """The forest of one partition of conversations, and the ids of those that other partitions may have too."""
    part, ll, rl = int(rows["part"].iloc[0]), int(rows["ll"].iloc[0]), int(rows["rl"].iloc[0])
    rows = rows.sort_values(["key", "conv_id"], kind="stable")
    keys, words, marks, out = [], [], [], []
    all_keys, ids, all_words = list(rows["key"]), rows["conv_id"].tolist(), list(rows["words"])
    starts = [k for k in range(len(all_keys)) if k == 0 or all_keys[k] != all_keys[k - 1]]
    for s, e in zip(starts, [*starts[1:], len(all_keys)], strict=True):
        key = bytes(all_keys[s])
        depth = len(key) // _HASH
        is_open = (s == 0 and depth <= ll) or (e == len(all_keys) and depth <= rl)
        seq = sha = None
        if is_open:
            seq = hashlib.md5(key).hexdigest()
            out += [{"seq": seq, "part": part, "piece": k, "ids": piece} for k, piece in enumerate(_pieces(ids[s:e]))]
        else:
            sha = hashlib.sha256(",".join(map(str, ids[s:e])).encode()).hexdigest()
        keys.append(key)
        words.append(np.asarray(all_words[s], np.int64))
        marks.append({depth: (e - s, ids[s], 0, 0, 0, sha, seq)})
    forest = Forest(keys, words, marks, 0, len(keys) - 1, ll, rl, False)
    forest.run()
    return _frame(_given(forest, part) + out)


def _of_forests(rows: pd.DataFrame) -> pd.DataFrame:
    """The forest of neighbouring partitions, from their contracted ones."""
    group = int(rows["group"].iloc[0])
    rows = rows.sort_values(["part", "left"], ascending=[True, False], kind="stable")
    parts, sides = rows["part"].tolist(), rows["left"].tolist()
    ll = int(rows["ll"].iloc[0])
    rl = int(rows["rl"].iloc[-1])
    first = next((k for k in range(len(parts)) if parts[k] == parts[0] and sides[k]), -1) if ll >= 0 else -1
    last = next((k for k in range(len(parts)) if parts[k] == parts[-1] and not sides[k]), -1) if rl >= 0 else -1
    given = [[m.asDict() if hasattr(m, "asDict") else m for m in ms] for ms in rows["marks"]]
    kept = [k for k in range(len(parts)) if len(given[k]) or k in (first, last)]
    keys = [bytes(k) for k in rows["key"]]
    kept.sort(key=lambda k: keys[k])
    place = {k: i for i, k in enumerate(kept)}
    marks = [{m["depth"]: (m["n"], m["least"], m["kids"], m["leaves"], m["saved"], m["sha"], m["seq"]) for m in given[k]} for k in kept]
    words = [np.asarray(rows["words"].iloc[k], np.int64) for k in kept]
    forest = Forest([keys[k] for k in kept], words, marks, place.get(first, -1), place.get(last, -1), ll, rl, True)
    forest.run()
    return _frame(_given(forest, group))


def _bounds(rows: DataFrame) -> DataFrame:
    """(part, ll, rl): common prefixes with the neighbouring partitions; one row a partition."""
    ends = rows.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))

    @F.pandas_udf("int")
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([-1 if x is None or y is None else common_turns(bytes(x), bytes(y)) for x, y in zip(a, b, strict=True)], dtype="int32")

    near = Window.orderBy("part")
    both = ends.withColumn("before", F.lag("last").over(near)).withColumn("after", F.lead("first").over(near))
    return both.select("part", shared("before", "first").alias("ll"), shared("last", "after").alias("rl"))


def _digests(pieces: DataFrame) -> DataFrame:
    """(seq, sha): SHA-256 of the ids of conversations that are spread over partitions, as a stream."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seq, state = None, None
        for batch in batches:
            done = []
            for s, ids in zip(batch["seq"], batch["ids"], strict=True):
                if s != seq:
                    if state is not None:
                        done.append((seq, state.hexdigest()))
                    seq, state = s, hashlib.sha256(ids)
                else:
                    state.update(b",")
                    state.update(ids)
            yield pd.DataFrame(done, columns=["seq", "sha"])
        if state is not None:
            yield pd.DataFrame([(seq, state.hexdigest())], columns=["seq", "sha"])

    return pieces.repartition("seq").sortWithinPartitions("seq", "part", "piece").select("seq", "ids").mapInPandas(digest, "seq string, sha string")


def prefix_trie(conversations: DataFrame, parts: int | None = None, fan: int = FAN) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    made = stored(rebuild(conversations), "rebuilt")
    if parts is None:
        size = made.agg(F.sum(F.octet_length("key") * 2 + 64)).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    dealt = made.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id().cast("long"))
    dealt = stored(dealt, "sorted")
    bounds = stored(_bounds(dealt), "bounds")
    out = stored(dealt.join(F.broadcast(bounds), "part").groupBy("part").applyInPandas(_of_conversations, _OUT), "forest")
    levels = [out]
    left = bounds.count()
    while left > 1:
        contracted = levels[-1].filter("marks is not null").withColumn("group", F.floor(F.col("part") / fan))
        levels.append(stored(contracted.groupBy("group").applyInPandas(_of_forests, _OUT), "forest"))
        left = levels[-1].filter("marks is not null").select("part").distinct().count()
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    nodes = nodes.filter("depth is not null")
    # nodes that were open at first, a few a partition, are the parents that partitions didn't know
    known = nodes.filter("node is not null").select(F.col("node").alias("under"), F.col("conv_id").alias("above"))
    nodes = attach(nodes, known, ["under"], by=["conv_id", "depth"])
    digests = _digests(out.filter("ids is not null")).withColumnRenamed("sha", "packed")
    nodes = attach(nodes, digests, ["seq"], by=["conv_id", "depth"])
    return nodes.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", "packed", F.lit(_NOTHING)).alias("ends_sha256")
    )
