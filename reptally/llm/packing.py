"""Bounded-space online packing of tokenised documents into sequences of a fixed length.

Each partition keeps a fixed number of open windows. A piece goes to the open window it fills
best; if it fits in none, the fullest window is closed to make room. Windows that are still
open at the end are merged with those of neighbouring partitions. Documents are cut only at
the sequence length, plus once where a closed window would else waste more than ``slack``.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each; a null
id stays null; an empty table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.llm.common import stored

LENGTH = 2048
OPEN = 64
SLACK = 32
END_ID = 1
#: Windows of so many partitions are merged in one task.
MERGED = 64
#: Words that a task keeps between runs of texts; beyond, it starts anew.
_CACHED_WORDS = 300_000
#: Bytes of text that are encoded together.
_RUN_BYTES = 2 << 20
_JOINED = 200
#: Marks that, after a word of letters, are a token run of their own; no apostrophe, no < or |.
_MARKS = "!#$%&*~^.,;:?"
_END = np.array([END_ID], "<u4").tobytes()


def _encode(words: list[str], model, ends: np.ndarray, known: dict[str, bytes]) -> None:
    """Adds the ids of ``words`` to ``known``. A word of letters is one run up to its end, so
    many are encoded as one text and told apart by their ends; where that doesn't give one end a
    word, and for all other words, each is encoded alone."""
    plain = [w for w in words if w.isalpha()]
    alone = [w for w in words if not w.isalpha()]
    groups = [plain[k : k + _JOINED] for k in range(0, len(plain), _JOINED)]
    for group, e in zip(groups, model.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(e.ids, "<u4")
        last = np.flatnonzero(ends[ids])
        if len(last) == len(group) and (not len(ids) or last[-1] == len(ids) - 1):
            data, at = ids.tobytes(), 0
            for w, k in zip(group, (4 * (last + 1)).tolist(), strict=True):
                known[w], at = data[at:k], k
        else:
            alone += group
    for w, e in zip(alone, model.encode_batch_fast(alone, add_special_tokens=False), strict=True):
        known[w] = np.array(e.ids, "<u4").tobytes()


class Encoder:
    """A tokenizer, its ids that end a word, and ids of the words known so far. A task has one of its
    own, and nothing stays in the Python worker when the task ends."""

    def __init__(self, tokenizer: str):
        # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(tokenizer)
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        for token, k in self.model.get_vocab().items():
            self.ends[k] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}

    def token_bytes(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers, without special ids.

        The tokenizer drops white space and never joins what it separates, nor letters and marks, so
        that the ids of a text are those of its words. Each distinct word is looked up once a call,
        and the words' ids are put together in arrays.
        """
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        # a distinct word is its letters and the marks that end it, or else one part and no marks
        whole = coded.dictionary
        core = pc.utf8_rtrim(whole, _MARKS)
        plain = pc.utf8_is_alpha(core)
        marked = pc.and_(plain, pc.less(pc.binary_length(core), pc.binary_length(whole)))
        tails = np.full(len(whole), "", object)
        tails[marked.to_numpy(zero_copy_only=False)] = pc.replace_substring_regex(whole.filter(marked), f"^.*[^{re.escape(_MARKS)}]", "").to_numpy(zero_copy_only=False)
        cores = pc.if_else(plain, pc.ascii_lower(core), whole).dictionary_encode()
        marks = pa.array(tails, pa.string()).dictionary_encode()
        known = self.known
        if len(known) > _CACHED_WORDS:
            known.clear()
        distinct = cores.dictionary.to_pylist() + marks.dictionary.to_pylist()
        _encode(list({p for p in distinct if p not in known}), self.model, self.ends, known)
        found = [known[p] for p in distinct]
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        # both parts of each word, one after the other
        part = np.stack([cores.indices.to_numpy(), marks.indices.to_numpy() + len(cores.dictionary)], axis=1)
        part = part[coded.indices.to_numpy()].ravel()
        lengths = sizes[part]
        ends_at = np.cumsum(lengths)
        data = ids[np.repeat(starts[part] - (ends_at - lengths), lengths) + np.arange(lengths.sum())].tobytes()
        bounds = 2 * (words.offsets.to_numpy() - words.offsets[0].as_py())
        cuts = (4 * np.concatenate([[0], ends_at])[bounds]).tolist()
        return [data[a:b] for a, b in pairwise(cuts)]


def token_bytes(texts: pa.Array | list[str | None], tokenizer: str) -> list[bytes]:
    """Ids of each text, see :meth:`Encoder.token_bytes`."""
    return Encoder(tokenizer).token_bytes(texts)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of about ``_RUN_BYTES``; a longer text is a run of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _RUN_BYTES, "right")))
        yield at, end - at
        at = end


class Windows:
    """Open windows by room; closed ones are given out. A window is [room, number, pieces]."""

    def __init__(self, length: int, most: int, slack: int):
        self.length, self.most, self.slack = length, most, slack
        self.open: list[tuple[int, int, list]] = []
        self.number = 0

    def add(self, size: int, piece: tuple) -> Iterator[tuple[int, list]]:
        """Places ``size`` ids whose first is at ``piece[1]``; gives the windows that close."""
        doc, start = piece
        while size >= self.length:
            yield self._next(), [(doc, start, self.length)]
            start, size = start + self.length, size - self.length
        while size:
            at = bisect.bisect_left(self.open, (size,))
            if at < len(self.open):
                room, number, pieces = self.open.pop(at)
                pieces.append((doc, start, size))
                if room == size:
                    yield number, pieces
                else:
                    bisect.insort(self.open, (room - size, number, pieces))
                return
            if len(self.open) < self.most:
                bisect.insort(self.open, (self.length - size, self._next(), [(doc, start, size)]))
                return
            room, number, pieces = self.open.pop(0)
            if room > self.slack:  # cut rather than pad
                pieces.append((doc, start, room))
                start, size = start + room, size - room
            yield number, pieces

    def _next(self) -> int:
        self.number += 1
        return self.number - 1


_FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
COLUMNS = ("doc_id", *_FIELDS)


def _merge(group: pd.DataFrame, length: int) -> pd.DataFrame:
    """Which window each open window moves to and by how much: best fit, fullest first."""
    rooms: list[tuple[int, int]] = []
    out = []
    for seq, size in group.sort_values(["size", "seq"], ascending=[False, True])[["seq", "size"]].itertuples(index=False):
        at = bisect.bisect_left(rooms, (size,))
        room, target = rooms.pop(at) if at < len(rooms) else (length, seq)
        out.append((seq, target, length - room))
        bisect.insort(rooms, (room - size, target))
    return pd.DataFrame(out, columns=["seq", "to", "by"])


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, most: int = OPEN, slack: int = SLACK, merged: int = MERGED
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``tokenizer`` is the path of a tokenizer file that every executor has. The first pass is
    written, so that numbers of windows stay as they are when tasks run again.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        windows, held, encoder = Windows(length, most, slack), {}, None
        count, kind = 0, None

        def rows(closed: Iterable, is_open: bool) -> Iterator[tuple]:
            for number, pieces in closed:
                at = 0
                for doc, start, size in pieces:
                    entry = held[doc]
                    crc = zlib.crc32(entry[1][4 * start : 4 * (start + size)])
                    yield entry[0], start, size, crc, len(entry[1]) // 4, (task << 40) | number, at, is_open, task // merged
                    at += size
                    entry[2] -= size
                    if not entry[2]:
                        del held[doc]

        def frame(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 9
            kinds = [kind, *[pa.int64()] * 6, pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*COLUMNS, "is_open", "task"]
            )

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            encoder = encoder or Encoder(tokenizer)
            for at, n in _slices(batch.column("text")):
                part, out = batch.slice(at, n), []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.token_bytes(part.column("text")), strict=True):
                    ids += _END
                    held[count] = [doc_id, ids, len(ids) // 4]
                    out += rows(windows.add(len(ids) // 4, (count, 0)), False)
                    count += 1
                yield frame(out)
        if kind is not None:
            yield frame(list(rows([w[1:] for w in windows.open], True)))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, " + "".join(f"{f} long, " for f in _FIELDS) + "is_open boolean, task long"
    pieces = stored(docs.select("doc_id", "text").mapInArrow(place, schema), "pieces")
    is_open = pieces.filter("is_open")
    sizes = is_open.groupBy("task", F.col("sequence_id").alias("seq")).agg(F.sum("length").alias("size"))
    moves = stored(sizes.groupBy("task").applyInPandas(lambda g: _merge(g, length), "seq long, to long, by long"), "moves")
    # one row per open window on one side, the few pieces of open windows on the other
    moved = is_open.join(moves, is_open["sequence_id"] == moves["seq"]).select(
        *COLUMNS[:5], F.col("to").alias("sequence_id"), (F.col("offset") + F.col("by")).alias("offset")
    )
    return pieces.filter("not is_open").select(*COLUMNS).unionByName(moved)
