"""WARC archives with a two-level capture index.

Pages are written as WARC records, each compressed on its own. Their captures, sorted by URL key
(host reversed), go to shard files of compressed blocks, and a sparse directory at the end of
each shard file has the first key and the place of every block. A look-up finds the shard by
binary search in the shards' first keys, the block by binary search in the directory, reads that
range, and then reads the range of the archive that holds the record.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes one is a response and the others
are revisits without payload. Files lie in the shared folder and are written under names that no
other attempt has; only files of finished tasks are named in tables, so that lost executors leave
at most files that nobody reads.

Defined cases: a null payload is empty, a null URL has the empty key, a null id is no smallest
id; rows that repeat the smallest id of a payload are all responses; an empty table gives no row;
extra columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.functions.storage import new_path
from reptally.llm.common import stored

MIN_REVISIT = 100
#: Captures of one compressed index block.
BLOCK = 500
_LEVEL = 6


def _opened(uri: str):
    """File system and path of a folder in the shared store (local or any that Arrow knows)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


class _File:
    """A file under a fresh name that is only named in results when it is complete."""

    def __init__(self, folder: str, kind: str):
        self.system, path = _opened(folder)
        self.system.create_dir(path, recursive=True)
        self.name = f"{kind}-{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.at = 0

    def add(self, data: bytes) -> tuple[int, int]:
        self.out.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)


class _Reader:
    """Range reads of the files of one folder; the last file stays open."""

    def __init__(self, folder: str):
        self.system, self.path = _opened(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.name, self.file = name, self.system.open_input_file(f"{self.path}/{name}")
        return self.file.read_at(length, offset)

    def size(self, name: str) -> int:
        self.read(name, 0, 0)
        return self.file.size()


def url_key(url: Column) -> Column:
    """Host labels reversed, then the path: ``com,example)/path?query``; no scheme, port, user,
    ``www.`` or fragment, in lower case."""
    parts = lambda i: F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^@/?#]*@)?(?:www\d*\.)?([^/?#:]*)(?::\d+)?([^#]*)", i)
    path = F.when(parts(2) == "", "/").otherwise(parts(2))
    key = F.concat(F.array_join(F.reverse(F.split(parts(1), r"\.")), ","), F.lit(")"), path)
    return F.when(url.isNull() | (url == ""), F.lit("")).otherwise(F.regexp_replace(key, r"[\x00-\x1F]", "%"))


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record, uncompressed. The payload's length is kept in revisits too."""
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name and the content of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


def marked(pages: DataFrame) -> DataFrame:
    """``pages`` with digest, key, kind of record and the page that a revisit refers to."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n"))
    counted = rows.filter(F.col("n") >= MIN_REVISIT).groupBy("digest")
    equal = counted.agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("digest", "least")
    rows = attach(rows, equal, ["digest"], "left", by=["page_id"])
    revisit = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    return rows.select("page_id", "url", "html", "digest", url_key(F.col("url")).alias("key"), F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("least")).alias("refers_to"))


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the records of ``pages``; returns the stored captures (key, page_id, kind, file,
    offset, length)."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        file = None
        for batch in batches:
            file = file or _File(folder, "records")
            out = []
            for r in batch.to_pylist():
                data = record(r["kind"], r["page_id"], r["url"], r["html"].encode(), r["digest"], r["refers_to"])
                out.append((r["key"], r["page_id"], r["kind"], file.name, *file.add(gzip.compress(data, _LEVEL, mtime=0))))
            file.out.flush()
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), batch.schema.field("page_id").type, pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "page_id", "kind", "file", "offset", "length"])
        if file:
            file.out.close()

    kind = pages.schema["page_id"].dataType.simpleString()
    return stored(marked(pages).mapInArrow(write, f"key string, page_id {kind}, kind string, file string, offset long, length long"), "captures")


def _line(key: str, page_id: int | None, file: str, offset: int, length: int) -> bytes:
    return f"{key}\x00{'' if page_id is None else page_id}\x00{file}\x00{offset}\x00{length}".encode()


def write_index(captures: DataFrame, folder: str, shards: int | None = None, block: int = BLOCK) -> DataFrame:
    """Sorts captures by (key, page_id) into shard files; returns the shards (first, last, name).

    Rows of one key may fill many shards. A shard file ends with its directory and the
    directory's length; the table of shards has one row each.
    """
    spark = captures.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mixed = F.xxhash64("page_id", "file", "offset").alias("mix")
    ranged = captures.select("key", "page_id", "file", "offset", "length", mixed)
    ranged = ranged.repartitionByRange(shards, "key", F.coalesce("page_id", F.lit(-1)), "mix").sortWithinPartitions("key", F.coalesce("page_id", F.lit(-1)), "mix")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lines: list[bytes] = []
        directory: list[tuple] = []
        file, first, last = None, None, None

        def flush() -> None:
            head = lines[0].split(b"\x00")
            directory.append((head[0].decode(), *file.add(zlib.compress(b"\n".join(lines), _LEVEL))))
            lines.clear()

        for batch in batches:
            for r in batch.to_pylist():
                file = file or _File(folder, "index")
                first = r["key"] if first is None else first
                last = r["key"]
                lines.append(_line(last, r["page_id"], r["file"], r["offset"], r["length"]))
                if len(lines) == block:
                    flush()
        if file is None:
            return
        if lines:
            flush()
        packed = zlib.compress(json.dumps(directory).encode(), _LEVEL)
        file.add(packed)
        file.add(struct.pack("<Q", len(packed)))
        file.out.close()
        yield pa.RecordBatch.from_pydict({"first": [first], "last": [last], "name": [file.name]})

    return stored(ranged.mapInArrow(write, "first string, last string, name string"), "shards")


def lookup(queries: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """Captures (key, page_id, file, offset, length) of each distinct ``key`` of ``queries``.

    The shards' first and last keys, one pair per index file, are found by binary search; each
    task reads the directory of one shard and the ranges of the blocks it needs.
    """
    # one row per index file: as many as partitions were asked for, whatever the input
    known = [(r["first"], r["last"], r["name"]) for r in shards.orderBy("first", "last").collect()]
    firsts, lasts = [k[0] for k in known], [k[1] for k in known]

    @F.pandas_udf("array<string>")
    def holding(keys: pd.Series) -> pd.Series:
        return pd.Series([[x[2] for x in known[bisect.bisect_left(lasts, k) : bisect.bisect_right(firsts, k)]] for k in keys])

    wanted = queries.select("key").distinct().select("key", F.explode(holding("key")).alias("shard"))
    n = max(1, len(known))
    wanted = wanted.repartition(n, "shard").sortWithinPartitions("shard", "key")

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader = _Reader(folder)
        shard, directory, starts, cached = None, [], [], (None, [], [])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                key = r["key"]
                if r["shard"] != shard:
                    shard = r["shard"]
                    end = reader.size(shard)
                    (size,) = struct.unpack("<Q", reader.read(shard, end - 8, 8))
                    directory = json.loads(zlib.decompress(reader.read(shard, end - 8 - size, size)))
                    starts, cached = [d[0] for d in directory], (None, [], [])
                # a key that begins a block may also end the one before
                for b in range(max(0, bisect.bisect_left(starts, key) - 1), bisect.bisect_right(starts, key)):
                    if cached[0] != b:
                        entries = [e.split("\x00") for e in zlib.decompress(reader.read(shard, *directory[b][1:])).decode().split("\n")]
                        cached = (b, [e[0] for e in entries], entries)
                    for e in cached[2][bisect.bisect_left(cached[1], key) : bisect.bisect_right(cached[1], key)]:
                        out.append((r["key"], int(e[1]) if e[1] else None, e[2], int(e[3]), int(e[4])))
                        if len(out) == 10_000:
                            yield frame(pa, out)
                            out = []
            yield frame(pa, out)

    def frame(pa, out: list[tuple]):
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "page_id", "file", "offset", "length"])

    return wanted.mapInArrow(find, "key string, page_id long, file string, offset long, length long")


def read_records(captures: DataFrame, folder: str, pieces: int) -> DataFrame:
    """Header digest columns of the records at (file, offset, length), read in file order."""
    dealt = captures.repartition(pieces, "file", F.floor(F.col("offset") / (4 << 20))).sortWithinPartitions("file", "offset")

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader = _Reader(folder)
        number = lambda text: int(text.strip("<>").rpartition(":")[2] or -1)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                fields, body = parsed(gzip.decompress(reader.read(r["file"], r["offset"], r["length"])))
                kind, digest, size = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["x-payload-length"])
                if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
                    raise ValueError(f"damaged record in {r['file']} at {r['offset']}")
                refers = number(fields["warc-refers-to"]) if kind == "revisit" else None
                page = fields["warc-record-id"].strip("<>").rpartition(":")[2]
                out.append((int(page) if page else None, size, digest, kind, refers))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return dealt.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives and index, looks every key up, and reads all records back."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    captures = write_archive(pages, folder)
    shards = write_index(captures, folder)
    found = lookup(captures, shards, folder)
    return read_records(found, folder, int(spark.conf.get("spark.sql.shuffle.partitions")))


def captures_of(urls: Iterable[str], shards: DataFrame, folder: str) -> DataFrame:
    """Captures of some URLs by the index."""
    spark = shards.sparkSession
    asked = spark.createDataFrame([(u,) for u in urls], "url string").select(url_key(F.col("url")).alias("key"))
    return lookup(asked, shards, folder)
