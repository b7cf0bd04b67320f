import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reptally.functions.storage import new_path
from reptally.llm import warc

SCHEMA = "page_id long, url string, html string, key string, kind int, file string"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], SCHEMA)


def brute(rows):
    data = [(h or "").encode() for _, _, h in rows]
    out = []
    for (i, _, _), d in zip(rows, data, strict=True):
        same = [j for (j, _, _), e in zip(rows, data, strict=True) if e == d]
        least = min((j for j in same if j is not None), default=None)
        revisit = len(d) >= 100 and len(same) > 1 and least is not None and i != least
        out.append((str(i), len(d), hashlib.sha256(d).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    return sorted(out, key=str)


def sample():
    rnd = random.Random(6)
    rows = [(k, f"http://h{k % 9}.example.com:80/p/{k % 40}?q={k % 3}#f", "<p>" + "x" * rnd.randint(0, 300) + "é" * (k % 5)) for k in range(300)]
    rows += [(1000 + k, "https://www.Hot.example/", "<html>" + "same " * 40) for k in range(150)]
    return rows + [(2000, None, None), (2001, "", ""), (None, "http://n.example/\nx", "n" * 200), (2002, "no scheme/ä b", "n" * 200), (7, "http://n.example", "y" * 150), (7, "http://n.example", "y" * 150)]


def test_against_brute_force(pages):
    rows = sample()
    got = warc.archive_and_read(pages(rows)).collect()
    assert sorted(((str(r["page_id"]), *r[1:]) for r in got), key=str) == brute(rows)


def test_empty_table(pages):
    assert warc.archive_and_read(pages([(1, "u", "h")]).limit(0)).count() == 0


def test_lookup_over_blocks_and_shards(pages, spark):
    folder = new_path(spark, "warc-test")
    rows = sample()
    captures = warc.write_archive(pages(rows), folder)
    shards = warc.write_index(captures, folder, shards=5, block=7)
    # a key that fills many blocks and shards, others, and one that is nowhere
    found = warc.captures_of(["http://hot.example/", "http://h1.example.com/p/1?q=1", "http://nowhere.example/"], shards, folder).collect()
    want = [i for i, u, _ in rows if u and (u.startswith("https://www.Hot") or u == "http://h1.example.com:80/p/1?q=1#f")]
    assert sorted(r["page_id"] for r in found) == sorted(want)
    assert warc.lookup(captures, shards, folder).count() == len(rows)


def test_keys(spark):
    urls = {
        "http://www.Example.com:8080/A/b?c=D#frag": "com,example)/a/b?c=d",
        "https://user@a.b.example.org": "org,example,b,a)/",
        "": "",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", warc.url_key(F.col("url")).alias("key"))
    assert {r["url"]: r["key"] for r in df.collect()} == urls


def test_record_round_trip():
    data = "é\r\n\r\nWARC/1.1\r\n".encode() * 9
    fields, body = warc.parsed(gzip.decompress(gzip.compress(warc.record("response", 4, "http://a/\r\nX: y", data, "d", None))))
    assert body == data and fields["warc-type"] == "response" and "x" not in fields
    fields, body = warc.parsed(warc.record("revisit", 5, None, data, "d", 4))
    assert body == b"" and fields["warc-refers-to"] == "<urn:page:4>" and fields["x-payload-length"] == str(len(data))
