import gzip
import hashlib
import pathlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, difference
from hexwatch.llm import warc
from hexwatch.llm.queries import ORACLES, QUERIES
from hexwatch.session import shared_dir


def test_query_against_sql(spark, sf):
    assert difference(spark, connect(sf), QUERIES["op1_warc"], ORACLES["op1_warc"], sf) is None


LONG = "<p>" + "é" * 90 + "</p>"
PAGES = [(1, "http://a/1", LONG), (5, "http://a/5", "short"), (3, None, LONG), (2, "http://a/2\r\nX-Evil: 1", LONG), (4, "http://a/4", "short"), (6, "u", None), (7, "u", ""), (None, "n", "z" * 200), (None, "n", "z" * 200), (8, "big", "x\r\n\r\n" * 300000), (1, "http://a/1b", LONG)]


@pytest.fixture(scope="module")
def archive(spark):
    path = shared_dir(spark, "warc-test")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("own")).repartition(3)
    warc.write(warc.records(pages), path)
    return path


def test_round_trip(spark, archive):
    rows = warc.read(spark, archive).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        body = [(h or "").encode() for i, u, h in PAGES if i == r["page_id"]][0]
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == hashlib.sha256(body).hexdigest()
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == body and r["refers_to"] is None
        else:
            assert r["payload"] is None and r["refers_to"] == 1
    kinds = sorted(((r["page_id"] or 0), r["record_type"]) for r in rows)
    assert [k for k in kinds if k[1] == "revisit"] == [(2, "revisit"), (3, "revisit")]
    uris = {r["page_id"]: r["target_uri"] for r in rows}
    assert uris[3] is None and uris[2] == "http://a/2%0D%0AX-Evil: 1"
    assert len({r["record_id"] for r in rows if r["page_id"] != 1}) == len(rows) - 2


def test_predicates_are_pushed_and_blocks_skipped(spark, archive, monkeypatch):
    rows = warc.read(spark, archive).where((F.col("record_type") == "revisit") & (F.col("page_id") > 2))
    assert [r["page_id"] for r in rows.collect()] == [3]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Filter \(", plan)
    one = warc.WarcReader(warc.as_uri(archive), True)
    from pyspark.sql.datasource import EqualTo, StringContains

    assert [type(f) for f in one.pushFilters([EqualTo(("page_id",), 8), StringContains(("target_uri",), "b"), EqualTo(("payload",), b"")])] == [StringContains, EqualTo]
    read = []
    monkeypatch.setattr(warc.RecordStream, "block", lambda self, n, f=warc.RecordStream.block: read.append(n) or f(self, n))
    found = [r for p in one.partitions() for b in one.read(p) for r in b.to_pylist()]
    assert [r["page_id"] for r in found] == [8] and len(read) == 1
    bare = warc.WarcReader(warc.as_uri(archive), False)
    read.clear()
    assert sum(b.num_rows for p in bare.partitions() for b in bare.read(p)) == len(PAGES) and not read


def test_only_committed_files_are_read(spark, archive):
    folder = pathlib.Path(archive.removeprefix("file://"))
    (folder / "part-99999-0000-lost.warc.gz").write_bytes(b"broken")
    assert warc.read(spark, archive).count() == len(PAGES)


def test_plain_archives_of_others(spark, tmp_path):
    text = "WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.0\r\nwarc-type: resource\r\nWARC-Target-URI: http://x\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(text.encode())
    rows = warc.read(spark, str(tmp_path)).orderBy("record_type").collect()
    assert [(r["record_type"], r["target_uri"], bytes(r["payload"])) for r in rows] == [("resource", "http://x", b"abc"), ("warcinfo", None, b"hello")]
    (tmp_path / "b.warc").write_bytes(text.encode()[:-20])
    with pytest.raises(Exception, match="archive ends inside"):
        warc.read(spark, str(tmp_path)).collect()


def test_empty(spark):
    path = shared_dir(spark, "warc-empty")
    warc.write(warc.records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read(spark, path).count() == 0


GZIP = gzip.compress(b"packed body")
DEFLATE = zlib.compress(b"deflated")
BARE = zlib.compress(b"bare deflated")[2:-4]
FOREIGN = [
    (b"no message at all", b"no message at all"),
    (b"HTTP/1.1 204 No Content\r\nServer: x", b""),
    (b"HTTP/1.1 200 OK\n\nline ends alone", b"line ends alone"),
    (b"HTTP/1.1 200 OK\r\nServer: caf\xe9\r\n\r\nlatin", b"latin"),
    (b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4;x=y\r\nabcd\r\nA\r\n0123456789\r\n0\r\n\r\n", b"abcd0123456789"),
    (b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nnot chunks\r\n", b"not chunks\r\n"),
    (b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n9\r\ncut", b"9\r\ncut"),
    (b"HTTP/1.1 200 OK\r\nContent-Encoding:\r\n gzip\r\n\r\n" + GZIP, b"packed body"),
    (b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + GZIP[:-9], GZIP[:-9]),
    (b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nplain after all", b"plain after all"),
    (b"HTTP/1.1 200 OK\r\nContent-Encoding: deflate\r\n\r\n" + DEFLATE, b"deflated"),
    (b"HTTP/1.1 200 OK\r\nContent-Encoding: deflate\r\n\r\n" + BARE, b"bare deflated"),
    (b"HTTP/1.1 200 OK\r\nContent-Encoding: br\r\n\r\nstays", b"stays"),
]


def test_archives_from_elsewhere(spark, tmp_path):
    """Plain and compressed files without manifest, odd headers and codings."""
    for k, pack in enumerate((bytes, gzip.compress)):
        with open(tmp_path / f"f{k}.warc{'.gz' if k else ''}", "wb") as out:
            for n, (block, _) in enumerate(FOREIGN):
                head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r{n}>\r\nX-Note: \u00e9\r\n\tfolded\r\n".encode("latin-1")
                head += b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block)
                out.write(pack(head + block + b"\r\n\r\n"))
    got = sorted((r["record_id"], bytes(r["payload"])) for r in warc.read(spark, str(tmp_path)).collect())
    assert got == sorted((f"<r{n}>", body) for n, (_, body) in enumerate(FOREIGN) for _ in range(2))


def test_a_record_without_length_is_named(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <lost>\r\n\r\nabc\r\n\r\n")
    with pytest.raises(Exception, match="without a content length: <lost>"):
        warc.read(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("most", [0, 1000])
def test_many_repeated_digests(spark, monkeypatch, most):
    """The same records whether repeated digests are broadcast or dealt by salt."""
    monkeypatch.setattr(warc, "MAX_BROADCAST_DIGESTS", most)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.records(pages).select("page_id", "url", "refers_to", "payload_digest", F.col("payload").isNull().alias("bare")).collect()
    first = {d: min((i for i, _, h in PAGES if i is not None and hashlib.sha256((h or "").encode()).hexdigest() == d), default=None) for d in {r["payload_digest"] for r in rows}}
    assert len(rows) == len(PAGES)
    for r in rows:
        revisit = first[r["payload_digest"]] == 1 and r["page_id"] != 1
        assert (r["refers_to"], r["bare"]) == ((1, True) if revisit else (None, False))
