import base64
import gzip
import hashlib

from sightline.llm import queries, warc
from sightline.llm.common import work_folder

FOLDER = "/root/testdata/sf0.001"


def expected(pages):
    largest = {}
    for i, h in pages:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", i))
    for i, h in pages:
        data, leader = (h or "").encode(), largest.get(h or "")
        first = i == leader
        yield (i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else leader)


def key(row):
    return tuple(str(x) for x in row)


def test_round_trip_of_the_table(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    rows = queries.QUERIES["op1_warc"](spark, FOLDER).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=key) == sorted(expected(pages), key=key) and all(r.complete for r in rows)


def test_nulls_ties_long_pages_and_line_ends(spark):
    tricky = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n0\r\n\r\n"
    pages = [(1, None), (2, ""), (5, tricky), (3, tricky), (7, "é" * 70_000), (8, "b"), (8, "b"), (9, None), (None, "only"), (None, "b"), (10, "k\n" * 9)]
    rows = [(i, "http://x/\r\nInjected: 1" if i == 5 else None, h, "x", "x") for i, h in pages]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, kind string").repartition(3)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(table).collect()]
    assert sorted(got, key=key) == sorted(expected(pages), key=key)
    assert warc.round_trip(table.where("false")).count() == 0


def test_archives_are_bounded_gzip_files_of_segments(spark):
    import glob
    folder = work_folder(spark)
    pages = spark.createDataFrame([(k, None, "ab" * 20_000 + str(k)) for k in range(6)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, folder, segment_bytes=1000, archive_records=50)
    files = glob.glob(f"{folder.removeprefix('file://')}/*.gz")
    counts = [sum(1 for _ in warc.parsed(open(f, "rb").read())) for f in files]
    assert len(files) > 1 and max(counts) <= 50 and sum(counts) >= 6 * 40
    records = warc.read_archives(spark, folder)
    assert records.where("kind = 'continuation'").count() > 200
    whole = warc.reassemble(records)
    assert {bytes(r.payload).decode() for r in whole.collect()} == {"ab" * 20_000 + str(k) for k in range(6)}
    # a lost, a doubled and a cut segment
    for broken in (records.where("segment <> 3"), records.union(records.where("segment = 2")), records.where("total_length IS NULL")):
        assert {(r.complete, r.payload) for r in warc.reassemble(broken).collect()} == {(False, None)}
    assert warc.reassemble(records.where("segment > 1")).count() == 0


def test_framing():
    for n in (0, 1, 2999, 3000, 3001, 9000):
        data = bytes(k % 251 for k in range(n))
        assert warc.unframed(warc.framed(data)) == data
    assert warc.unframed(b"5\r\nabc") is None and warc.unframed(b"zz\r\n") is None and warc.unframed(b"") is None
    assert warc.unframed(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nplain") == b"plain" and warc.payload_of(b"nothing") is None
    members = gzip.compress(b"WARC/1.1\r\nWARC-Record-ID: a\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n") * 2
    assert [r["block"] for r in warc.parsed(members)] == [b"hi", b"hi"]
