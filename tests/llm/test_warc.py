import base64
import gzip
import hashlib
import os

import pytest

from isochron.llm import warc


def expected(rows, least=0):
    """rows: (page_id, payload)"""
    first = {}
    for page, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(html or "", page)
    out, used = [], set()
    for page, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (html or "").encode()
        revisit = len(raw) >= least and (html or "") in used
        used.add(html or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = pages.unionByName(pages.selectExpr("page_id + 1000 AS page_id", "url", "html").where("page_id % 3 = 0"))
    found = sorted(map(tuple, warc.archived_pages(pages.repartition(3)).collect()), key=str)
    assert found == expected([(p.page_id, p.html) for p in pages.collect()])


ROWS = [(1, "u", None), (2, "http://a/b c\r\nX: y", ""), (None, None, "é" * 70_000), (4, "v", "é" * 70_000), (4, "v", "é" * 70_000), (5, "w", "x")]


@pytest.mark.parametrize("least", [0, 1, 10**6])
def test_nulls_ties_long_payloads(spark, least):
    pages = spark.createDataFrame([(*r, 7) for r in ROWS], "page_id long, url string, html string, record_no int")
    found = warc.archived_pages(pages, revisit_from=least)
    assert sorted(map(tuple, found.collect()), key=str) == expected([(i, h) for i, _, h in ROWS], least)
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_chunks_and_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    chunks = warc.record_chunks(pages, chunk=1000)
    for r in chunks.collect():
        payload = ROWS_BYTES[r.n_bytes]
        assert r.data == payload[r.chunk_no * 1000 : r.chunk_no * 1000 + 1000]
        assert r.sha1 == hashlib.sha1(payload[: r.chunk_no * 1000 + 1000]).digest()
    folder = f"file://{tmp_path}/out"
    index = warc.write_archives(chunks, folder, revisit_from=1, archive_bytes=1)
    files = os.listdir(f"{tmp_path}/out")
    assert len(files) == index.count() == 6  # archives of one byte or more
    assert all(gzip.open(f"{tmp_path}/out/{f}").read().startswith(b"WARC/1.1\r\n") for f in files)
    rows = warc.read_archives(index, folder).collect()
    payloads = {}
    for r in sorted(rows, key=lambda r: (r.record_no, r.chunk_no)):
        payloads[r.record_no] = payloads.get(r.record_no, b"") + r.data
        assert r.payload_bytes == len(payloads[r.record_no]) and len(r.data) <= warc.CHUNK
    assert sorted(map(len, payloads.values())) == [0, 0, 0, 0, 1, 140_000]


ROWS_BYTES = {len((h or "").encode()): (h or "").encode() for _, _, h in ROWS}


def test_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "some words " * 200)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/out"
    index = warc.write_archives(warc.record_chunks(pages), folder)
    (name,) = os.listdir(f"{tmp_path}/out")
    raw = gzip.open(f"{tmp_path}/out/{name}").read().replace(b"some words", b"some wordz", 1)
    data = gzip.compress(raw)
    open(f"{tmp_path}/out/{name}", "wb").write(data)
    changed = index.selectExpr("file", "start", f"{len(data)}L AS length")
    with pytest.raises(Exception, match="another digest"):
        warc.read_archives(changed, folder).collect()
