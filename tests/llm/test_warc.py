import gzip
import hashlib
from collections import Counter

import pytest

from tidemark.llm.shards import commit, store
from tidemark.llm.warc import read_warc, shard_bounds, write_warc
from tidemark.session import scratch_dir


def _pages(spark):
    big, other = "<p>" + "x" * 1500, "é" * 700
    rows = [(1, "http://a", big), (2, "http://b", big), (9, "http://c\r\nX: y", big), (3, None, "small"), (4, "http://d", "small"),
            (5, "http://e", None), (6, "http://f", ""), (7, "http://g", other), (8, "http://h", other), (None, "http://i", big),
            (None, "http://j", None), (None, "http://k", "z" * 2000), (None, "http://l", "z" * 2000), (3, "http://m", "again"),
            (10, "http://n", "y" * 50_000), (7, "http://g", other)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def _expect(rows):
    body = lambda r: (r.html or "").encode()
    out = Counter()
    for r in rows:
        same = [x.page_id for x in rows if body(x) == body(r) and x.page_id is not None]
        target = max(same, default=None)
        revisit = len(body(r)) >= 1000 and sum(body(x) == body(r) for x in rows) > 1 and target is not None and r.page_id != target
        out[(r.page_id, len(body(r)), hashlib.sha1(body(r)).hexdigest(), "revisit" if revisit else "response",
             target if revisit else None)] += 1
    return out


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 3000, "file_bytes": 300}])
def test_round_trip(spark, sizes):
    pages, root = _pages(spark), scratch_dir(spark, "test-warc")
    rows = read_warc(spark, write_warc(pages, root, **sizes), root).collect()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    assert got == _expect(pages.collect())
    payloads = {(r.page_id, r.html or "") for r in pages.collect()}
    assert all((r.page_id, bytes(r.payload).decode()) in payloads for r in rows if r.record_type == "response")


def test_files_depend_on_the_rows_alone(spark):
    pages = _pages(spark)
    seen = []
    for df in (pages, pages.repartition(7), pages.orderBy("url")):
        root = scratch_dir(spark, "test-warc")
        manifest = write_warc(df, root, shard_bytes=3000, file_bytes=300)
        fs, base = store(root)
        seen.append({r["name"]: fs.open_input_file(f"{base}/{r['name']}").read() for r in manifest.collect()})
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 3
    for data in seen[0].values():  # ordinary gzip files of WARC records
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_shards_hold_about_equal_bytes_wherever_the_ids_lie(spark):
    ids = [*range(0, 300), 10**15, *range(-(2**62), -(2**62) + 50), 2**62]
    pages = spark.createDataFrame([(i, None, "p" * 488) for i in ids], "page_id long, url string, html string")
    manifest = write_warc(pages, scratch_dir(spark, "test-warc"), shard_bytes=20_000)
    records = [r["records"] for r in manifest.collect()]
    assert sum(records) == len(ids) and max(records) <= 20 and len(records) == -(-len(ids) // 20)
    bounds = shard_bounds(spark.createDataFrame([(i, 488) for i in ids], "id long, bytes long").repartition(9), 20_000)
    assert bounds.tolist() == sorted(ids)[::20]


def test_commit_may_be_repeated_and_notices_loss(spark):
    root = scratch_dir(spark, "test-warc")
    manifest = write_warc(_pages(spark), root)
    rows = spark.createDataFrame(manifest.collect(), manifest.schema)
    assert commit(spark, rows, root).count() == len(rows.collect())
    fs, base = store(root)
    fs.delete_file(f"{base}/{rows.first()['name']}")
    with pytest.raises(Exception, match="neither it nor its temporary file"):
        commit(spark, rows, root)


def test_empty(spark):
    root = scratch_dir(spark, "test-warc")
    manifest = write_warc(_pages(spark).where("false"), root)
    assert manifest.count() == 0 and read_warc(spark, manifest, root).count() == 0
