"""Column functions on hand-made edge rows."""

import hashlib

from pyspark.sql import functions as F

from tidemark.functions import columns as C


def _one(spark, expr, rows, schema="c string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_parse_commit_edges(spark):
    rows = [("20240101/0000/0",), ("20240101/0300/1704067200000",), ("20240101/10000/5",),
            ("20240101/0300/",), ("",), (None,), ("20240101/0300/00",), ("x20240101/0300/1",)]
    got = [r.asDict() for r in spark.createDataFrame(rows, "c string")
           .select(C.parse_commit("c").alias("p")).select("p.*").collect()]
    assert got[0] == {"commit_date": "20240101", "commit_batch": 0, "commit_ms": 0, "next_batch": 0, "valid": True}
    assert got[1] == {"commit_date": "20240101", "commit_batch": 3, "commit_ms": 1704067200000,
                      "next_batch": 4, "valid": True}
    for i in (2, 3, 4, 7):  # batch 100 unreadable, empty ms, empty text, trailing garbage
        assert got[i]["valid"] is False and got[i]["commit_date"] is None
    assert got[5]["valid"] is False and got[5]["commit_date"] is None  # null: no commit point
    # "00" is not the restart marker: a normal commit at time 0
    assert got[6] == {"commit_date": "20240101", "commit_batch": 3, "commit_ms": 0, "next_batch": 4, "valid": True}


def test_next_day_edges(spark):
    rows = [("20240228",), ("20241231",), ("20240230",), ("20240101/0300",), ("",), (None,)]
    assert _one(spark, C.next_day("c"), rows) == ["20240229", "20250101", None, "20240102", None, None]


def test_batch_folder_and_paths(spark):
    got = _one(spark, C.batch_folder("c"), [(0,), (3,), (12,), (100,), (1000,), (None,)], "c int")
    assert got == ["0000", "0300", "1200", "10000", "1,00000", None]
    from tidemark.operators.batches import batch_dir
    assert [batch_dir("d", b) for b in (0, 3, 12, 100, 1000)] == ["d/0000", "d/0300", "d/1200", "d/10000", "d/1,00000"]
    row = spark.createDataFrame([("20240101", 3, 99)], "d string, b int, t long").select(
        C.batch_path("d", "b").alias("p"), C.commit_point("d", "b", "t").alias("c")).first()
    assert (row.p, row.c) == ("20240101/0300", "20240101/0300/99")


def _ref_sign(s: str) -> int:
    return int(hashlib.md5(s.encode("utf-8")).hexdigest()[:16], 16)


def test_sign64_and_hash_partition_unsigned(spark):
    keys = ["", "a", "é", "\U0001F600", "x/y", "12345", None] + [str(i) for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "c string")
    cols = [C.sign64("c").alias("s")] + [C.hash_partition("c", n).alias(f"p{n}") for n in (1, 7, 8, 12, 1000003)]
    for k, r in zip(keys, df.select(*cols).collect()):
        if k is None:
            assert r.s is None and r.p7 is None
            continue
        u = _ref_sign(k)
        assert r.s == str(u)
        for n in (1, 7, 8, 12, 1000003):
            assert r[f"p{n}"] == u % n, (k, n)


def test_sign64_xxhash_is_unsigned_text(spark):
    r = spark.createDataFrame([("a",), (None,)], "c string").select(
        C.sign64("c", "xxhash64").alias("u"), C.sign64_signed("c", "xxhash64").alias("s")).collect()
    assert int(r[0].u) == r[0].s % (1 << 64) and r[1].u is None


def test_partition_for_modes(spark):
    df = spark.createDataFrame([("k",)], "key string")
    r = df.select(C.partition_for("random").alias("a"), C.partition_for("5").alias("b"),
                  C.partition_for(-2).alias("c"), C.partition_for("hash", "key", 4).alias("d")).first()
    assert r.a is None and r.b == 5 and r.c is None and r.d == _ref_sign("k") % 4


def test_record_value_replaces_invalid_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"\xffA"),), (bytearray("ok".encode()),)], "value binary")
    assert [r.value for r in C.record_value(df).collect()] == ["�A", "ok"]


def test_batch_outcome_order(spark):
    rows = [  # notified, batch_time, commit_time, n, sync, trace, failed
        (True, 10, 0, 0, "20240102", "20240101", 1),
        (False, 5, 5, 0, "20240102", "20240101", 0),
        (False, 10, 5, 0, "20240101", "20240101", 1),
        (False, 10, 5, 0, "20231231", "20240101", 0),
        (False, 10, 5, 3, "20240102", "20240101", 0),
        (False, 10, 5, 3, "20240102", "20240101", 2),
        (False, 10, 5, 0, None, "20240101", 0),
    ]
    df = spark.createDataFrame(rows, "nt boolean, bt long, ct long, n long, sync string, trace string, failed int")
    got = [r[0] for r in df.select(C.batch_outcome("nt", "bt", "ct", "n", "sync", "trace", "failed")).collect()]
    assert got == ["ignored", "redo", "switch", "commit", "commit", "abort", "commit"]
