"""As-of join plans against brute force; metadata operators on edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join
from tidemark.operators.meta import current_meta, resume_state, sync_at, sync_point


def _brute(probes, history):
    out = {}
    for pid, k, t in probes:
        best = None
        for hk, ht, seq, v in history:
            if k is not None and hk == k and ht is not None and t is not None and ht <= t:
                if best is None or (ht, seq) > (best[0], best[1]):
                    best = (ht, seq, v)
        out[pid] = None if best is None else best[2]
    return out


@pytest.mark.parametrize("num_partitions", [1, 7])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_matches_brute_force(spark, num_partitions, seed):
    rnd = random.Random(seed)
    keys = ["a", "b", "c", None]
    history = [(rnd.choice(keys), rnd.choice([None] + list(range(0, 200))), i, f"v{i}") for i in range(300)]
    probes = [(i, rnd.choice(keys), rnd.choice([None] + list(range(-5, 210)))) for i in range(120)]
    # a hot key: most history rows on one key
    history += [("a", rnd.randrange(0, 200), 1000 + i, f"h{i}") for i in range(300)]
    h = spark.createDataFrame(history, "k string, t long, seq long, v string")
    p = spark.createDataFrame(probes, "pid long, k string, pt long")
    got = {r.pid: r.v for r in asof_join(p, h, by=["k"], probe_time="pt", hist_time="t", values=["v"],
                                          tiebreak=["seq"], num_partitions=num_partitions).collect()}
    assert got == _brute(probes, history)


def test_asof_timestamps(spark):
    h = spark.createDataFrame([("a", "2024-01-01 00:00:00", "x"), ("a", "2024-01-02 00:00:00", "y")],
                              "k string, t string, v string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    p = spark.createDataFrame([(1, "a", "2024-01-01 12:00:00"), (2, "a", "2024-01-02 00:00:00"),
                               (3, "a", "2023-12-31 00:00:00")], "id int, k string, pt string") \
        .withColumn("pt", F.col("pt").cast("timestamp_ntz"))
    got = {r.id: r.v for r in asof_join(p, h, ["k"], "pt", "t", ["v"]).collect()}
    assert got == {1: "x", 2: "y", 3: None}


def test_current_meta_last_write_wins(spark):
    meta = spark.createDataFrame([
        ("a", "latest", "20240101", "2024-01-02 00:00:00", 1), ("a", "latest", "20240102", "2024-01-03 00:00:00", 2),
        ("a", "latest", "20240103", "2024-01-03 00:00:00", 3), ("b", "latest", "20240101", "2024-01-01 00:00:00", 1),
    ], "ds string, field string, value string, updated_at string, seq long")
    got = {r.ds: r.value for r in current_meta(meta, seq="seq").collect()}
    assert got == {"a": "20240103", "b": "20240101"}


def test_sync_point_names(spark):
    latest = spark.createDataFrame([("ASIA", "20240105"), ("EUROPE", "20240103")], "ds string, latest string")
    procs = spark.createDataFrame([("p1", "ASIA,EUROPE,,ASIA"), ("p2", "ASIA,MISSING"), ("p3", ",,"), ("p4", "ASIA")],
                                  "proc string, upstreams string")
    got = {r.proc: r.sync for r in sync_point(procs, latest).collect()}
    assert got == {"p1": "20240103", "p2": "", "p3": None, "p4": "20240105"}


def test_sync_at_with_missing_upstream(spark):
    hist = spark.createDataFrame([("u1", "20240101", 10), ("u1", "20240102", 20), ("u2", "20240101", 15)],
                                 "ds string, value string, updated_at long")
    probes = spark.createDataFrame([("p", 12), ("p", 16), ("p", 25), ("q", 25)], "proc string, probe_time long")
    ups = spark.createDataFrame([("p", "u1"), ("p", "u2"), ("q", "u1"), ("q", "u3")], "proc string, ds string")
    got = sorted(tuple(r) for r in sync_at(probes, hist, upstreams=ups).collect())
    assert got == [("p", 12, ""), ("p", 16, "20240101"), ("p", 25, "20240101"), ("q", 25, "")]
    twice = probes.unionByName(probes)  # repeated probes stay, with upstreams and without
    assert sync_at(twice, hist, upstreams=ups).count() == 8
    assert sync_at(twice, hist).count() == 8


def test_resume_state_cases(spark):
    procs = spark.createDataFrame([(p,) for p in ["fresh", "restart", "next", "bad", "nosync"]], "proc string")
    sync = spark.createDataFrame([("fresh", "20240228"), ("restart", "20240101"), ("nosync", None)],
                                 "proc string, sync string")
    commits = spark.createDataFrame([("restart", "20240110/0500/0"), ("next", "20240110/0500/1704067200000"),
                                     ("bad", "20240110/10000/5"), ("fresh", "")], "proc string, commit string")
    got = {r.proc: (r.trace, r.batch_num, r.commit_time, r.error) for r in resume_state(procs, sync, commits).collect()}
    assert got["fresh"] == ("20240229", 0, 0, None)
    assert got["restart"] == ("20240110", 0, 0, None)
    assert got["next"] == ("20240110", 6, 1704067200000, None)
    assert got["bad"][3] == "invalid commit point"
    assert got["nosync"][3] == "no date to trace"


@pytest.mark.parametrize("seed", [4, 5])
def test_asof_grid_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    keys = ["a", "b", None]
    history = [(rnd.choice(keys), rnd.choice([None] + list(range(0, 300))), i, f"v{i}") for i in range(400)]
    history += [("a", rnd.randrange(0, 300), 1000 + i, f"h{i}") for i in range(400)]  # a hot key
    probes = [(i, rnd.choice(keys), rnd.choice([None] + [17 * k for k in range(-1, 19)])) for i in range(150)]
    h = spark.createDataFrame(history, "k string, t long, seq long, v string")
    p = spark.createDataFrame(probes, "pid long, k string, pt long")
    got = {r.pid: r.v for r in asof_join(p, h, by=["k"], probe_time="pt", hist_time="t", values=["v"],
                                          grid=17, tiebreak=["seq"]).collect()}
    assert got == _brute(probes, history)


def test_asof_grid_rejects_off_grid_probe(spark):
    h = spark.createDataFrame([("a", 1, "x")], "k string, t long, v string")
    p = spark.createDataFrame([(1, "a", 5)], "pid long, k string, pt long")
    with pytest.raises(Exception, match="off the grid"):
        asof_join(p, h, ["k"], "pt", "t", ["v"], grid=17).collect()


def test_resume_from_ledger_handles_batch_100_and_more(spark):
    from tidemark.operators.meta import resume_from_ledger

    procs = spark.createDataFrame([("a",), ("b",)], "proc string")
    sync = spark.createDataFrame([("a", "20240101"), ("b", "20240105")], "proc string, sync string")
    ledger = spark.createDataFrame([("a", "20240103", 149, 1000), ("a", "20240103", 150, 2000),
                                    ("a", "20240102", 3, 500)],
                                   "proc string, date string, batch int, batch_time long")
    got = {r.proc: (r.trace, r.batch_num, r.commit_time, r.error)
           for r in resume_from_ledger(procs, sync, ledger).collect()}
    assert got == {"a": ("20240103", 151, 2000, None), "b": ("20240106", 0, 0, None)}


def _random_sync(spark, names):
    import random

    rnd = random.Random(7)
    proc = [f"p{i}" for i in range(5)] + ["none", None]
    probes = spark.createDataFrame([(rnd.randrange(60), rnd.choice(proc), rnd.choice([None, *range(50)])) for _ in range(300)],
                                   "id long, proc string, probe_time long")
    hist = spark.createDataFrame([(rnd.choice([*names, "other", None]), rnd.choice([None, "", *"abcdeé" * 4]),
                                   rnd.choice([None, *range(45)]), i) for i in range(400)],
                                 "ds string, value string, updated_at long, seq long")
    ups = spark.createDataFrame([(rnd.choice([*proc[:5], None]), rnd.choice([*names * 6, "never", None])) for _ in range(14)]
                                + [("p4", None)], "proc string, ds string")
    return probes, hist, ups


def test_sync_at_by_name_equals_a_row_per_upstream(spark, monkeypatch):
    from collections import Counter

    from tidemark.operators import meta

    for names in (["x", "y", "z"], ["x"]):
        probes, hist, ups = _random_sync(spark, names)
        run = lambda: Counter(map(tuple, sync_at(probes, hist, upstreams=ups, tiebreak=["seq"]).collect()))  # noqa: B023, E731
        monkeypatch.setattr(meta, "NAMES", 32)
        by_name = run()
        monkeypatch.setattr(meta, "NAMES", 0)
        assert by_name == run() and sum(by_name.values()) == 300
        assert len({r[3] for r in by_name}) > 3


def test_sync_at_does_not_copy_a_probe_for_each_upstream(spark, monkeypatch):
    from tidemark.operators import asof

    written, write = [], asof.materialize

    def counted(df, name):
        out = write(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(asof, "materialize", counted)
    probes = spark.createDataFrame([(i, "p", i) for i in range(100)], "id long, proc string, probe_time long")
    hist = spark.createDataFrame([(f"d{i % 8}", str(i), i, i) for i in range(40)], "ds string, value string, updated_at long, seq long")
    ups = spark.createDataFrame([("p", f"d{i}") for i in range(8)], "proc string, ds string")
    got = {r.id: r.sync for r in sync_at(probes, hist, upstreams=ups, tiebreak=["seq"]).collect()}
    assert sum(written) <= 140
    assert got == {t: "" if t < 7 else min(str(max(i for i in range(d, 40, 8) if i <= t)) for d in range(8)) for t in range(100)}
