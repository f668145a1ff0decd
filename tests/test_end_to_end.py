"""The README's usage: a processor over dated folders, upstream progress from the meta table."""

from tidemark.operators.meta import current_meta, sync_point
from tidemark.plans import fixtures as fx
from tidemark.sinks.batches import read_ledger
from tidemark.sources.committed import read_committed
from tidemark.sources.topics import read_dated_topics, write_dated_folders
from tidemark.streaming.algorithm import Algorithm
from tidemark.streaming.runner import run_days


class _Values(Algorithm):
    name, resource, result = "values", "click,view", "values_result"

    def transform(self, date, df):
        return df.selectExpr("make_valid_utf8(cast(value as string)) AS value")


def test_days_follow_upstream_progress(spark, tmp_dir):
    meta, out, ledger, ckpt, topics = (f"{tmp_dir}/{n}" for n in ("meta", "out", "ledger", "ckpt", "topics"))
    ev = fx.table(spark, "/root/testdata/sf0.001", "events").where("ts < '2024-01-04'")
    write_dated_folders(fx.stream_records(ev), topics)
    fx.meta_history(ev).write.parquet(meta)

    def sync():
        latest = (current_meta(spark.read.parquet(meta)).where("field = 'latest'")
                  .selectExpr("ds", "value AS latest"))
        procs = spark.createDataFrame([("values", _Values.resource)], "proc string, upstreams string")
        return sync_point(procs, latest).first()["sync"]

    source = lambda date: read_dated_topics(spark, ["click", "view"], date, root=topics)
    runs = run_days(spark, _Values(), "20240101", source, sync, out, ledger, ckpt)
    # upstreams finished 01-01 and 01-02 (their last records are on 01-03): 01-03 is processed and waited on
    assert sync() == "20240102"
    assert [r.date for r in runs] == ["20240101", "20240102", "20240103", "20240103"]
    published = read_committed(spark, out, read_ledger(spark, ledger), proc="values_result")
    assert published.count() == ev.where("event_type in ('click', 'view')").count()


def test_processor_resumes_from_its_ledger(spark, tmp_dir):
    from tidemark.streaming.processor import run_processor, start_date

    out, ledger, ckpt, topics = (f"{tmp_dir}/{n}" for n in ("out", "ledger", "ckpt", "topics"))
    ev = fx.table(spark, "/root/testdata/sf0.001", "events").where("ts < '2024-01-04'")
    write_dated_folders(fx.stream_records(ev), topics)
    datasets = spark.createDataFrame([("click", "click"), ("view", "view"), ("error", "error")], "ds string, topics string")
    source = lambda t, date: read_dated_topics(spark, t, date, root=topics)
    latest = {"now": "20231231"}
    read = lambda: spark.createDataFrame([("click", latest["now"]), ("view", "20240105")], "ds string, latest string")
    first = run_processor(spark, _Values(), read, datasets, source, out, ledger, ckpt)
    assert [r.date for r in first] == ["20240101", "20240101"] and not first[-1].finished
    latest["now"] = "20240102"  # upstream moves on: the processor goes on with the date of its last batch
    assert start_date(spark, _Values(), read(), ledger) == "20240101"
    runs = run_processor(spark, _Values(), read, datasets, source, out, ledger, ckpt)
    assert [(r.date, r.finished) for r in runs] == [("20240101", True), ("20240102", True), ("20240103", False),
                                                    ("20240103", False)]
    published = read_committed(spark, out, read_ledger(spark, ledger), proc="values_result")
    assert published.count() == ev.where("event_type in ('click', 'view')").count()
