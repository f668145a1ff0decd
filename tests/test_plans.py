"""Physical-plan properties the scale design relies on (checked with the executed plan)."""

from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join
from tidemark.operators.batches import HOUR_US, batch_counts
from tidemark.operators.enrich import enrich
from tidemark.operators.resume import sequence_numbers
from tidemark.plans import fixtures as fx
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.collect()  # run, so the adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df, table: str) -> int:
    return sum(f.endswith(f"/{table}.parquet") for f in df.inputFiles())


def test_scan_prunes_columns(spark):
    plan = _plan(QUERIES["current_meta"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_batch_log_reads_the_events_once(spark):
    ev = fx.table(spark, SF, "events")
    assert _scans(ev.groupBy("event_type").count(), "events") == 1  # a scan shows in the plan
    hourly = fx.per_batch(ev)  # the one pass, written down
    assert _scans(fx.batch_log(ev, hourly=hourly), "events") == 0
    assert _scans(fx.start_state(ev, hourly=hourly), "events") == 0
    log, start = fx.replay_inputs(ev)
    assert _scans(log, "events") == 0 and _scans(start, "events") == 0


def test_asof_needs_no_broadcast_and_no_lists(spark):
    ev = fx.table(spark, SF, "events")
    probes = ev.where("event_type = 'purchase'").select("event_id", F.col("event_type").alias("k"), "ts")
    hist = ev.select(F.col("event_type").alias("k"), F.col("ts").alias("t"), "value")
    plan = _plan(asof_join(probes, hist, ["k"], "ts", "t", ["value"]))
    assert "collect_list" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_enrich_lets_spark_choose(spark):
    # a plain join: no count, no write, no hint
    big, small = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    logical = enrich(big, small, on="k")._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in logical and "UnresolvedHint" not in logical


def test_sequence_numbers_read_one_table(spark):
    ev = fx.table(spark, SF, "events")
    assert _scans(sequence_numbers(ev, "event_type", "ts", ["event_id"]), "events") == 0


def test_batch_counts_read_the_events_once(spark):
    ev = fx.table(spark, SF, "events")
    assert _scans(batch_counts(ev.select("event_type", "ts"), "event_type", "ts", HOUR_US), "events") == 0
