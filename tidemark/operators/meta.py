"""Dataset metadata as an append-only table ``meta(ds, field, value, updated_at)``.

* :func:`current_meta` -- current value of each field, last write wins (AGG-6)
* :func:`sync_point`   -- minimum ``latest`` over a processor's upstream names (AGG-1)
* :func:`sync_at`      -- the same minimum, as of each probe time, from the metadata history (JON-2)
* :func:`resume_state` -- where a processor starts: traced date, next batch, last commit time (JON-3)

An upstream without a ``latest`` counts as the empty string, which is below every date, so one
missing upstream holds back the sync point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import next_day, parse_commit
from tidemark.operators.asof import asof_by_name, asof_join
from tidemark.operators.enrich import enrich

MISSING = ""
NAMES = 32  # upstream names that are looked up at once; with more, a probe is a row per upstream


def current_meta(meta: DataFrame, keys: tuple[str, ...] = ("ds", "field"), value: str = "value",
                 updated_at: str = "updated_at", seq: str | None = None) -> DataFrame:
    """``(keys..., value, updated_at)`` with the value of the latest write per key; ties on
    ``updated_at`` are broken by ``seq`` when given. ``max_by`` is partially aggregated map-side,
    so a hot dataset costs one row per map task in the shuffle."""
    order = F.struct(F.col(updated_at), F.col(seq)) if seq else F.col(updated_at)
    return meta.groupBy(*keys).agg(F.max_by(F.col(value), order).alias(value),
                                   F.max(updated_at).alias(updated_at))


def upstream_names(c: Column | str) -> Column:
    """Non-empty names of a comma list (``split`` keeps empty strings, which mean nothing here)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(col, ","), lambda x: x != F.lit(""))


def sync_point(processors: DataFrame, latest: DataFrame, proc: str = "proc", upstreams: str = "upstreams",
               ds: str = "ds", value: str = "latest") -> DataFrame:
    """``(proc, sync)``: minimum ``latest`` over the processor's non-empty upstream names; a
    missing upstream counts as ``''``; a processor with no upstream name gets null (not ready)."""
    names = processors.select(F.col(proc).alias("proc"),
                              F.explode_outer(upstream_names(upstreams)).alias("_ds"))
    lat = latest.select(F.col(ds).alias("_ds"), F.col(value).alias("_latest"))
    joined = enrich(names, lat, on="_ds", how="left")
    seen = F.when(F.col("_ds").isNull(), F.lit(None)).otherwise(F.coalesce("_latest", F.lit(MISSING)))
    return joined.groupBy("proc").agg(F.min(seen).alias("sync"))


def sync_at(probes: DataFrame, history: DataFrame, proc: str = "proc", probe_time: str = "probe_time",
            upstreams: DataFrame | None = None, ds: str = "ds", value: str = "value",
            updated_at: str = "updated_at", grid_us: int | None = None,
            tiebreak: list[str] | None = None) -> DataFrame:
    """Probe columns plus ``sync``: for every probe ``(proc, probe_time)``, the minimum over the
    processor's upstreams of the upstream's latest ``value`` written at or before ``probe_time``.

    ``upstreams(proc, ds)`` lists each processor's upstreams; without it a processor's only upstream
    is the dataset of the same name. History rows ``(ds, value, updated_at)``. ``grid_us``: all probe
    times are multiples of it (see :func:`tidemark.operators.asof.asof_join`). Repeated probes stay.

    With at most ``NAMES`` distinct upstream names (and no grid) a probe stays one row, whatever the number of its
    upstreams; with more it is copied for each of them and regrouped.
    """
    pcols = probes.columns
    if upstreams is not None and not grid_us:
        names = [r[0] for r in upstreams.select(ds).where(F.col(ds).isNotNull()).distinct().limit(NAMES + 1).collect()]
        if 0 < len(names) <= NAMES:
            return _sync_by_name(probes, history, sorted(names), proc, probe_time, upstreams, ds, value, updated_at, tiebreak)
    if upstreams is None:
        fan = probes.withColumn("_ds", F.col(proc))
    else:
        # a number per probe row, so that equal probes are regrouped apart
        fan = enrich(probes.withColumn("_row", F.monotonically_increasing_id()), upstreams.select(F.col(proc).alias(proc), F.col(ds).alias("_ds")), on=proc, how="left")
    hist = history.select(F.col(ds).alias("_ds"), F.col(value).alias("_v"), F.col(updated_at).alias("_u"),
                          *[F.col(c) for c in (tiebreak or [])])
    matched = asof_join(fan, hist, by=["_ds"], probe_time=probe_time, hist_time="_u", values=["_v"],
                        grid=grid_us, tiebreak=tiebreak)
    seen = F.when(F.col("_ds").isNull(), F.lit(None)).otherwise(F.coalesce("_v", F.lit(MISSING)))
    if upstreams is None:
        # one upstream per probe: no regrouping needed
        return matched.select(*pcols, seen.alias("sync"))
    return matched.groupBy("_row", *pcols).agg(F.min(seen).alias("sync")).drop("_row")


def _sync_by_name(probes, history, names, proc, probe_time, upstreams, ds, value, updated_at, tiebreak):
    """``sync_at`` where the upstreams have few names: which of them a processor has is a bit mask."""
    bit = F.coalesce(*[F.when(F.col(ds) == F.lit(n), F.lit(1 << i)) for i, n in enumerate(names)]).cast("long")
    asked = upstreams.select(F.col(proc).alias(proc), bit.alias("_b")).where("_b is not null") \
        .groupBy(proc).agg(F.bit_or("_b").alias("_names"))
    matched = asof_by_name(enrich(probes, asked, on=proc, how="left").select(*probes.columns, "_names"), history, names, ds,
                           probe_time, updated_at, value, tiebreak)
    seen = [F.when(F.getbit("_names", F.lit(i)) == 1, F.coalesce(f"_v{i}", F.lit(MISSING))) for i in range(len(names))]
    return matched.select(*probes.columns, (F.least(*seen) if len(seen) > 1 else seen[0]).alias("sync"))


def resume_state(processors: DataFrame, sync: DataFrame, commits: DataFrame, proc: str = "proc",
                 commit: str = "commit") -> DataFrame:
    """Start state of each processor: ``(proc, trace, batch_num, commit_time, error)``.

    No commit point (null or empty): trace the day after the upstream sync point, batch 0. A commit
    point ``{date}/{bb}00/{ms}``: trace that date at batch ``bb + 1`` with commit time ``ms``, or
    batch 0 and time 0 when ``ms`` is ``0``. An unreadable commit point or no date to trace sets
    ``error`` (the reference refuses to start).
    """
    base = (processors.select(proc).distinct()
            .join(sync.select(proc, "sync"), on=proc, how="left")
            .join(commits.select(proc, F.col(commit).alias("_commit")), on=proc, how="left"))
    fresh = F.coalesce(F.col("_commit"), F.lit("")) == F.lit("")
    parsed = base.withColumn("_p", parse_commit("_commit"))
    trace = F.when(fresh, next_day("sync")).otherwise(F.col("_p.commit_date"))
    batch_num = F.when(fresh, F.lit(0)).otherwise(F.col("_p.next_batch"))
    commit_time = F.when(fresh, F.lit(0).cast("bigint")).otherwise(F.col("_p.commit_ms"))
    error = (F.when(~fresh & ~F.coalesce(F.col("_p.valid"), F.lit(False)), F.lit("invalid commit point"))
             .when(F.coalesce(trace, F.lit("")) == "", F.lit("no date to trace")))
    return parsed.select(F.col(proc).alias("proc"), trace.alias("trace"), batch_num.cast("int").alias("batch_num"),
                         commit_time.alias("commit_time"), error.alias("error"))


def resume_from_ledger(processors: DataFrame, sync: DataFrame, ledger: DataFrame, proc: str = "proc") -> DataFrame:
    """Start state from the ledger's integer columns instead of commit-point text, so a day with
    batch 100 or more restarts correctly (its commit text ``{date}/10000/...`` cannot be parsed):
    the last published batch of each processor (by date and batch, not by the clock) gives ``trace = date``,
    ``batch_num = batch + 1``, ``commit_time = batch_time``; a processor without one starts the day
    after its sync point. One partially aggregated ``groupBy`` over the ledger."""
    last = ledger.groupBy(F.col(proc).alias("proc")).agg(
        F.max(F.struct("date", "batch", "batch_time")).alias("_last"))
    base = (processors.select(F.col(proc).alias("proc")).distinct()
            .join(sync.select(F.col(proc).alias("proc"), "sync"), on="proc", how="left")
            .join(last, on="proc", how="left"))
    fresh = F.col("_last").isNull()
    trace = F.when(fresh, next_day("sync")).otherwise(F.col("_last.date"))
    return base.select(
        "proc", trace.alias("trace"),
        F.when(fresh, F.lit(0)).otherwise(F.col("_last.batch") + 1).cast("int").alias("batch_num"),
        F.when(fresh, F.lit(0)).otherwise(F.col("_last.batch_time")).cast("bigint").alias("commit_time"),
        F.when(F.coalesce(trace, F.lit("")) == "", F.lit("no date to trace")).alias("error"),
    )
