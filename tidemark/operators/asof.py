"""As-of join: for each probe row, the values of the latest history row with the same key and a
time at or before the probe's time (null when there is none).

Spark has no as-of join, and a range join ``history.t <= probe.t`` followed by ``max_by`` emits all
pairs. Nothing here is broadcast by hand or collected into arrays. Two plans:

* **range** (any probes): probes and history are unioned and range-partitioned on (key, time), so a hot
  key, and a hot hour of it, is spread over as many partitions as its size needs. The partitioned rows
  are written once to the shared checkpoint folder. Inside a partition a running ``last`` answers every
  probe that has history before it there; the others take the last value of an earlier partition of the
  same key, from a table with one row per (partition, key).
* **grid** (probes on batch ends): each history row is mapped to the first grid point at or after it,
  history is partially aggregated to one row per (key, grid point), and a running ``last`` per key over
  those rows and the probes (rows per key bounded by the time span) answers every probe -- one pass over
  history, nothing written.

:func:`asof_by_name` answers a probe for several keys at once, where these are few: it is the range plan
with partitions of time alone, in which a probe is one row whatever the number of its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import epoch_micros_sql, ident
from tidemark.session import materialize


def _time_sql(df: DataFrame, name: str) -> str:
    dt = df.schema[name].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return epoch_micros_sql(name, dt)
    return f"CAST({ident(name)} AS BIGINT)"


def asof_join(probes: DataFrame, history: DataFrame, by: list[str], probe_time: str, hist_time: str,
              values: list[str], grid: int | None = None, tiebreak: list[str] | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Probe columns plus ``values`` from the as-of match.

    Times may be timestamps (compared as epoch microseconds) or numbers. ``tiebreak`` orders history
    rows with equal times. ``grid``: every probe time is a multiple of it (e.g. batch ends, checked in
    the plan), which allows the grid plan.
    """
    clash = set(values) & set(probes.columns)
    if clash:
        raise ValueError(f"value columns also in probes: {sorted(clash)}")
    if grid:
        return _asof_grid(probes, history, by, probe_time, hist_time, values, grid, tiebreak or [])
    return _asof_range(probes, history, by, probe_time, hist_time, values, tiebreak or [], num_partitions)


def _sql_struct(names: list[str]) -> str:
    return "struct(" + ", ".join(ident(n) for n in names) + ")"


def _asof_range(probes, history, by, probe_time, hist_time, values, tiebreak, num_partitions):
    probe_cols = probes.columns
    keys = [f"_k{i}" for i in range(len(by))]
    tb = [f"_tb{i}" for i in range(len(tiebreak))]
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    p = probes.selectExpr(f"{_sql_struct(probe_cols)} AS _probe", *[f"{ident(k)} AS _k{i}" for i, k in enumerate(by)],
                          f"{_time_sql(probes, probe_time)} AS _t")
    h = history.selectExpr(*[f"{ident(k)} AS _k{i}" for i, k in enumerate(by)],
                           f"{_time_sql(history, hist_time)} AS _t", f"{_sql_struct(values)} AS _val",
                           *[f"{ident(c)} AS _tb{i}" for i, c in enumerate(tiebreak)])
    h = h.where(f"_t IS NOT NULL AND {present}")
    val_type, probe_type = (d.schema[c].dataType.simpleString() for d, c in ((h, "_val"), (p, "_probe")))
    tb_types = {c: h.schema[c].dataType.simpleString() for c in tb}
    rows = h.selectExpr(*keys, "_t", "0 AS _kind", *tb, "_val", f"CAST(NULL AS {probe_type}) AS _probe").unionByName(
        p.selectExpr(*keys, "_t", "1 AS _kind", *[f"CAST(NULL AS {tb_types[c]}) AS {c}" for c in tb],
                     f"CAST(NULL AS {val_type}) AS _val", "_probe"))
    n = num_partitions or int(probes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the rows' partitions are drawn once: both uses below read the written table
    order = [*keys, "_t", "_kind", *tb]
    ranged = materialize(rows.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "asof-rows")
    inside = Window.partitionBy("_pid", *keys).orderBy("_t", "_kind", *tb) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranged.withColumn("_own", F.last("_val", ignorenulls=True).over(inside)).where("_kind = 1")
    # partitions follow the order of (key, time): what a partition ends with is carried into the next ones
    tails = ranged.groupBy("_pid", *keys).agg(
        F.expr(f"max_by(_val, struct(_t{''.join(', ' + c for c in tb)})) FILTER (WHERE _kind = 0)").alias("_tail"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("_carry", F.last("_tail", ignorenulls=True).over(earlier)) \
        .where("_carry IS NOT NULL").select("_pid", *keys, "_carry")
    out = seen.join(carried, on=["_pid", *keys], how="left")
    return out.selectExpr(
        *[f"_probe.{ident(c)} AS {ident(c)}" for c in probe_cols],
        *[f"CASE WHEN _t IS NULL THEN NULL ELSE coalesce(_own, _carry).{ident(v)} END AS {ident(v)}" for v in values])


def asof_by_name(probes: DataFrame, history: DataFrame, names: list, by: str, probe_time: str, hist_time: str,
                 value: str, tiebreak: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Probe columns plus ``_v0, _v1, ...``: the value of the latest history row of each name in ``names`` (values of the
    history's column ``by``) at or before the probe's time, null when there is none.

    Probes and history are range-partitioned on time, once for all names; running ``last`` values per name answer
    the probes, and what a partition lacks comes from the ends of the earlier ones, one row per partition.
    """
    probe_cols, tiebreak = probes.columns, tiebreak or []
    tb = [f"_tb{i}" for i in range(len(tiebreak))]
    number = F.coalesce(*[F.when(F.col(by) == F.lit(n), F.lit(i)) for i, n in enumerate(names)])
    p = probes.selectExpr(f"{_sql_struct(probe_cols)} AS _probe", f"{_time_sql(probes, probe_time)} AS _t")
    h = history.withColumn("_name", number).selectExpr(
        "_name", f"{_time_sql(history, hist_time)} AS _t", f"{_sql_struct([value])} AS _val",
        *[f"{ident(c)} AS _tb{i}" for i, c in enumerate(tiebreak)]).where("_t IS NOT NULL AND _name IS NOT NULL")
    val_type, probe_type = (d.schema[c].dataType.simpleString() for d, c in ((h, "_val"), (p, "_probe")))
    tb_types = {c: h.schema[c].dataType.simpleString() for c in tb}
    rows = h.selectExpr("_t", "0 AS _kind", *tb, "_name", "_val", f"CAST(NULL AS {probe_type}) AS _probe").unionByName(
        p.selectExpr("_t", "1 AS _kind", *[f"CAST(NULL AS {tb_types[c]}) AS {c}" for c in tb], "CAST(NULL AS INT) AS _name",
                     f"CAST(NULL AS {val_type}) AS _val", "_probe"))
    n = num_partitions or int(probes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # drawn once, as in the other range plan
    ranged = materialize(rows.repartitionByRange(n, "_t", "_kind", *tb).withColumn("_pid", F.spark_partition_id()), "asof-rows")
    inside = Window.partitionBy("_pid").orderBy("_t", "_kind", *tb).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranged.select("*", *[F.last(F.when(F.col("_name") == i, F.col("_val")), ignorenulls=True).over(inside).alias(f"_own{i}")
                                for i in range(len(names))]).where("_kind = 1")
    tails = ranged.groupBy("_pid").agg(*[
        F.expr(f"max_by(_val, struct(_t{''.join(', ' + c for c in tb)})) FILTER (WHERE _name = {i})").alias(f"_tail{i}")
        for i in range(len(names))])
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    carried = tails.select("_pid", *[F.last(f"_tail{i}", ignorenulls=True).over(earlier).alias(f"_carry{i}")
                                     for i in range(len(names))])
    out = seen.join(carried, on="_pid", how="left")
    return out.selectExpr(
        *[f"_probe.{ident(c)} AS {ident(c)}" for c in probe_cols],
        *[f"CASE WHEN _t IS NULL THEN NULL ELSE coalesce(_own{i}, _carry{i}).{ident(value)} END AS _v{i}"
          for i in range(len(names))])


def _asof_grid(probes, history, by, probe_time, hist_time, values, width, tiebreak):
    probe_cols = probes.columns
    keys = [f"_k{i}" for i in range(len(by))]
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    tb = [f"_tb{i}" for i in range(len(tiebreak))]
    w = int(width)
    p = probes.selectExpr(f"{_sql_struct(probe_cols)} AS _probe",
                          *[f"{ident(k)} AS _k{i}" for i, k in enumerate(by)],
                          f"{_time_sql(probes, probe_time)} AS _e")
    # a probe off the grid would silently miss rows: fail the task instead
    p = p.selectExpr("*", f"assert_true(_e IS NULL OR pmod(_e, {w}) = 0, 'as-of probe time off the grid') AS _ok")
    h = history.selectExpr(*[f"{ident(k)} AS _k{i}" for i, k in enumerate(by)],
                           f"{_time_sql(history, hist_time)} AS _t",
                           *[ident(v) for v in values], *[f"{ident(c)} AS _tb{i}" for i, c in enumerate(tiebreak)])
    # the first grid point at or after the row is the earliest probe that sees it
    h = h.where(f"_t IS NOT NULL AND {present}").selectExpr("*", f"_t + pmod(-_t, {w}) AS _e")
    points = h.groupBy(*keys, "_e").agg(
        F.expr(f"max_by({_sql_struct(values)}, struct(_t{''.join(', ' + c for c in tb)}))").alias("_val"))
    probe_type = p.schema["_probe"].dataType.simpleString()
    val_type = points.schema["_val"].dataType.simpleString()
    rows = points.selectExpr(*keys, "_e", "0 AS _kind", "_val", f"CAST(NULL AS {probe_type}) AS _probe",
                             "NULL AS _ok").unionByName(
        p.selectExpr(*keys, "_e", "1 AS _kind", f"CAST(NULL AS {val_type}) AS _val", "_probe", "_ok"))
    win = (Window.partitionBy(*keys).orderBy("_e", "_kind")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.withColumn("_seen", F.last("_val", ignorenulls=True).over(win)).where("_kind = 1")
    return out.selectExpr(
        *[f"_probe.{ident(c)} AS {ident(c)}" for c in probe_cols],
        *[f"CASE WHEN _e IS NULL OR NOT ({present}) OR _ok IS NOT NULL THEN NULL ELSE _seen.{ident(v)} END"
          f" AS {ident(v)}" for v in values])
