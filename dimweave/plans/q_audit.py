"""Registered queries: audits, stage-audit-publish and the load log."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimweave.operators import audit as au
from dimweave.operators import changes as ch
from dimweave.plans.params import DROPPED_BOROUGH, EXPECTED_BOROUGHS
from dimweave.plans.q_cleaning import _T
from dimweave.plans.registry import query
from dimweave.session import scratch_path
from dimweave.sources import fixtures as fx

_EXPECTED_SQL = ", ".join(f"('{b}')" for b in EXPECTED_BOROUGHS)
KEEP_LAST = 2
AS_OF_LOAD = 3
FIRST_BATCH_UPTO = 1997


def _expected(spark):
    # The audit's expected set is a parameter of the check (a handful of values).
    return spark.createDataFrame([(b,) for b in EXPECTED_BOROUGHS], "borough string")


def _staged(spark, sf_dir):
    return ch.delete_where(fx.permits(spark, sf_dir), F.col("borough") == DROPPED_BOROUGH)


@query("distinct_values", "SELECT DISTINCT borough FROM fx_permits")
def q_distinct_values(spark, sf_dir):
    return au.distinct_values(fx.permits(spark, sf_dir), "borough")


@query("audit_set_equal", f"""
    WITH got AS (SELECT DISTINCT borough AS value FROM fx_permits
                 WHERE NOT COALESCE(borough = '{DROPPED_BOROUGH}', FALSE)),
    exp AS (SELECT * FROM (VALUES {_EXPECTED_SQL}) t(value))
    SELECT COALESCE(got.value, exp.value) AS value, got.value IS NOT NULL AS in_data,
           exp.value IS NOT NULL AS in_expected
    FROM got FULL OUTER JOIN exp ON got.value = exp.value""")
def q_audit_set_equal(spark, sf_dir):
    """Distinct values vs the expected set, value by value (real set
    equality: the audit fails on any row with in_data != in_expected)."""
    return au.set_comparison(_staged(spark, sf_dir), "borough", _expected(spark))


@query("filter_like", "SELECT * FROM fx_permits WHERE borough LIKE '%'")
def q_filter_like(spark, sf_dir):
    return fx.permits(spark, sf_dir).where(F.col("borough").like("%"))


@query("fn_map_get", """
    SELECT permit_id, CAST(permit_id AS VARCHAR) AS wap_id FROM fx_permits""")
def q_fn_map_get(spark, sf_dir):
    """An entry of a stored map column (a summary map keyed 'wap.id')."""
    path = scratch_path(spark, "permit-summaries")
    fx.permits(spark, sf_dir).select("permit_id", F.create_map(
        F.lit("wap.id"), F.col("permit_id").cast("string"), F.lit("operation"), F.col("borough")).alias("summary")
    ).write.parquet(path)
    return spark.read.parquet(path).select("permit_id", F.col("summary")["wap.id"].alias("wap_id"))


@query("stage_audit_publish", f"""
    SELECT * FROM fx_permits WHERE NOT COALESCE(borough = '{DROPPED_BOROUGH}', FALSE)""")
def q_stage_audit_publish(spark, sf_dir):
    """Stage the delete at a new load path, judge it by what the write has
    observed, and move the pointer if it passes."""
    audits = {"boroughs": au.values_equal("borough", EXPECTED_BOROUGHS)}
    return au.stage_audit_publish(spark, _staged(spark, sf_dir), audits, scratch_path(spark, "permits"))


@query("staged_vs_published", f"""
    WITH c AS (SELECT borough, COUNT(*) AS n FROM fx_permits GROUP BY borough)
    SELECT borough, CASE WHEN borough IS DISTINCT FROM '{DROPPED_BOROUGH}' THEN n END AS staged_count,
           n AS published_count FROM c""")
def q_staged_vs_published(spark, sf_dir):
    """A published table and a staged copy of its next version, both on disk."""
    root = scratch_path(spark, "permits")
    now = au.stage_audit_publish(spark, fx.permits(spark, sf_dir), {}, root)
    staged = au.write_audited(ch.delete_where(now, F.col("borough") == DROPPED_BOROUGH), f"{root}/staged", {})
    return au.staged_vs_published(spark.read.parquet(staged), now, "borough")


@query("audit_row_count", """
    SELECT COUNT(*) AS rows_written, COUNT(*) AS rows_read, TRUE AS counts_equal FROM fx_taxis""")
def q_audit_row_count(spark, sf_dir):
    """The rows that the write has counted against those of the written table."""
    path = scratch_path(spark, "taxis-count")
    written = au.write_observed(fx.taxis(spark, sf_dir), path, {"rows": F.count(F.lit(1))})["rows"]
    return (spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_read"))
            .select(F.lit(written).cast("bigint").alias("rows_written"), "rows_read")
            .withColumn("counts_equal", F.col("rows_written") == F.col("rows_read")))


# ------------------------------------------------------------- loads

_LOADS_SQL = """t AS (SELECT *, CAST(year(tpep_pickup_datetime)
                               - (SELECT min(year(tpep_pickup_datetime)) FROM fx_taxis) + 1 AS INTEGER) AS load_id
               FROM fx_taxis)"""


def _with_load_ids(spark, sf_dir):
    """Taxi trips tagged with a load number: one load per pickup year."""
    t = fx.taxis(spark, sf_dir)
    y0 = t.select(F.min(F.year("tpep_pickup_datetime"))).scalar()      # scalar subquery
    return t.withColumn("load_id", (F.year("tpep_pickup_datetime") - y0 + 1).cast("int"))


def _loaded_table(spark, sf_dir) -> str:
    root = scratch_path(spark, "taxis-loads")
    au.append_loads(spark, root, _with_load_ids(spark, sf_dir))
    return root


@query("snapshot_log", f"""WITH {_LOADS_SQL}
    SELECT load_id, COUNT(*) AS rows_added, TRUE AS committed FROM t GROUP BY load_id""")
def q_snapshot_log(spark, sf_dir):
    log = au.load_log(spark, _loaded_table(spark, sf_dir))
    return log.select("load_id", "rows_added", (F.col("committed_at") <= F.current_timestamp()).alias("committed"))


@query("read_as_of", f"""WITH {_LOADS_SQL}
    SELECT {_T}, load_id FROM t WHERE load_id <= {AS_OF_LOAD}""")
def q_read_as_of(spark, sf_dir):
    return au.read_as_of(spark, _loaded_table(spark, sf_dir), AS_OF_LOAD)


@query("snapshot_retention", f"""
    WITH {_LOADS_SQL}, l AS (SELECT DISTINCT load_id FROM t)
    SELECT load_id, (SELECT count(*) FROM l n WHERE n.load_id > l.load_id) >= {KEEP_LAST} AS expired FROM l""")
def q_snapshot_retention(spark, sf_dir):
    log = au.load_log(spark, _loaded_table(spark, sf_dir))
    return au.load_retention(log, F.current_timestamp(), KEEP_LAST).select("load_id", "expired")


@query("append_two_batches", f"""
    SELECT 1 AS after_load, COUNT(*) FILTER (WHERE trip_distance > 35) AS long_trips
    FROM fx_taxis WHERE year(tpep_pickup_datetime) <= {FIRST_BATCH_UPTO}
    UNION ALL
    SELECT 2 AS after_load, COUNT(*) FILTER (WHERE trip_distance > 35) AS long_trips FROM fx_taxis""")
def q_append_two_batches(spark, sf_dir):
    """Load a batch, query, load the rest, query again; each query reads the
    table as of its load, so both answers stay reproducible."""
    root = scratch_path(spark, "taxis-two-batches")
    early = F.year("tpep_pickup_datetime") <= FIRST_BATCH_UPTO
    tagged = fx.taxis(spark, sf_dir).withColumn("load_id", F.when(early, 1).otherwise(2))
    results = []
    for load in (1, 2):
        au.append_loads(spark, root, tagged.where(F.col("load_id") == load))
        snap = au.read_as_of(spark, root, load)
        results.append(snap.agg(F.count_if(F.col("trip_distance") > 35).alias("long_trips"))
                       .select(F.lit(load).alias("after_load"), "long_trips"))
    return results[0].unionByName(results[1])
