"""Plan shape: pushdown, pruning, exchange counts, join strategies."""

import datetime as dt

from pyspark.sql import functions as F

from dimweave.functions.picks import first_per_key
from dimweave.operators import joins as jn
from dimweave.operators import layout as la
from dimweave.operators import scd
from dimweave.session import scratch_path
from dimweave.sources import fixtures as fx
from dimweave.sources import readers as rd

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushdown_filters_and_prunes(spark):
    df = rd.scan_pushdown(spark, f"{SF_SMALL}/events.parquet", F.col("event_type") == "error",
                          ["event_id", "props"])
    p = plan(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in p
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in p


def test_scd2_full_one_shuffle(spark):
    path = scratch_path(spark, "players-plan")
    spark.createDataFrame([("a", 1, "good", True)],
                          "player_name string, current_season int, scoring_class string, is_active boolean") \
        .write.parquet(path)
    p = plan(scd.scd2_full(spark.read.parquet(path), 3))
    assert p.count("Exchange hashpartitioning") == 1   # lag, running sum and grouping share it


def test_bucketed_join_has_no_exchange(spark):
    m = fx.matches(spark, SF_SMALL)
    d = fx.match_details(spark, SF_SMALL)
    jn.write_bucketed(m, "plan_m", scratch_path(spark, "plan_m"), "match_id", 16)
    jn.write_bucketed(d, "plan_d", scratch_path(spark, "plan_d"), "match_id", 16)
    p = plan(jn.join_bucketed(spark, "plan_m", "plan_d", "match_id"))
    assert "SortMergeJoin" in p and "Exchange" not in p


def test_buckets_of_different_counts_join_without_exchange(spark):
    m, d = fx.matches(spark, SF_SMALL), fx.match_details(spark, SF_SMALL)
    jn.write_bucketed(m, "plan_m8", scratch_path(spark, "plan_m8"), "match_id", 8)
    jn.write_bucketed(d, "plan_d16", scratch_path(spark, "plan_d16"), "match_id", 16)
    j = jn.join_bucketed(spark, "plan_m8", "plan_d16", "match_id")
    assert "SortMergeJoin" in plan(j) and "Exchange" not in plan(j) and "Coalesced to 8" in plan(j)
    want = d.join(m, "match_id").select(*j.columns)
    assert j.count() == want.count() and j.exceptAll(want).count() == 0


def test_a_hot_bucket_is_written_by_several_tasks(spark):
    """Half of all rows have one key: no file holds more than a part of them, and the join is whole."""
    hot = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("match_id"), F.col("id").alias("v"))
    path = scratch_path(spark, "plan_hot")
    jn.write_bucketed(hot, "plan_hot", path, "match_id", 4, files_per_bucket=8)
    rows = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert len(rows) > 8 and max(rows) < 4000 and sum(rows) == 20_000
    keys = hot.select("match_id").distinct().withColumn("w", F.lit(1))
    jn.write_bucketed(keys, "plan_keys", scratch_path(spark, "plan_keys"), "match_id", 4)
    j = jn.join_bucketed(spark, "plan_hot", "plan_keys", "match_id")
    assert "Exchange" not in plan(j) and j.count() == 20_000


def test_sort_merge_and_broadcast_choices(spark):
    d = fx.match_details(spark, SF_SMALL)
    m = fx.matches(spark, SF_SMALL)
    assert "SortMergeJoin" in plan(jn.join_sort_merge(d, m, "match_id"))
    day = m.where(F.to_date("completion_date") == F.lit(dt.date(1997, 8, 23)))
    assert "BroadcastHashJoin" in plan(jn.join_broadcast(d, day, "match_id"))
    # the count sees the filter; beyond the limit no broadcast is forced
    few = day.count()
    hint = "ResolvedHint (strategy=broadcast)"
    assert hint in jn.join_broadcast(d, day, "match_id", limit_rows=few)._jdf.queryExecution().analyzed().toString()
    assert hint not in jn.join_broadcast(d, m, "match_id", limit_rows=few)._jdf.queryExecution().analyzed().toString()


def test_sort_within_partitions_is_local(spark):
    ev = fx.events(spark, SF_SMALL).withColumn("event_date", F.to_date("event_time"))
    p = plan(la.sort_within(ev, "event_date", ["event_date", "host"]))
    assert "rangepartitioning" not in p and "REBALANCE_PARTITIONS_BY_COL" in p and "hashpartitioning(event_date" in p


def test_first_per_key_limits_before_the_shuffle(spark):
    d = fx.game_details(spark, SF_SMALL).select("game_id", "player_id", "pts", "line_no")
    p = plan(first_per_key(d, ["game_id", "player_id"], ["line_no", "pts"]))
    # a partial top-1 per key runs map-side, below the exchange
    partial = p.index("row_number(), 1, Partial")
    assert "Exchange hashpartitioning(game_id" in p[:partial]


def test_partition_filter_prunes(spark):
    path = scratch_path(spark, "plan-part")
    fx.taxis(spark, SF_SMALL).withColumn("y", F.year("tpep_pickup_datetime")).write.partitionBy("y").parquet(path)
    p = plan(spark.read.parquet(path).where(F.col("y") == 1998))
    assert "PartitionFilters: [isnotnull(y" in p and "(y#" in p


def test_snapshot_readers_prune_and_push(spark):
    """A stored snapshot is read by its partition; the key reaches the file."""
    from dimweave.plans.registry import QUERIES, load_all
    load_all()
    for name in ("history_unnest", "history_first_last", "history_growth", "project_struct_expand", "filter_asof_partition", "entity_lookup"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "PartitionFilters: [isnotnull(current_season" in p, name
    assert "EqualTo(player_name,1016)" in p


def test_fact_pick_limits_before_any_join(spark):
    from dimweave.operators import facts as fa
    p = plan(fa.fact_dedupe(fx.game_details(spark, SF_SMALL, comments=True), fx.games(spark, SF_SMALL)))
    # below the exchange that the pick needs there is a map-side limit
    assert "row_number(), 1, Partial" in p


def test_fact_dedupe_shuffles_lines_and_not_box_scores(spark):
    from dimweave.plans.registry import QUERIES, load_all
    load_all()
    p = plan(QUERIES["fact_dedupe"](spark, SF_SMALL))
    wide, below = p.index("AS fgm#"), [p.index(x) for x in ("Window [", "Exchange hashpartitioning(game_id#", "Exchange hashpartitioning(l_orderkey#") if x in p]
    # the measures are computed above the pick and the shuffles by game
    assert len(below) >= 2 and wide < min(below) and "row_number(), 1, Partial" in p


def test_details_join_part_only_for_comments(spark):
    assert "p_partkey" not in plan(fx.game_details(spark, SF_SMALL)) and "p_partkey" in plan(fx.game_details(spark, SF_SMALL, comments=True))


def test_scratch_paths(spark):
    """One folder, the session's or its context's, never nested deeper."""
    from dimweave.session import ensure_checkpoint_dir
    assert len({len(scratch_path(spark, "x")) for _ in range(3)}) == 1
    named = spark.conf.get("spark.checkpoint.dir", None)
    base = ensure_checkpoint_dir(spark)
    assert base == (named or spark.sparkContext._jsc.sc().getCheckpointDir().get())

    class Unset:
        """The session, as if its configuration named no folder."""
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    held = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    assert ensure_checkpoint_dir(Unset) == held == ensure_checkpoint_dir(Unset)


def test_pairs_scan_each_table_once(spark):
    """Lines, their number in large games, and the two tables that name a player."""
    from dimweave.plans.registry import QUERIES, load_all
    load_all()
    for name in ("edges_player_pairs", "join_self_theta", "agg_by_case"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert p.count("FileScan") == 4 and "CartesianProduct" not in p and "NestedLoop" not in p, name
    assert plan(QUERIES["graph_pair_averages"](spark, SF_SMALL)).count("FileScan") <= 7


def test_facts_are_picked_on_narrow_rows(spark):
    """The sort below the pick holds line columns only: no name, comment or measure."""
    from dimweave.plans.registry import QUERIES, load_all
    load_all()
    p = plan(QUERIES["fact_build"](spark, SF_SMALL))
    below = p[p.index("WindowGroupLimit"):]
    assert "row_number(), 1, Partial" in p and "p_name" not in below[:below.index("FileScan")]


def test_last_period_is_a_subquery(spark):
    """The newest period costs no job of its own before the query runs."""
    from dimweave.operators import cumulative as cu
    sc = spark.sparkContext
    sc.setJobGroup("last-period", "")
    df = cu.cumulative_backfill(fx.player_seasons(spark, SF_SMALL))
    before = len(sc.statusTracker().getJobIdsForGroup("last-period"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in text and len(sc.statusTracker().getJobIdsForGroup("last-period")) == before
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from dimweave.session import beside_warehouse
    assert beside_warehouse("local[4]", "file:/w/") == "file:/w/_checkpoints"
    assert beside_warehouse("yarn", "hdfs://n/w") == "hdfs://n/w/_checkpoints"
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            beside_warehouse(master, "file:/home/me/spark-warehouse")


def test_details_stored_by_time_are_pruned_by_their_matches(spark):
    """The filter names no partition, only matches; the scan of the details reads those in which one is left."""
    from dimweave.operators import enrich as en
    d = fx.match_details(spark, SF_SMALL)
    m = fx.matches(spark, SF_SMALL)
    path = scratch_path(spark, "details-by-month")
    en.store_details(d.unionByName(d.limit(1).withColumn("match_id", F.lit("none"))), m, path, "month")
    stored = spark.read.schema(f"{d.schema.simpleString()[7:-1].replace(':', ' ')}, completed string").parquet(path)
    assert stored.count() == d.count() + 1 and stored.where("completed is null").count() == 1
    few = m.where(F.col("match_id").isin("1", "2", "3"))
    j = en.stored_match_details(stored, few, "month")
    assert "dynamicpruning" in plan(j)
    want = d.join(few, "match_id").select(*j.columns)
    assert want.count() > 0 and j.exceptAll(want).count() == 0 and j.count() == want.count()
    j.collect()
    scans = [line for line in plan(j).splitlines() if "FileScan" in line and "completed" in line]
    assert scans and "PartitionFilters: [isnotnull(completed" in scans[0]
