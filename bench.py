"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully materialised through the no-op sink (every row and
column computed, nothing collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    # one-pass forms of the modelling loads
    "cumulative_backfill", "scd2_full", "scd2_incremental", "datelist_backfill", "datelist_bits",
    "activity_flags", "array_metric_backfill", "array_elementwise_sum",
    # fact / graph builds
    "fact_build", "fact_bail_rate", "vertices_player", "edges_plays_in", "edges_player_pairs",
    "graph_pair_averages",
    # enrichment, joins, cleaning
    "enrich_events_devices", "user_device_rollup", "device_user_list", "join_sort_merge",
    "match_details_join", "outlier_zscore", "histogram_fixed_bins", "partition_report",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from dimweave.operators import cumulative as cu
    from dimweave.operators import datelist as dl
    from dimweave.plans.params import ASOF, FIRST_PERIOD, LAST_PERIOD, SERIES_START
    from dimweave.plans.registry import QUERIES, load_all
    from dimweave.session import build_session
    from dimweave.sources import fixtures as fx

    load_all()
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="dimweave-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # Each query runs once untimed (JIT, whole-stage codegen compilation,
    # file listing), then twice timed; the faster timed run is reported
    # (steady-state throughput, less exposed to machine noise).
    def timed(build) -> float:
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            run(build())
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        return round(best, 3)

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        cold[name] = round(time.perf_counter() - t0, 3)
        times[name] = timed(lambda: QUERIES[name](spark, sf_dir))

    # The reference's sequential procedure, for comparison with the one-pass
    # forms above (same results; see tests/test_fold_equals_backfill.py).
    t0 = time.perf_counter()
    run(cu.cumulative_fold(fx.player_seasons(spark, sf_dir), FIRST_PERIOD, LAST_PERIOD))
    times["cumulative_fold_steps"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    run(dl.datelist_fold(fx.activity(spark, sf_dir), SERIES_START, ASOF))
    times["datelist_fold_steps"] = round(time.perf_counter() - t0, 3)

    # Step loads as they run in production: over the stored previous table
    # (written once, untimed), reading one partition of it plus the new data.
    from pyspark.sql import functions as F

    from dimweave.operators import scd
    from dimweave.plans.params import ASOF_PREV, SCD_BASE, SCD_NEXT
    from dimweave.session import scratch_path

    seasons = fx.player_seasons(spark, sf_dir)
    players_path, scd_path, users_path = (scratch_path(spark, n) for n in ("b-players", "b-scd", "b-users"))
    cu.cumulative_backfill(seasons).write.partitionBy("current_season").parquet(players_path)
    players = spark.read.parquet(players_path)
    scd.scd2_full(players, SCD_BASE).write.partitionBy("current_season").parquet(scd_path)
    act = fx.activity(spark, sf_dir)
    dl.datelist_backfill(act, ASOF_PREV).write.parquet(users_path)
    stored = {
        "scd2_incremental_from_stored": lambda: scd.scd2_incremental(
            spark.read.parquet(scd_path), players.where(F.col("current_season") == SCD_NEXT), SCD_NEXT),
        "cumulative_step_from_stored": lambda: cu.cumulative_step(
            players.where(F.col("current_season") == LAST_PERIOD - 1),
            seasons.where(F.col("season") == LAST_PERIOD)),
        "datelist_step_from_stored": lambda: dl.datelist_step(
            spark.read.parquet(users_path), dl.datelist_today(act, ASOF)),
    }
    for name, build in stored.items():
        run(build())
        times[name] = timed(build)

    total = round(sum(v for k, v in times.items() if k in HEADLINE), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus,
                      "cold_total": round(sum(cold.values()), 3)}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
