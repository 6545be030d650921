"""Hot keys: one key holding a large share of the rows."""

from pyspark.sql import functions as F

from dimweave.functions.picks import collect_lists, first_per_key
from dimweave.operators import graph as gr


def _details(spark, hot_players: int, cold_games: int):
    """One hot game with many players plus many small games."""
    hot = spark.range(hot_players).select(F.lit(0).cast("bigint").alias("game_id"),
                                          (F.col("id") + 1).alias("player_id"))
    cold = spark.range(cold_games * 3).select((F.col("id") / 3 + 1).cast("bigint").alias("game_id"),
                                              (F.col("id") % 50 + 1).alias("player_id"))
    rows = hot.unionByName(cold)
    return rows.select(
        "game_id", (F.col("player_id") % 5).cast("int").alias("team_id"),
        F.concat(F.lit("T"), (F.col("player_id") % 5).cast("string")).alias("team_abbreviation"),
        "player_id", F.concat(F.lit("P"), F.col("player_id").cast("string")).alias("player_name"),
        F.lit("R").alias("start_position"), (F.col("player_id") % 30).cast("int").alias("pts"),
        F.lit(1).alias("line_no"), F.lit(1).cast("bigint").alias("part_id"), F.lit(1.0).alias("price"),
        F.lit(None).cast("timestamp_ntz").alias("ship_ts"))


def test_hot_game_pairs_are_spread_over_tasks(spark):
    """With the session's settings as they are, no task makes more than a small
    share of a hot game's pairs."""
    pairs = gr.player_pairs(_details(spark, 2500, 200)).withColumn("task", F.spark_partition_id())
    by_task = {r.task: r.n for r in pairs.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = 2500 * 2499 // 2 + 200 * 3      # hot game's pairs + 3 pairs per small game
    assert sum(by_task.values()) == total
    assert max(by_task.values()) < 0.3 * total and len(by_task) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_pairs_do_not_depend_on_the_block_size(spark, monkeypatch):
    d = _details(spark, 60, 20)
    whole = gr.player_pairs(d)
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(gr, "PAIR_BLOCK", 7)
    assert sorted(map(tuple, gr.player_pairs(d).collect())) == want and len(want) == 60 * 59 // 2 + 60


def test_first_per_key_on_hot_key(spark):
    df = spark.range(50000).select((F.col("id") % 2 * 0).alias("k"), F.col("id").alias("o"),
                                   (F.col("id") * 7).alias("v"))
    out = first_per_key(df, ["k"], ["o"]).collect()
    assert [(r.k, r.o, r.v) for r in out] == [(0, 0, 0)]


def test_collected_lists_have_the_same_rows_at_any_group_size(spark):
    # values all multiples of the bucket count: a plain modulo would put them in one bucket
    hot = spark.range(2000).select(F.lit("hot").alias("g"), (F.col("id") * 20).alias("v"))
    rest = spark.createDataFrame([("cold", 1), ("cold", 1), ("cold", 2), (None, 5), (None, None), ("none", None)], "g string, v bigint")
    out = collect_lists(hot.unionByName(rest), ["g"], "v", buckets=5, out="vals").collect()
    by = {}
    for r in out:
        by.setdefault(r.g, []).append(r.vals)
    assert {g: len(v) for g, v in by.items()} == {"hot": 5, "cold": 5, None: 5, "none": 5}
    assert max(map(len, by["hot"])) < 500
    flat = {g: sorted(x for v in lists for x in v) for g, lists in by.items()}
    assert flat == {"hot": [i * 20 for i in range(2000)], "cold": [1, 1, 2], None: [5], "none": []}


def test_totals_are_not_repeated_by_the_lists(spark):
    from dimweave.operators import enrich as en
    agg = spark.createDataFrame([(1, d, 2) for d in range(50)] + [(2, None, 7)], "user_id bigint, device_id bigint, event_counts bigint")
    got = en.user_device_rollup(agg, buckets=3)
    assert got.agg(F.sum("raw_event_rows")).first()[0] == 107
    assert sorted(d for r in got.where("user_id = 1 and bucket is not null").collect() for d in r.devices) == list(range(50))


def test_bucket_assignment_matches_sql(spark):
    """The DuckDB text of the same rule puts every value into the same bucket."""
    from dimweave.plans.fixture_sql import with_fixtures
    from dimweave.plans.oracle_check import compare, duckdb_connection
    from dimweave.plans.q_enrich import _lists_sql
    from dimweave.sources import fixtures as fx

    sf = "/root/testdata/sf0.01"

    def spark_side(spark_, sf_dir):
        ev = fx.events(spark_, sf_dir).select("referrer", "user_id")
        return collect_lists(ev, ["referrer"], "user_id", buckets=7, out="users")

    sql = with_fixtures(f"""
        WITH ev AS (SELECT referrer, user_id FROM fx_events)
        SELECT * FROM {_lists_sql('ev', 'referrer', 'user_id', 'users', buckets=7)}""")
    res = compare(spark, duckdb_connection(sf), "lists", spark_side, sql, sf)
    assert res["ok"] and res["spark_rows"] == 5 * 7, res
