"""Literal edge rows for the semantic rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimweave.functions.text import minutes_from_text
from dimweave.operators import audit as au
from dimweave.operators import changes as ch
from dimweave.operators import cleaning as cl
from dimweave.operators import cumulative as cu
from dimweave.operators import datelist as dl
from dimweave.operators import scd
from dimweave.operators.graph import json_props

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# R1: change detection ignores NULL (first row and NULL sides give 0).
def test_r1_null_is_no_change(spark):
    p = spark.createDataFrame(
        [("a", 1, "good", True), ("a", 2, None, True), ("a", 3, "bad", True)],
        "player_name string, current_season int, scoring_class string, is_active boolean")
    flags = scd.scd_change_flags(p, 3)
    assert rows(flags, "current_season", "scoring_class_change_indicator") == [(1, 0), (2, 0), (3, 0)]
    full = scd.scd2_full(p, 3)
    assert rows(full, "start_season", "end_season") == [(1, 1), (2, 2), (3, 3)]
    safe = scd.scd_streaks(p, 3, null_safe=True)
    assert rows(safe, "streak_identifier") == [(0,), (1,), (2,)]


# R2: incremental type-2 drops NULL-attribute rows and open rows absent from the new period.
def test_r2_incremental_three_valued_hole(spark):
    hist = spark.createDataFrame(
        [("a", "good", True, 1, 2, 2), ("b", "bad", True, 1, 2, 2), ("c", "star", True, 2, 2, 2),
         ("d", "good", False, 1, 1, 2)],
        "player_name string, scoring_class string, is_active boolean, start_season int, "
        "end_season int, current_season int")
    cur = spark.createDataFrame(
        [("a", "good", True), ("b", None, True), ("e", "bad", True)],
        "player_name string, scoring_class string, is_active boolean")
    out = scd.scd2_incremental(hist, cur, 3)
    assert rows(out, "player_name", "start_season", "end_season") == [
        ("a", 1, 3),      # unchanged run extended
        ("d", 1, 1),      # closed row kept
        ("e", 3, 3),      # new entity opened
    ]                     # b (NULL class) and c (absent) vanish


# R3: the as-of day wraps to 0; the high bit is yesterday.
def test_r3_datelist_bits(spark):
    asof = D(2024, 1, 30)
    u = spark.createDataFrame(
        [("only_today", [asof], asof),
         ("mixed", [asof - dt.timedelta(days=k) for k in (1, 7, 8, 29)], asof),
         ("day8", [asof - dt.timedelta(days=8)], asof)],
        "user_id string, dates_active array<date>, date date")
    i = dl.activity_flags(dl.datelist_int(u))
    got = {r.user_id: (r.datelist_int, r.dim_is_daily_active, r.dim_is_weekly_active) for r in i.collect()}
    assert got["only_today"] == (0, False, False)
    assert got["mixed"] == (2**31 + 2**25 + 2**24 + 2**3, True, True)
    assert got["day8"] == (2**24, False, False)
    today = dl.datelist_int(u, include_today=True).where("user_id = 'only_today'").first()
    assert today.datelist_int == 2**31


# R4: empty / NULL arrays and indexes past the end give NULL, not errors.
def test_r4_array_access(spark):
    s = spark.createDataFrame([("x", []), ("y", None)], f"player_name string, seasons array<{cu.SEASON_TYPE}>")
    r = cu.history_first_last(s).collect()
    assert all(x.first_season is None and x.latest_season is None for x in r)
    prev = spark.createDataFrame(
        [("x", None, None, None, None, None, None, None, "bad", 0, True, 1)],
        "player_name string, height string, college string, country string, draft_year string, "
        f"draft_round string, draft_number string, seasons array<{cu.SEASON_TYPE}>, scoring_class string, "
        "years_since_last_active int, is_active boolean, current_season int")
    cur = spark.createDataFrame([("x", None, None, None, None, None, None, 2, 21.0, 1.0, 1.0, 70)],
                                "player_name string, height string, college string, country string, "
                                "draft_year string, draft_round string, draft_number string, season int, "
                                "pts double, ast double, reb double, weight int")
    out = cu.cumulative_step(prev, cur).first()
    assert len(out.seasons) == 1 and out.scoring_class == "star"


# R6: JSON keeps NULL fields.
def test_r6_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(json_props(F.col("a"), F.col("b")).alias("j")).first().j == '{"a":1,"b":null}'


# R8: minutes text.
def test_r8_minutes(spark):
    df = spark.createDataFrame([("12:30",), ("12",), ("",), (None,)], "m string")
    got = [r.x for r in df.select(minutes_from_text(F.col("m")).alias("x")).collect()]
    assert got == [12.5, None, None, None]


# R9: division by zero or NULL gives NULL.
def test_r9_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "tip double, d double")
    got = [r.r for r in cl.feature_ratio(df, "r", "tip", "d").collect()]
    assert got == [None, None, 1.5]


# R10: real set equality.
@pytest.mark.parametrize("values,n_fail", [
    (["a", "b", "x"], 2),        # wrong set of the same size
    (["a", "b"], 1),             # one missing
    (["a", "b", "c", "d"], 1),   # one extra
    (["a", "b", "c"], 0),
])
def test_r10_audit_set_equal(spark, values, n_fail):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    exp = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    assert au.audit_set_equal(df, "v", exp).count() == n_fail


# R13: z-score ignores NULLs; a constant column drops everything.
def test_r13_zscore(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (3.0,)], "v double")
    assert cl.outlier_zscore(df, "v").count() == 3
    const = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert cl.outlier_zscore(const, "v").count() == 0


# R14: strict thresholds, NULL points -> bad.
def test_r14_scoring_class(spark):
    df = spark.createDataFrame([(10.0,), (15.0,), (20.0,), (20.5,), (None,)], "pts double")
    got = [r.c for r in df.select(cu.scoring_class(F.col("pts")).alias("c")).collect()]
    assert got == ["bad", "average", "good", "star", "bad"]


def test_delete_where_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, p boolean")
    assert rows(ch.delete_where(df, F.col("p")), "id") == [(2,), (3,)]


def test_load_retention_edges(spark):
    log = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 2, 1)), (3, dt.datetime(2020, 3, 1))],
        "load_id int, committed_at timestamp")
    few = au.load_retention(log, "2030-01-01", keep_last=5)
    assert rows(few.where("expired"), "load_id") == []
    old = au.load_retention(log, "2030-01-01", keep_last=1)
    assert rows(old.where("expired"), "load_id") == [(1,), (2,)]
    assert rows(au.load_retention(log, "2020-01-15", keep_last=1).where("expired"), "load_id") == [(1,)]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    h = cl.histogram_fixed_bins(df, "v", 10)
    assert rows(h, "bin", "num_rows") == [(b, int(b in (1, 6, 10))) for b in range(1, 11)]
    same = cl.histogram_fixed_bins(df.where("v = 5"), "v", 3)
    assert rows(same, "bin", "num_rows") == [(1, 1), (2, 0), (3, 0)]


def test_key_violations_flags_null_and_duplicate(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "k int, v string")
    got = {(r.k, r.num_rows) for r in au.key_violations(df, ["k", "v"]).collect()}
    assert got == {(None, 1), (1, 2)}


def test_widen_refuses_narrowing(spark):
    from pyspark.sql.types import IntegerType
    df = spark.createDataFrame([(1,)], "x bigint")
    with pytest.raises(ValueError):
        ch.evolve_widen(df, "x", IntegerType())


def test_loads_are_appended_once(spark):
    from dimweave.session import scratch_path
    root = scratch_path(spark, "loads")
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (3, 31)], "load_id int, v int")
    log = au.append_loads(spark, root, df)
    assert rows(log, "load_id", "rows_added") == [(1, 1), (2, 1), (3, 2)]
    assert rows(au.read_as_of(spark, root, 2), "v") == [(10,), (20,)]
    with pytest.raises(AssertionError):  # tried again
        au.append_loads(spark, root, df.where("load_id = 3"))
    assert au.load_log(spark, root).count() == 3 and au.read_as_of(spark, root, 9).count() == 4
    au.append_loads(spark, root, spark.createDataFrame([(4, 40)], "load_id int, v int"))
    assert au.read_as_of(spark, root, 9).count() == 5


def test_failed_audit_leaves_the_published_table(spark):
    from dimweave.operators.layout import file_listing
    from dimweave.session import scratch_path
    root = scratch_path(spark, "publish")
    one, two = (spark.createDataFrame([(x,)], "v int") for x in (1, 2))
    audit = {"no twos": lambda staged: staged.where("v = 2")}
    assert rows(au.stage_audit_publish(spark, one, audit, root), "v") == [(1,)]
    before = file_listing(spark, root).count()
    with pytest.raises(AssertionError):
        au.stage_audit_publish(spark, two, audit, root)
    assert rows(au.published(spark, root), "v") == [(1,)]
    assert file_listing(spark, root).count() == before  # the staged copy is gone
    assert rows(au.stage_audit_publish(spark, two, {}, root), "v") == [(2,)]


def test_a_broken_key_is_not_written(spark):
    from dimweave.operators import facts as fa
    from dimweave.plans.params import MARKERS
    from dimweave.session import scratch_path
    from dimweave.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    fact = fa.fact_build(fx.game_details(spark, sf, comments=True), fx.games(spark, sf), MARKERS)
    assert au.key_violations(fact, fa.FACT_KEY).count() > 0
    with pytest.raises(AssertionError):
        au.write_keyed(fact, scratch_path(spark, "fact"), fa.FACT_KEY)
    # The load of the fact table keeps its key: rows that break it go to a table of their own.
    loaded, rejected = (spark.read.schema(fact.schema).parquet(p) for p in fa.load_fact(fact, scratch_path(spark, "fact")))
    assert au.key_violations(loaded, fa.FACT_KEY).count() == 0 and rejected.count() > 0
    assert fact.exceptAll(loaded.unionAll(rejected)).count() == 0 and loaded.count() + rejected.count() == fact.count()
    assert rejected.groupBy(*fa.FACT_KEY).count().where("count = 1").count() == 0


def test_picked_lines_give_the_picked_details(spark):
    from dimweave.operators import facts as fa
    from dimweave.operators import graph as gr
    from dimweave.plans.params import MARKERS
    from dimweave.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    lines = fx.described(fa.pick_lines(fx.game_lines(spark, sf)), spark, sf, comments=True)
    late = fa.fact_build(fx.game_details(spark, sf, comments=True), fx.games(spark, sf), MARKERS)
    early = fa.fact_build(lines, fx.games(spark, sf), MARKERS, picked=True)
    assert early.exceptAll(late).count() == 0 and late.exceptAll(early).count() == 0
    cols = ["player_name", "team_abbreviation", "pts"]
    late, early = gr.participations(fx.game_details(spark, sf), cols), gr.participations(lines, cols, picked=True)
    assert early.select(*cols).exceptAll(late.select(*cols)).count() == 0 and early.count() == late.count()


def test_fact_dedupe_of_odd_rows(spark):
    """Picked narrow and described last: the rows that a pick among described rows gives."""
    from dimweave.operators import facts as fa
    from dimweave.plans.registry import QUERIES, load_all
    from dimweave.session import scratch_path
    from dimweave.sources import fixtures as fx
    load_all()
    sf, at = scratch_path(spark, "odd-facts"), dt.datetime(1995, 1, 1)
    tables = {
        # player 1 is listed twice, 2 has two teams, 3 no team, 5 an unknown one, 6 no name
        "supplier": ("s_suppkey long, s_name string, s_nationkey int",
                     [(1, "one", 1), (1, "one", 1), (2, "two", 1), (2, "two", 2), (3, "three", None), (5, "five", 9), (6, None, 2), (None, "none", 1)]),
        "nation": ("n_nationkey int, n_name string", [(1, "A"), (1, "A"), (2, "B"), (None, "C")]),
        "part": ("p_partkey long, p_name string", [(1, "bolt"), (1, "bolt"), (2, None), (3, "nut"), (None, "none")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
                   [(1, 1, "F", 9.0, at), (2, 1, "O", 9.0, at), (2, 1, "O", 9.0, at + dt.timedelta(400)), (4, 7, "F", 9.0, at), (None, 1, "F", 9.0, at), (5, 2, None, None, None)]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, None)]),
        "lineitem": ("l_orderkey long, l_suppkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_shipdate timestamp, l_returnflag string, l_quantity double",
                     # the first lines of (1, 1) have no part, or an unknown one
                     [(1, 1, None, None, 1.0, at, "R", 1.0), (1, 1, 1, 8, 1.0, at, "R", 2.0), (1, 1, 2, 3, 1.0, at, "N", 3.0), (1, 1, 2, 1, 2.0, at, "N", 4.0),
                      (1, 1, 2, 1, 2.0, at, "N", 4.0), (1, 2, 3, 2, None, None, None, 5.0), (1, 2, 4, 1, 1.0, at, "A", None), (1, 3, 1, 1, 1.0, at, "A", 7.0),
                      (1, 4, 1, 1, 1.0, at, "A", 7.0), (1, 5, 1, 1, 1.0, at, "A", 7.0), (2, 6, None, 1, 1.0, at, "A", None), (2, 1, 1, 8, 1.0, at, "A", 7.0),
                      (3, 1, 1, 1, 1.0, at, "A", 7.0), (4, 1, 1, 1, 1.0, at, "A", 7.0), (5, 2, 1, 1, 1.0, at, "A", 7.0), (None, 1, 1, 1, 1.0, at, "A", 7.0), (1, None, 1, 1, 1.0, at, "A", 7.0)])}
    for name, (schema, found) in tables.items():
        spark.createDataFrame(found, schema).write.parquet(f"{sf}/{name}.parquet")
    got = QUERIES["fact_dedupe"](spark, sf)
    want = fa.fact_dedupe(fx.game_details(spark, sf, comments=True), fx.games(spark, sf))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # one row for each date of a game that has two; the first line with a known part
    assert rows(got, "game_id", "team_id", "player_id", "part_id") == [
        (1, 1, 1, 1), (1, 1, 2, 2), (1, 2, 2, 2), (2, 2, 6, 1), (2, 2, 6, 1), (5, 1, 2, 1), (5, 2, 2, 1)]


def test_batches_that_were_not_logged_are_not_read(spark):
    from dimweave.session import scratch_path
    root = scratch_path(spark, "loads-lost")
    for k in (1, 2, 3):
        au.append_loads(spark, root, spark.createDataFrame([(k, f"v{k}")], "load_id int, v string"))
    spark.createDataFrame([(1, "lost")], "load_id int, v string").write.partitionBy("load_id").parquet(f"{root}/data/batch=b0")
    assert sorted(r.v for r in au.read_as_of(spark, root, 2).collect()) == ["v1", "v2"]
    plan = au.read_as_of(spark, root, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 3 and "dynamicpruning" in plan  # data, log, and the log again for its batches


def test_flags_that_are_null(spark):
    """A game without a result counts for the visitor; a pair without a team plays against."""
    from dimweave.operators import graph as gr
    games = spark.createDataFrame([(1, None, 5, 6, 10, 11)], "game_id long, home_team_wins int, home_team_id int, visitor_team_id int, pts_home int, pts_away int")
    assert '"winning_team":6' in gr.vertices_game(games).first().properties
    lines = [(1, 1, "T", 1, "A", 3), (1, 2, None, 2, "B", 4), (1, 2, "T", 3, "C", 5), (1, 2, "T", 4, None, 5)]
    d = spark.createDataFrame(lines, "game_id long, team_id int, team_abbreviation string, player_id long, player_name string, pts int")
    got = {(r.subject_player_id, r.object_player_id, r.edge_type) for r in gr.player_pairs(d, gr.game_sizes(d), picked=True).collect()}
    assert got == {(2, 1, "plays_against"), (3, 1, "shares_team"), (3, 2, "plays_against")}


def test_null_attributes_and_users_fold_like_the_backfill(spark):
    seasons = spark.createDataFrame(
        [("a", "6-1", None, 1995, 5.0), ("a", None, "Duke", 1996, 25.0), ("a", "6-9", "Yale", 1998, 12.0), ("b", None, None, 1997, None)],
        "player_name string, height string, college string, season int, pts double")
    for c in ("country", "draft_year", "draft_round", "draft_number"):
        seasons = seasons.withColumn(c, F.lit(None).cast("string"))
    seasons = seasons.withColumn("ast", F.lit(1.0)).withColumn("reb", F.lit(1.0)).withColumn("weight", F.lit(1))
    fold, back = cu.cumulative_fold(seasons, 1995, 1998), cu.cumulative_backfill(seasons, 1998)
    cols = ["player_name", "current_season", "height", "college", "scoring_class", "scoring_class_ord", "is_active"]
    got = sorted((tuple(r[c] for c in cols) for r in back.collect()), key=repr)
    assert got == sorted((tuple(r[c] for c in cols) for r in fold.collect()), key=repr)
    assert ("a", 1995, "6-1", None, "bad", 0, True) in got and ("a", 1998, "6-1", "Duke", "average", 1, True) in got
    assert [g[1] for g in sorted((tuple(r[c] for c in cols) for r in cu.cumulative_backfill(seasons, 1998, periods=[1996, 1998]).collect()))] == [1996, 1998, 1998]
    act = spark.createDataFrame([(1, D(2024, 1, 1)), (None, D(2024, 1, 1)), (None, D(2024, 1, 2))], "user_id bigint, day date")
    a, b = dl.datelist_fold(act, "2024-01-01", "2024-01-02"), dl.datelist_backfill(act, "2024-01-02")
    assert a.exceptAll(b).count() == 0 and rows(b, "user_id") == [("1",)]


def test_metric_step_starts_a_new_month(spark):
    from dimweave.operators import metric_arrays as ma
    january = spark.createDataFrame([(1, D(2024, 1, 1), "site_hits", [1.0] * 31)],
                                    "user_id bigint, month_start date, metric_name string, metric_array array<double>")
    second = spark.createDataFrame([(1, D(2024, 2, 2), 4)], "user_id bigint, date date, num_site_hits bigint")
    got = ma.array_metric_step(january, second, "2024-02-02").collect()
    assert [(r.user_id, r.month_start, r.metric_array) for r in got] == [(1, D(2024, 2, 1), [0.0, 4.0])]


def test_enrichment_variants_agree(spark):
    """The SQL-text variant of the enrichment join gives the rows of the typed one."""
    from dimweave.operators import enrich as en
    from dimweave.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    ev, dev = fx.events(spark, sf), fx.devices(spark, sf)
    sql, df = en.enrich_sql(spark, ev, dev), en.typed_enrich(ev, dev)
    assert df.exceptAll(sql).count() == 0 and sql.exceptAll(df).count() == 0 and df.count() > 0


def test_upsert_table_rewrites_only_touched_partitions(spark):
    from dimweave.session import scratch_path
    path = scratch_path(spark, "upsert")
    spark.createDataFrame([(1, "2024-01", 1.0), (2, "2024-01", 2.0), (1, "2024-02", 5.0)],
                          "k int, month string, v double").write.partitionBy("month").parquet(path)
    src = spark.createDataFrame([(2, "2024-01", 20.0), (3, "2024-01", 30.0)], "k int, month string, v double")
    out = ch.upsert_table(spark, path, src, ["k", "month"], ["month"])
    got = sorted((r.k, str(r.month), r.v) for r in out.collect())
    assert got == [(1, "2024-01", 1.0), (1, "2024-02", 5.0), (2, "2024-01", 20.0), (3, "2024-01", 30.0)]


def test_upsert_table_null_and_text_partitions(spark):
    from dimweave.session import scratch_path
    path, ddl = scratch_path(spark, "upsert-null"), "k int, p string, v int"
    spark.createDataFrame([(1, None, 1), (2, None, 2), (1, "01", 3)], ddl).write.partitionBy("p").parquet(path)
    out = ch.upsert_table(spark, path, spark.createDataFrame([(2, None, 20), (1, "01", 30)], ddl), ["k", "p"], ["p"])
    assert sorted(map(tuple, out.select("k", "p", "v").collect()), key=repr) == [(1, "01", 30), (1, None, 1), (2, None, 20)]
    with pytest.raises(AssertionError):  # one key twice
        ch.upsert_table(spark, path, spark.createDataFrame([(1, "01", 1), (1, "01", 2)], ddl), ["k", "p"], ["p"])
    with pytest.raises(ValueError):
        ch.upsert_table(spark, path, spark.createDataFrame([(1, "01", 1)], ddl), ["k"], ["p"])
    assert spark.read.parquet(path).count() == 3


def _naive_history(rows, null_safe=False):
    """(key, attributes, first, last) by walking through each key's periods."""
    out = []
    for key in {r[0] for r in rows}:
        groups, streak, before = {}, 0, None
        for _, period, *attrs in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            if before is not None and (attrs != before if null_safe else any(x is not None and y is not None and x != y for x, y in zip(attrs, before))):
                streak += 1
            lo, _ = groups.setdefault((streak, *attrs), (period, period))
            groups[(streak, *attrs)] = (lo, period)
            before = attrs
        out += [(key, *g[1:], lo, hi) for g, (lo, hi) in groups.items()]
    return sorted(out, key=repr)


def test_history_in_parts_equals_history_at_once(spark):
    import random

    from dimweave.operators import scd
    rng = random.Random(4)
    rows = [(k, p, rng.choice(["good", "star", None, "good"]), rng.choice([True, False, True, None]))
            for k in ("a", "b", "c", None) for p in range(1, 60) if rng.random() < 0.8]
    rows += [("flat", p, "bad", True) for p in range(1, 40)]
    df = spark.createDataFrame(rows, "player_name string, current_season int, scoring_class string, is_active boolean")

    def got(d):
        return sorted((tuple(r)[:-1] for r in d.collect()), key=repr)

    for null_safe in (False, True):
        want = _naive_history(rows, null_safe)
        assert got(scd.scd2_full(df, 100, null_safe=null_safe)) == want
        assert got(scd.scd2_full(df, 100, null_safe=null_safe, chunk=7)) == want
        old, new = scd.run_lists(df.where("current_season <= 30")), scd.run_lists(df.where("current_season > 30"), chunk=5)
        assert got(scd.scd2_from_runs(scd.merge_run_lists(old, new), 100, null_safe=null_safe)) == want
    flat = {r.player_name: len(r.runs) for r in scd.run_lists(df, chunk=7).collect()}
    assert flat["flat"] == 1  # a history without change is one run, whatever its length


def test_backfill_fills_attributes_as_the_step_does(spark):
    """NULL attributes, gaps, and attributes that change: the first known value stays."""
    from dimweave.operators import cumulative as cu
    cols = "player_name string, height string, college string, country string, draft_year string, draft_round string, draft_number string, season int, pts double, ast double, reb double, weight int"
    rows = [("a", None, "x", None, "1", None, None, 1995, 1.0, 1.0, 1.0, 1), ("a", "6-1", "y", None, "2", None, None, 1998, 30.0, 1.0, 1.0, 2),
            ("a", "6-2", None, "FR", None, "3", None, 1999, None, None, None, None), ("b", "5-9", None, None, None, None, "7", 1997, 17.0, 0.0, 0.0, 9)]
    s = spark.createDataFrame(rows, cols)
    full, fold = cu.cumulative_backfill(s, 2001), cu.cumulative_fold(s, 1995, 2001)
    assert full.exceptAll(fold).count() == 0 and fold.exceptAll(full).count() == 0 and full.count() == 12
    some = cu.cumulative_backfill(s, 2001, periods=[1996, 1999])
    assert some.exceptAll(full.where("current_season in (1996, 1999)")).count() == 0 and some.count() == 3
    newest = cu.cumulative_backfill(s)  # up to the data's own last period
    assert newest.agg(F.max("current_season")).first()[0] == 1999 and newest.exceptAll(full).count() == 0


def test_observed_audits_need_no_second_read(spark, monkeypatch):
    """They are judged by the write; a load that fails is dropped, and what was published stays."""
    from dimweave.operators.layout import file_listing
    from dimweave.session import scratch_path
    root = scratch_path(spark, "observed")
    rows_ = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, w string")
    monkeypatch.setattr(au, "assert_no_rows", lambda *a: 1 / 0)
    audits = {"v": au.no_rows_where(F.col("v") > 3), "w": au.values_equal("w", ["a", "b", None])}
    assert rows(au.stage_audit_publish(spark, rows_, audits, root), "v") == [(1,), (2,), (3,)]
    before = file_listing(spark, root).count()
    for wrong in ({"v": au.no_rows_where(F.col("v") > 2)}, {"w": au.values_equal("w", ["a", "b"])}, {"w": au.values_equal("w", ["a", "b", None, "c"])}):
        with pytest.raises(AssertionError, match="audit failed"):
            au.stage_audit_publish(spark, rows_.withColumn("v", F.col("v") + 0), wrong, root)
    assert file_listing(spark, root).count() == before and rows(au.published(spark, root), "v") == [(1,), (2,), (3,)]
    parts = au.write_observed(rows_, scratch_path(spark, "observed-parts"), {"n": F.count(F.lit(1)), "s": F.sum("v")}, ["w"])
    assert parts == {"n": 3, "s": 6}
    nothing = au.write_observed(rows_.where("v > 9"), scratch_path(spark, "observed-none"), {"n": F.count(F.lit(1))})
    assert nothing == {"n": 0}
