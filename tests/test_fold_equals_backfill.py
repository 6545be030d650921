"""The step loads folded day by day (or year by year) equal the one-pass
backfills (SURVEY section 5, layer 2)."""

import pytest
from pyspark.sql import functions as F

from dimweave.operators import cumulative as cu
from dimweave.operators import datelist as dl
from dimweave.operators import metric_arrays as ma
from dimweave.operators import scd
from dimweave.sources import fixtures as fx

from conftest import SF_SMALL


def _same(a, b):
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_cumulative_fold_equals_backfill(spark):
    s = fx.player_seasons(spark, SF_SMALL)
    _same(cu.cumulative_fold(s, 1995, 2001), cu.cumulative_backfill(s, 2001))


def test_datelist_fold_equals_backfill(spark):
    a = fx.activity(spark, SF_SMALL)
    _same(dl.datelist_fold(a, "2024-01-01", "2024-01-30"), dl.datelist_backfill(a, "2024-01-30"))


def test_metric_array_fold_equals_backfill(spark):
    e = fx.events(spark, SF_SMALL)
    _same(ma.array_metric_fold(e, "2024-01-01", "2024-01-30"),
          ma.array_metric_backfill(e, "2024-01-01", "2024-01-30"))


def test_scd2_incremental_equals_full(spark):
    p = cu.cumulative_backfill(fx.player_seasons(spark, SF_SMALL), 2001)
    inc = scd.scd2_incremental(scd.scd2_full(p, 2000), cu.snapshot(p, 2001), 2001)
    _same(inc, scd.scd2_full(p, 2001))


def test_rolling_integer_equals_the_list(spark):
    """The state stepped from day to day, with days left out, against the list
    form over all days: 30 days and more, late users, a day loaded twice."""
    import datetime as dt

    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    seen = [(u, k) for u in range(1, 9) for k in range(0, 50) if (k * u) % 5 == 1 or (u == 3 and k == 0) or (u == 4 and k > 30)] + [(9, 45), (None, 3)]
    act = spark.createDataFrame([(u, day(k)) for u, k in seen], "user_id bigint, day date")
    for stops in ([*range(0, 50)], [0, 1, 2, 9, 10, 31, 32, 32, 49], [5, 49]):
        loaded = [k for k in range(50) if k in stops]
        state = dl.datelist_state(act.where("false"), day(-1))
        for n, k in enumerate(stops):
            state = dl.datelist_state_step(state, dl.datelist_today(act, day(k)), day(k))
            state = state.checkpoint() if n % 5 == 4 else state
        only = act.where(F.col("day").isin([day(k) for k in loaded]))
        _same(state, dl.datelist_state(only, day(49)))
        users = dl.datelist_backfill(only, day(49))
        for today in (False, True):
            _same(dl.datelist_state_int(state, include_today=today), dl.datelist_int(users, include_today=today))
    with pytest.raises(Exception, match="the state is newer"):
        dl.datelist_state_step(state, dl.datelist_today(act, day(3)), day(3)).collect()
    whole = dl.datelist_state(act)
    assert {r.date for r in whole.collect()} == {day(49)}
