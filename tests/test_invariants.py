"""Invariants over the sf0.01 fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from usagelens.operators import kpis as K
from usagelens.operators import paths as PT
from usagelens.operators import retention as RT


def test_new_users_sum_to_devices(inputs_mid):
    i = inputs_mid
    k = K.daily_kpis(i.launch, None, None, "product")
    tot = k.groupBy("product_id").agg(F.sum("newusers").alias("n"), F.max("allusers").alias("a"))
    dev = i.launch.groupBy("product_id").agg(F.countDistinct("device_id").alias("dev"))
    for r in tot.join(dev, "product_id").collect():
        assert r.n == r.dev == r.a


def test_exits_equal_sessions_and_outflow_equals_views(inputs_mid):
    i = inputs_mid
    st = PT.page_stats(i.page, None)
    sessions = i.page.select("product_id", "session_id", "d").distinct().count()
    assert st.agg(F.sum("exitcount")).collect()[0][0] == sessions
    tr = PT.transitions(i.page)
    out = tr.groupBy("from_activity").agg(F.sum("count").alias("n"))
    views = i.page.groupBy(F.col("activity").alias("from_activity")).agg(F.count(F.lit(1)).alias("v"))
    for r in out.join(views, "from_activity").collect():
        assert r.n == r.v


def test_cohort_total_row_is_distinct_new_devices(inputs_mid):
    i = inputs_mid
    cs = RT.cohort_size(i.launch, i.active, "day")
    tot = cs.where("product_id = -1").groupBy().agg(F.sum("usercount")).collect()[0][0]
    firsts = K.only_active(K.first_launch(K.launch_rollup(i.launch), ["product_id"]), i.active)
    per_day = firsts.groupBy("d").agg(F.countDistinct("device_id").alias("n")).agg(F.sum("n")).collect()[0][0]
    assert tot == per_day


def test_histogram_totals_equal_devices(inputs_mid):
    i = inputs_mid
    from usagelens.sources import registry as R
    h = K.launch_histogram(i.launch, R.LAUNCH_BUCKETS)
    total = h.agg(F.sum("devices")).collect()[0][0]
    dev_days = i.launch.select("product_id", "channel_id", "version", "d", "device_id").distinct().count()
    assert total == dev_days


def test_shuffled_input_gives_same_result(spark, inputs_mid):
    i = inputs_mid
    base = K.daily_kpis(i.launch, i.page, i.active, "product")
    shuffled = i.launch.repartition(7, F.rand(seed=3)).orderBy(F.rand(seed=5))
    again = K.daily_kpis(shuffled, i.page, i.active, "product")
    assert base.exceptAll(again).count() == 0 and again.exceptAll(base).count() == 0
