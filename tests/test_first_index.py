"""The kept first-launch index: equal to a full recompute, and only touched buckets are opened or written."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from usagelens.operators import first_index as FI
from usagelens.operators.kpis import flag_new
from usagelens.streaming.jobs import work_dir

SCHEMA = "launch_id long, product_id int, channel_id int, device_id string, d date"


def launches(seed, n=400, devices=60):
    rng = random.Random(seed)
    day = dt.date(2024, 1, 1)
    return [(i, rng.randrange(3), rng.randrange(4), rng.choice([f"d{rng.randrange(devices)}"] * 20 + [None]),
             day + dt.timedelta(days=rng.randrange(20))) for i in range(n)]


def brute(rows, channel=False):
    first = {}
    for r in rows:
        key = (r[1], r[2], r[3]) if channel else (r[1], r[3])
        if key not in first or (r[4], r[0]) < first[key]:
            first[key] = (r[4], r[0])
    return {v[1] for v in first.values()}


@pytest.mark.parametrize("channel", [False, True])
def test_updates_equal_a_recompute(spark, channel):
    rows = launches(1)
    random.Random(9).shuffle(rows)
    scope = ["product_id", "channel_id"] if channel else ["product_id"]
    index = FI.FirstLaunchIndex(spark, work_dir(spark, "index"), scope, ["channel_id"], n_buckets=16)
    flagged: dict = {}
    for epoch in range(4):
        part = rows[epoch * 100:(epoch + 1) * 100]
        for c in index.update(spark.createDataFrame(part, SCHEMA), epoch).collect():
            if c.old is not None:
                assert flagged.pop(c.old.launch_id) == (c.product_id, c.device_id)
            flagged[c.launch_id] = (c.product_id, c.device_id)
        assert set(flagged) == brute(rows[:(epoch + 1) * 100], channel)
        assert {r.launch_id for r in index.read().collect()} == set(flagged)
    # daily counts kept by the corrections' deltas alone
    kept = FI.new_user_deltas(index.corrections(), ["product_id"])
    df = spark.createDataFrame([r for r in rows if r[3] is not None], SCHEMA)
    full = flag_new(df, scope).where("is_new = 1").groupBy("product_id", "d").count()
    nulls = {r[1]: min((x[4], x[0]) for x in rows if x[1] == r[1] and x[3] is None) for r in rows if r[3] is None}
    if not channel:
        want = {(r.product_id, r.d): r["count"] for r in full.collect()}
        for p, (d, _) in nulls.items():
            want[p, d] = want.get((p, d), 0) + 1
        assert {(r.product_id, r.d): r.newusers for r in kept.collect()} == want


def test_a_replayed_epoch_changes_nothing(spark):
    rows = launches(3)
    index = FI.FirstLaunchIndex(spark, work_dir(spark, "index"), n_buckets=8)
    index.update(spark.createDataFrame(rows[:200], SCHEMA), 0)
    once = sorted(map(str, index.update(spark.createDataFrame(rows[200:], SCHEMA), 1).collect()))
    again = sorted(map(str, index.update(spark.createDataFrame(rows[200:], SCHEMA), 1).collect()))
    assert once == again and {r.launch_id for r in index.read().collect()} == brute(rows)


def test_only_touched_buckets_are_opened_and_written(spark, monkeypatch):
    rows = launches(5, 600, 300)
    index = FI.FirstLaunchIndex(spark, work_dir(spark, "index"), n_buckets=32)
    index.update(spark.createDataFrame(rows, SCHEMA), 0)
    assert len(index.generations()) == 32
    opened = []
    real = index._open
    monkeypatch.setattr(index, "_open", lambda g, b=None: opened.append(b) or real(g, b))
    known = next(r for r in rows if r[3] is not None)
    early = (10_000, known[1], 0, known[3], dt.date(2023, 12, 1))        # moves a flag
    no_change = (10_001, rows[5][1], 0, rows[5][3], dt.date(2024, 6, 1))  # later than the device's first
    out = index.update(spark.createDataFrame([early, no_change], SCHEMA), 1).collect()
    assert [(r.launch_id, r.old is not None) for r in out] == [(10_000, True)]
    touched, changed = opened[0], opened[1]
    assert len(touched) <= 2 and len(changed) == 1
    assert {b for b, g in index.generations().items() if g == 1} == changed
    assert index.update(spark.createDataFrame([no_change], SCHEMA), 2).isEmpty()
    assert 2 not in index.generations().values()


def test_filter_never_misses_and_thins(spark):
    keys = ["product_id", "device_id"]
    rows = spark.range(4000).select((F.col("id") % 3).cast("int").alias("product_id"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("device_id"))
    half = rows.where("substring(device_id, 2) % 2 = 0").unionAll(spark.createDataFrame([(None, None)], "product_id int, device_id string"))
    marked = rows.unionAll(spark.createDataFrame([(None, None)], "product_id int, device_id string")).withColumn("hit", FI.might_contain(FI.bloom_filter(half, keys), keys))
    in_half = F.col("device_id").isNull() | (F.substring("device_id", 2, 9).cast("int") % 2 == 0)
    assert marked.where(in_half & ~F.col("hit")).isEmpty()
    assert marked.where(~in_half & F.col("hit")).count() < 20


def test_reflag_touches_only_days_concerned(spark):
    rows = [(1, 1, 1, "a", dt.date(2024, 1, 5)), (2, 1, 1, "a", dt.date(2024, 1, 7)), (3, 1, 1, "b", dt.date(2024, 1, 9))]
    index = FI.FirstLaunchIndex(spark, work_dir(spark, "index"), n_buckets=4)
    index.update(spark.createDataFrame(rows, SCHEMA), 0)
    late = [(4, 1, 1, "a", dt.date(2024, 1, 3)), (5, 1, 1, "b", dt.date(2024, 1, 10))]
    fixed = index.update(spark.createDataFrame(late, SCHEMA), 1)
    fact = spark.createDataFrame([(*r, int(r[0] in (1, 3))) for r in rows] + [(*r, 0) for r in late], SCHEMA + ", is_new int")
    assert sorted((r.launch_id, r.is_new) for r in FI.reflag(fact, fixed).collect()) == [(1, 0), (4, 1)]


def test_empty_update_and_rows_without_day(spark):
    index = FI.FirstLaunchIndex(spark, work_dir(spark, "index"), n_buckets=4)
    assert index.update(spark.createDataFrame([], SCHEMA), 0).isEmpty() and index.read() is None
    index.update(spark.createDataFrame([(9, 1, 1, "a", None), (8, 1, 1, None, None)], SCHEMA), 1)
    index.update(spark.createDataFrame([(10, 1, 1, "a", dt.date(2024, 1, 1))], SCHEMA), 2)
    assert sorted(r.launch_id for r in index.read().collect()) == [8, 10]
