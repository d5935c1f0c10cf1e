"""Hand-written edge fixtures (ties, scopes, version order, windows, alerts,
sessions, segments)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from usagelens.operators import events as EV
from usagelens.operators import ingest as IN
from usagelens.operators import kpis as K
from usagelens.operators import paths as PT
from usagelens.operators import trend as TR

LAUNCH_SCHEMA = ("launch_id long, product_id int, channel_id int, version string, device_id string, "
                 "ts timestamp_ntz, d date, h int")


def _launch(spark, rows):
    out = []
    for lid, p, c, v, dev, ts in rows:
        t = dt.datetime.fromisoformat(ts)
        out.append((lid, p, c, v, dev, t, t.date(), t.hour))
    return spark.createDataFrame(out, LAUNCH_SCHEMA)


def test_first_launch_tie_breaks_on_id(spark):
    df = _launch(spark, [(2, 1, 1, "1.2", "a", "2024-01-01 10:00:00"),
                         (1, 1, 1, "1.2", "a", "2024-01-01 10:00:00")])
    flags = {r.launch_id: r.is_new for r in K.flag_new(df).collect()}
    assert flags == {1: 1, 2: 0}


def test_new_flags_per_scope(spark):
    df = _launch(spark, [(1, 1, 1, "1.2", "a", "2024-01-01 10:00:00"),
                         (2, 1, 2, "1.2", "a", "2024-01-02 10:00:00"),
                         (3, 2, 1, "1.2", "a", "2024-01-03 10:00:00")])
    f = K.flag_new(K.flag_new(df, ["product_id"], "n_p"), ["product_id", "channel_id"], "n_c")
    got = {r.launch_id: (r.n_p, r.n_c) for r in f.collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (1, 1)}


def test_upgrade_is_lexicographic(spark):
    df = _launch(spark, [(1, 1, 1, "1.2", "a", "2024-01-01 10:00:00"),
                         (2, 1, 1, "1.9", "a", "2024-01-02 10:00:00"),   # 1.2 -> 1.9: upgrade
                         (3, 1, 1, "1.9", "b", "2024-01-01 10:00:00"),
                         (4, 1, 1, "1.10", "b", "2024-01-02 10:00:00"),  # '1.10' < '1.9': not one
                         (5, 1, 1, "1.9", "c", "2024-01-02 09:00:00"),
                         (6, 1, 1, "1.2", "c", "2024-01-02 10:00:00")])  # same day: not one
    k = {r.d: r.upgradeusers for r in K.daily_kpis(df, None, None, "product").collect()}
    assert k[dt.date(2024, 1, 2)] == 1


def test_allusers_is_running_sum_of_new(spark):
    df = _launch(spark, [(1, 1, 1, "1.2", "a", "2024-01-01 10:00:00"),
                         (2, 1, 1, "1.2", "b", "2024-01-03 10:00:00"),
                         (3, 1, 1, "1.2", "a", "2024-01-03 11:00:00")])
    k = sorted(K.daily_kpis(df, None, None, "product").collect(), key=lambda r: r.d)
    assert [(r.newusers, r.allusers, r.startusers, r.allsessions) for r in k] == [(1, 1, 1, 1), (1, 2, 2, 3)]


def test_forecast_needs_five_days_and_alert_rules(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(7)]
    vals = [10, 10, 10, 10, 10, 13, 10]
    s = spark.createDataFrame([(1, d, v) for d, v in zip(days, vals)], "product_id int, d date, x long")
    fc = TR.forecast(s, ["x"]).orderBy("d").collect()
    assert [r.d for r in fc] == days[5:]
    assert fc[0].x_forecast == 10.0 and fc[1].x_forecast == 10.6
    short = spark.createDataFrame([(1, d, 1) for d in days[:5]], "product_id int, d date, x long")
    assert TR.forecast(short, ["x"]).count() == 0
    rules = spark.createDataFrame([(1, "x", 30.0, 1)], "product_id int, metric string, condition double, active int")
    hits = TR.alerts(s, rules, ["x"]).collect()
    assert [(h.d, h.deviation_pct) for h in hits] == [(days[5], 30.0)]
    zero = spark.createDataFrame([(1, d, v) for d, v in zip(days, [0, 0, 0, 0, 0, 3, 0])],
                                 "product_id int, d date, x long")
    zr = spark.createDataFrame([(1, "x", 101.0, 1)], "product_id int, metric string, condition double, active int")
    assert [h.d for h in TR.alerts(zero, zr, ["x"]).collect()] == [days[5]]


def test_one_page_session_and_exit_ties(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [(1, 1, 1, "1.2", "s1", "home", t, t + dt.timedelta(seconds=5), 5000, t.date()),
            (2, 1, 1, "1.2", "s2", "home", t, t + dt.timedelta(seconds=5), 5000, t.date()),
            (3, 1, 1, "1.2", "s2", "list", t + dt.timedelta(seconds=1), t + dt.timedelta(seconds=5), 4000, t.date())]
    pages = spark.createDataFrame(rows, "view_id long, product_id int, channel_id int, version string, "
                                        "session_id string, activity string, start_ts timestamp_ntz, "
                                        "end_ts timestamp_ntz, duration_ms long, d date")
    tr = {(r.from_activity, r.to_activity, r.jump): r["count"] for r in PT.transitions(pages).collect()}
    assert tr == {("home", "Exit", 1): 1, ("home", "list", 1): 1, ("list", "Exit", 2): 1}
    exits = {(r.product_id, r.activity) for r in PT.page_exits(pages).collect()}
    assert exits == {(1, "home"), (1, "list")}   # s2 tie on end time -> greater id (list)


def test_sessionize_gap(spark):
    base = dt.datetime(2024, 1, 1, 10)
    rows = [(1, 1, "a", base, "k"), (2, 1, "a", base + dt.timedelta(seconds=30), "k"),
            (3, 1, "a", base + dt.timedelta(seconds=61), "k")]
    df = spark.createDataFrame(rows, "id long, product_id int, device_id string, ts timestamp_ntz, app_key string")
    s = {r.id: r.session_id for r in IN.sessionize(df, 30, ["product_id", "device_id"], "ts", "app_key", "id").collect()}
    assert s[1] == s[2] != s[3]


def test_segment_filter_and_or(spark):
    df = spark.createDataFrame([("a", "1.9", 1, "R1"), ("b", "1.2", 1, "R1"), ("c", "1.9", 3, "R1")],
                               "device_id string, version string, channel_id int, region string") \
        .withColumn("product_id", F.lit(1))
    names = spark.createDataFrame([(1, 1, "store"), (1, 3, "web"), (2, 3, "store")], "product_id int, channel_id int, channel_name string")
    tags = '[{"type":"version","value":["1.9","1.10"]},{"type":"channel","value":["store"]}]'
    assert [r.device_id for r in TR.segment(df, tags, names).collect()] == ["a"]
    for none in ('[]', '[{"type":"version","value":[]}]', '[{"type":"channel","value":null},{"type":"region"}]'):
        assert TR.segment(df, none, names).count() == 3


def test_amount_and_required_checks(spark):
    df = spark.createDataFrame([("23",), ("23.3",), ("-23.3",), ("",), (None,), ("many",)], "acc string")
    good, bad = IN.validate_amount(df)
    assert sorted(r.acc for r in good.collect()) == ["23", "23.3"]
    assert bad.count() == 4
    req = spark.createDataFrame([("k", None), ("k", "x"), ("k", "")], "appkey string, deviceid string")
    g, b = IN.validate(req, ["appkey", "deviceid"])
    assert g.count() == 2 and [r.reject_reason for r in b.collect()] == ["deviceid"]


def test_time_repair(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("junk",), ("1969-12-31 23:59:59",), ("2024-01-05T10:00:00",),
                                ("2024/01/05 10:00:00",), ("2024-01-05",)], "t string") \
        .withColumn("ingest_ts", F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"))
    got = [r.ts for r in IN.repair_time(df, "t", out="ts").collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 5, 10),
                   dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5)]


def test_crash_title_rule(spark):
    df = spark.createDataFrame([("a\nb\nc\nd",), ("only",), ("a\nb",)], "s string")
    assert [r.title for r in IN.crash_title(df, "s").collect()] == ["a\nb\nc", "only", "a"]


def test_location_range_join(spark):
    ranges = spark.createDataFrame([(16777216, 16777471, "AU", "R", "C"), (3232235520, 3232301055, "LAN", "", "")],
                                   "lo long, hi long, country string, region string, city string")
    df = spark.createDataFrame([("1.0.0.5",), ("192.168.1.1",), ("8.8.8.8",)], "ip string")
    got = {r.ip: r.country for r in IN.enrich_location(df, ranges).collect()}
    assert got == {"1.0.0.5": "AU", "192.168.1.1": "LAN", "8.8.8.8": ""}


def test_funnel_steps_independent_counts(spark):
    fact = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1))] * 4 + [(1, 2, dt.date(2024, 1, 1))] * 3,
                                 "product_id int, event_id int, d date")
    from decimal import Decimal
    fun = spark.createDataFrame([(1, 9, "f", Decimal("2.50"), 1, 1, "a"), (1, 9, "f", Decimal("2.50"), 2, 2, "b"),
                                 (1, 9, "f", Decimal("2.50"), 3, 3, "c")],
                                "product_id int, funnel_id int, funnel_name string, unit_price decimal(12,2), "
                                "seq int, event_id int, alias string")
    steps = {r.step: (r["count"], r.pct_of_first) for r in EV.funnel_steps(fact, fun).collect()}
    assert steps == {1: (4, 100.0), 2: (3, 75.0), 3: (0, 0.0)}
    s = EV.funnel_summary(fact, fun).collect()[0]
    assert (s.start_count, s.end_count, s.value) == (4, 0, 0.0)


def test_upsert_latest_wins(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "B", 20), (3, "c", 3)], "k int, v string, n int")
    got = sorted(tuple(r) for r in IN.upsert(old, new, ["k"]).collect())
    assert got == [(1, "a", 1), (2, "B", 20), (3, "c", 3)]
    again = sorted(tuple(r) for r in IN.upsert(IN.upsert(old, new, ["k"]), new, ["k"]).collect())
    assert again == got


def test_export_csv_quotes_and_zero_fill(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1), ('say "hi"', None), ("", 3)], "name string, n int")
    out = str(tmp_path / "csv")
    IN.export_csv(df, out)
    import glob
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(out + "/part-*.csv")))
    assert text.splitlines()[0] == "name,n"
    assert '"a,b",1' in text and '"say ""hi""",0' in text and "0,3" in text


def test_run_log_observes_rows(spark):
    df, obs = IN.run_log(spark.range(42).toDF("x"), "op")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 42


def test_sync_event_dim_and_rule_select(spark):
    from usagelens.operators import dims as DM
    from usagelens.sources.registry import local_table
    dim = local_table(spark, [(1, 1, "signup", "Sign up", 1), (1, 2, "view", "View", 1)],
                      "product_id int, event_id int, event_identifier string, event_name string, active int")
    defs = local_table(spark, [(1, 2, "view", None, 0), (1, 3, "click", "Click", 1)],
                       "product_id int, event_id int, event_identifier string, event_name string, active int")
    got = {r.event_id: (r.event_name, r.active) for r in DM.sync_event_dim(dim, defs).collect()}
    assert got == {1: ("Sign up", 1), 2: (None, 0), 3: ("Click", 1)}
    rules = local_table(spark, [(1, "x", 20.0, 1), (1, "x", 50.0, 1)],
                        "product_id int, metric string, condition double, active int")
    assert [r.condition for r in TR.select_rule(rules, 1, "x", 20.0004).collect()] == [20.0]
    k = spark.range(1).select(DM.surrogate_key(F.lit(1), F.lit("a")).alias("k")).collect()[0].k
    assert isinstance(k, int)


def test_local_table_escapes_and_types(spark):
    from usagelens.sources.registry import local_table
    rows = [(1, "it's\na", dt.date(2024, 1, 2), None)]
    r = local_table(spark, rows, "id int, s string, d date, x decimal(12,2)").collect()[0]
    assert (r.id, r.s, r.d, r.x) == (1, "it's\na", dt.date(2024, 1, 2), None)


def test_natural_version_order_and_key_normalisation(spark):
    df = _launch(spark, [(3, 1, 1, "1.9", "b", "2024-01-01 10:00:00"),
                         (4, 1, 1, "1.10", "b", "2024-01-02 10:00:00")])
    lex = {r.d: r.upgradeusers for r in K.daily_kpis(df, None, None, "product").collect()}
    nat = {r.d: r.upgradeusers for r in K.daily_kpis(df, None, None, "product", version_order="natural").collect()}
    assert lex[dt.date(2024, 1, 2)] == 0 and nat[dt.date(2024, 1, 2)] == 1
    keys = spark.createDataFrame([("Brand ",), ("brand",)], "b string")
    assert K.normalize_keys(keys, ["b"]).distinct().count() == 1


def test_rollup_totals_use_grouping_not_values(spark):
    from usagelens.operators import retention as RT
    df = _launch(spark, [(1, 1, 1, "1.2", "a", "2024-01-01 10:00:00"),
                         (2, 1, 1, None, "b", "2024-01-01 11:00:00"),
                         (3, 1, 1, "all", "c", "2024-01-01 12:00:00")])
    from collections import defaultdict
    rows = defaultdict(list)
    for r in RT.cohort_size(df, None, "day").collect():
        rows[(r.product_id, r.version, r.channel)].append(r.usercount)
    assert rows[(1, None, "1")] == [1]                  # NULL version is its own group
    # the product total (grouping, 3 devices) and the (product, version='all')
    # group of the device whose version is literally 'all' (1) are separate rows
    assert sorted(rows[(1, "all", "all")]) == [1, 3]
    assert rows[(-1, "all", "all")] == [3]              # grand total


def test_malformed_payload_values_do_not_fail_the_job(spark):
    raw = spark.createDataFrame(
        [(1, '{"appkey":"key-1-1","session_id":"s","start_millis":"2024-01-01 00:00:00",'
             '"end_millis":"2024-01-01 00:00:01","duration":"abc","activities":"home"}',
          dt.datetime(2024, 1, 2))], "payload_id long, payload string, ingest_ts timestamp_ntz")
    from usagelens.sources import registry as R
    rows, _ = IN.ingest_page(raw, R.channels(spark))
    assert rows.collect()[0].duration_ms is None
    bad = ["10.x.1.2", "::1", "1.2.3", "1.2.3.4.5", "256.1.1.1", "", None]
    ips = spark.createDataFrame([("10.0.1.2",), *[(b,) for b in bad]], "ip string").select(IN.ip_to_long(F.col("ip")).alias("v"))
    assert [r.v for r in ips.collect()] == [(10 << 24) + (1 << 8) + 2] + [None] * len(bad)


def test_marker_visibility_and_counts(spark):
    from usagelens.sources import registry as R
    m = R.markers(spark)
    own_range = {r.marker_id for r in TR.visible_markers(m, 1, 1, "2024-01-01", "2024-01-15").collect()}
    assert own_range == {1, 3}                  # own marker in range + other's public marker in range
    quirk = {r.marker_id for r in TR.visible_markers(m, 1, 1, "2024-01-01", "2024-01-10",
                                                      others_ignore_range=True).collect()}
    assert quirk == {1, 3}                      # other's public marker shown outside the range (Q14)
    counts = {r.user_id: r.markers for r in TR.marker_counts(m, 1, 1, "2024-01-01", "2024-01-31").collect()}
    assert counts == {1: 2, 2: 1}


def test_extend_dim_null_safe_and_fact_rejects(spark):
    from usagelens.operators import dims as DM
    from usagelens.operators import facts as FA
    from usagelens.sources.registry import local_table
    dim = local_table(spark, [("A", "x"), (None, "y")], "country string, region string")
    src = local_table(spark, [("A", "x"), (None, "y"), (None, "z"), ("B", "x"), ("B", "x")],
                      "country string, region string")
    new = [tuple(r) for r in DM.extend_dim(dim, src, ["country", "region"]).collect()]
    assert len(new) == 2 and set(new) == {("B", "x"), (None, "z")}   # (None, "y") is known
    pdim = local_table(spark, [(1, 1, "1.2", 1, 1, 1)],
                       "product_id int, channel_id int, version string, product_active int, "
                       "channel_active int, version_active int")
    rows = local_table(spark, [(1, 1, 1, "1.2", dt.datetime(2024, 1, 1, 3)), (2, 1, 1, "9.9", dt.datetime(2024, 1, 1, 4))],
                       "launch_id long, product_id int, channel_id int, version string, ts timestamp_ntz")
    fact, rej = FA.build_launch_fact(rows, pdim)
    assert [(r.launch_id, r.h, r.active) for r in fact.collect()] == [(1, 3, True)]
    assert [r.launch_id for r in rej.collect()] == [2]


def test_edge_days_without_launches_stay(spark):
    """Days that only have page time, at either edge of the launches, belong to the KPI span."""
    from usagelens.functions.densify import densify
    day = lambda n: dt.date(2024, 1, n)
    launch = spark.createDataFrame([(1, 1, day(2))], "product_id int, channel_id int, d date")
    page = spark.createDataFrame([(1, 1, day(1)), (1, 1, day(3)), (1, 9, day(9))], "product_id int, channel_id int, d date")
    active = spark.createDataFrame([(1, 1)], "product_id int, channel_id int")
    days = K.only_active(launch, active).unionAll(K.only_active(page, active)).select("d")
    kpi = spark.createDataFrame([(1, day(1), 0), (1, day(2), 5), (1, day(3), 0)], "product_id int, d date, sessions int")
    got = [(r.d, r.sessions) for r in densify(kpi, ["product_id"], ["sessions"], span_src=days).orderBy("d").collect()]
    assert got == [(day(1), 0), (day(2), 5), (day(3), 0)]


def test_active_test_needs_its_keys(spark):
    import pytest
    rows = spark.createDataFrame([(1, 1)], "product_id int, channel_id int")
    registry = spark.createDataFrame([(1, 1, "1.9")], "product_id int, channel_id int, version string")
    with pytest.raises(ValueError, match="version"):
        K.only_active(rows, registry)
    assert K.only_active(rows, registry, ["product_id", "channel_id"]).count() == 1


def test_fractional_metrics_keep_their_fractions(spark):
    days = [dt.date(2024, 1, n) for n in range(1, 8)]
    series = spark.createDataFrame([(1, d, 0.5) for d in days[:-1]] + [(1, days[-1], 0.75)], "product_id int, d date, x double")
    rules = spark.createDataFrame([(1, "x", 20.0, 1)], "product_id int, metric string, condition double, active int")
    assert [(r.d, r.fact, r.deviation_pct) for r in TR.alerts(series, rules, ["x"]).collect()] == [(days[-1], 0.75, 50.0)]


def test_narrowest_of_overlapping_ranges(spark):
    ips = spark.createDataFrame([(1, "10.0.0.5"), (2, "10.0.9.5"), (3, "11.0.0.1")], "id int, ip string")
    base = 10 << 24
    rng = spark.createDataFrame([(base, base + 65535, "A", "wide", ""), (base, base + 255, "A", "narrow", "")],
                                "lo long, hi long, country string, region string, city string")
    assert sorted((r.id, r.region) for r in IN.enrich_location(ips, rng).collect()) == [(1, "narrow"), (2, "wide"), (3, "")]


def test_batch_items_keep_id_and_time(spark):
    raw = spark.createDataFrame([(7, '{"appkey":"k","clientData":[{"time":"junk"},{"time":"x","appkey":"own"}],"errorInfo":[{"a":"b"}]}',
                                  dt.datetime(2024, 1, 2))], "payload_id long, payload string, ingest_ts timestamp_ntz")
    parts = IN.explode_batch(raw)
    got = sorted((r.payload_id, r.item_no, r.ingest_ts, r.payload) for r in parts["launch"].collect())
    assert [(g[0], g[1], g[2]) for g in got] == [(7, 0, dt.datetime(2024, 1, 2)), (7, 1, dt.datetime(2024, 1, 2))]
    assert '"own"' in got[1][3] and parts["crash"].count() == 1 and parts["page"].count() == 0


def test_a_rewritten_file_gives_new_numbers(spark, tmp_path):
    """Staged tables follow their input's files, not only their names."""
    import shutil

    from usagelens.plans import catalog
    run = catalog.spark_callables()["kpi_daily_product"]
    for t in ("events", "nation", "region"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    total = lambda: run(spark, str(tmp_path)).agg(F.sum("sessions")).first()[0]
    first = total()
    import pyarrow.parquet as pq
    half = pq.read_table(tmp_path / "events.parquet").slice(0, first // 2)
    pq.write_table(half, tmp_path / "events.parquet")
    assert total() == first // 2


def test_densify_keeps_a_null_key(spark):
    from usagelens.functions.densify import densify
    rows = spark.createDataFrame([(1, None, "2024-01-01", 3), (1, "1.0", "2024-01-03", 4), (1, None, "2024-01-03", 5)], "p int, v string, d string, n int") \
        .withColumn("d", F.col("d").cast("date"))
    got = sorted(((r.v or "", str(r.d), r.n) for r in densify(rows, ["p", "v"], ["n"]).collect()))
    assert got == [("", "2024-01-01", 3), ("", "2024-01-02", 0), ("", "2024-01-03", 5),
                   ("1.0", "2024-01-01", 0), ("1.0", "2024-01-02", 0), ("1.0", "2024-01-03", 4)]
