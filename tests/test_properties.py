"""Property tests: Spark operators against straightforward Python
definitions on random small inputs."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from usagelens.operators import ingest as IN
from usagelens.operators import kpis as K

BASE = dt.datetime(2024, 1, 1)

events = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 4 * 86400)), min_size=1, max_size=40)


def _py_sessions(rows, gap):
    """device -> list of session numbers in (ts, id) order."""
    out = {}
    for dev in {r[0] for r in rows}:
        seq = sorted((t, i) for i, (d, t) in enumerate(rows) if d == dev)
        n, last, res = 0, None, {}
        for t, i in seq:
            if last is None or t - last > gap:
                n += 1
            res[i] = n
            last = t
        out.update(res)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=events, gap=st.sampled_from([30, 600, 7200, 30000]), bucket=st.sampled_from([60, 3600, 86400]))
def test_sessionize_matches_python(spark, rows, gap, bucket):
    data = [(i, 1, d, BASE + dt.timedelta(seconds=t), "k") for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, product_id int, device_id string, ts timestamp_ntz, app_key string")
    got = {r.id: r.session_id for r in
           IN.sessionize(df, gap, ["product_id", "device_id"], "ts", "app_key", "id", bucket).collect()}
    want = _py_sessions(rows, gap)
    # same partition of rows into sessions
    pairs_got = {(i, j) for i in got for j in got if got[i] == got[j] and rows[i][0] == rows[j][0]}
    pairs_want = {(i, j) for i in want for j in want if want[i] == want[j] and rows[i][0] == rows[j][0]}
    assert pairs_got == pairs_want


launches = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 6), st.sampled_from(["1.2", "1.9", "1.10"]),
                              st.integers(1, 2)), min_size=1, max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=launches)
def test_daily_kpis_match_python(spark, rows):
    data = [(i, 1, c, v, dev, BASE + dt.timedelta(days=day, hours=1), (BASE + dt.timedelta(days=day)).date(), 1)
            for i, (dev, day, v, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "launch_id long, product_id int, channel_id int, version string, "
                                     "device_id string, ts timestamp_ntz, d date, h int")
    got = {r.d: r for r in K.daily_kpis(df, None, None, "product").collect()}
    first = {}
    for i, (dev, day, v, c) in enumerate(rows):
        if dev not in first or (day, i) < first[dev]:
            first[dev] = (day, i)
    for day in {r[1] for r in rows}:
        d = (BASE + dt.timedelta(days=day)).date()
        todays = [(dev, v) for dev, dd, v, c in rows if dd == day]
        assert got[d].sessions == len(todays)
        assert got[d].startusers == len({t[0] for t in todays})
        assert got[d].newusers == sum(1 for f in first.values() if f[0] == day)
        upg = {dev for dev, v in todays
               if any(dev2 == dev and dd2 < day and v2 < v for dev2, dd2, v2, _ in rows)}
        assert got[d].upgradeusers == len(upg)


pages = st.lists(st.tuples(st.sampled_from(["s1", "s2"]), st.integers(0, 20000), st.sampled_from(["home", "list", "item"])),
                 min_size=1, max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=pages, bucket=st.sampled_from([60, 600, 86400]))
def test_transitions_match_python(spark, rows, bucket):
    from collections import Counter

    from usagelens.operators import paths as PT
    data = [(i, 1, 1, "1.2", s, a, BASE + dt.timedelta(seconds=t), BASE + dt.timedelta(seconds=t + 1), 1000,
             BASE.date()) for i, (s, t, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "view_id long, product_id int, channel_id int, version string, "
                                     "session_id string, activity string, start_ts timestamp_ntz, "
                                     "end_ts timestamp_ntz, duration_ms long, d date")
    got = Counter()
    for r in PT.transitions(df, bucket).collect():
        got[(r.from_activity, r.to_activity, r.jump)] += r["count"]
    want = Counter()
    for s in {r[0] for r in rows}:
        seq = sorted((t, i, a) for i, (ss, t, a) in enumerate(rows) if ss == s)
        for k, (_, _, a) in enumerate(seq):
            nxt = seq[k + 1][2] if k + 1 < len(seq) else "Exit"
            want[(a, nxt, k + 1)] += 1
    assert got == want
