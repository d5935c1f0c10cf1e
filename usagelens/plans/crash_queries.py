"""Crash analytics queries."""

from __future__ import annotations

from usagelens.operators import crashes as CR
from usagelens.plans.catalog import Inputs, query

CA = """ca AS (SELECT c.* FROM crash c JOIN active_channels a
       ON a.product_id = c.product_id AND a.channel_id = c.channel_id)"""


@query("crash_fact", """
SELECT crash_id, product_id, channel_id, version, os, brand, device_id, title, d, is_fixed FROM crash""")
def crash_fact(i: Inputs):
    """Crash fact with titles (first three stack lines)."""
    return i.crash.select("crash_id", "product_id", "channel_id", "version", "os", "brand", "device_id",
                          "title", "d", "is_fixed")


def _rate_oracle(by: str, top: int | None = None) -> str:
    q = f"""WITH {CA},
e AS (SELECT product_id, {by}, count(*) AS n FROM ca GROUP BY ALL),
l AS (SELECT product_id, {by}, count(*) AS n FROM launch GROUP BY ALL)
SELECT e.product_id, e.{by}, CAST(e.n AS BIGINT) AS errorcount, e.n / l.n AS percentage"""
    if top:
        q += (f", CAST(row_number() OVER (PARTITION BY e.product_id ORDER BY e.n DESC, e.{by}) AS INTEGER)"
              f" AS rank")
    q += f"\nFROM e LEFT JOIN l USING (product_id, {by})"
    if top:
        q += f"\nQUALIFY rank <= {top}"
    return q


@query("error_rate_version", _rate_oracle("version"))
def error_rate_version(i: Inputs):
    """Crashes and crashes per session by version."""
    return CR.error_rate(i.crash, i.launch, "version", i.active)


@query("error_rate_os", _rate_oracle("os"))
def error_rate_os(i: Inputs):
    """Crashes per launch by OS."""
    return CR.error_rate(i.crash, i.launch, "os", i.active)


@query("error_rate_brand", _rate_oracle("brand", 10))
def error_rate_brand(i: Inputs):
    """Top-10 brands by crash count with crashes per launch."""
    return CR.error_rate(i.crash, i.launch, "brand", i.active, top_n=10)


@query("error_series", f"""WITH {CA},
e AS (SELECT product_id, d, count(*) AS n FROM ca GROUP BY ALL),
t AS (SELECT product_id, count(*) AS s FROM launch GROUP BY ALL),
g AS (SELECT p.product_id, CAST(g.d AS DATE) AS d FROM (SELECT DISTINCT product_id FROM crash) p,
        (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM crash) g)
SELECT g.product_id, g.d, CAST(coalesce(e.n, 0) AS BIGINT) AS errorcount, coalesce(e.n, 0) / t.s AS per_session
FROM g LEFT JOIN e USING (product_id, d) LEFT JOIN t USING (product_id)""")
def error_series(i: Inputs):
    """Dense daily crash counts; divisor = sessions of the whole span."""
    return CR.error_series(i.crash, i.launch, i.active)


def _groups_oracle(by: str) -> str:
    return f"""WITH {CA}
SELECT product_id, title, {by}, CAST(count(*) AS BIGINT) AS errorcount, max(ts) AS last_seen,
  max(CAST(is_fixed AS INTEGER)) AS is_fixed, arg_max(stacktrace, ts) AS sample_stack
FROM ca GROUP BY product_id, title, {by}"""


for _by, _x in (("version", "X5"), ("os", "X6"), ("brand", "X7")):
    def _mk(by=_by, x=_x):
        @query(f"error_groups_{by}", _groups_oracle(by))
        def fn(i: Inputs):
            return CR.error_groups(i.crash, by, i.active)
        fn.__doc__ = f"{x}: crash groups title x {by}: count, last seen, fixed flag."
    _mk()


def _occ_oracle(by: str) -> str:
    return f"""SELECT product_id, title, {by}, crash_id, ts, device_id FROM crash
ORDER BY product_id, title, {by}, ts DESC, crash_id DESC"""


for _by in ("version", "os", "brand"):
    def _mk2(by=_by):
        @query(f"error_occurrences_{by}", _occ_oracle(by))
        def fn(i: Inputs):
            return CR.error_occurrences(i.crash, by)
        fn.__doc__ = f"X8: occurrences of every title per {by}, newest first."
    _mk2()


def _bd_oracle(by: str, within: str | None) -> str:
    keys = "product_id, title" + (f", {within}" if within else "")
    return f"""WITH c AS (SELECT {keys}, {by}, count(*) AS n FROM crash GROUP BY ALL)
SELECT {keys}, {by}, CAST(n AS BIGINT) AS count, n / sum(n) OVER (PARTITION BY {keys}) AS percentage FROM c"""


BREAKDOWNS = [("brand", "version", "X9"), ("brand", "os", "X10"), ("version", "brand", "X11"),
              ("os", "version", "X12"), ("version", "os", "X13"), ("os", "brand", "X14"),
              ("version", None, "X11/Q22"), ("os", None, "X14/Q22")]

for _by, _within, _x in BREAKDOWNS:
    def _mk3(by=_by, within=_within, x=_x):
        name = f"error_breakdown_{by}_in_{within or 'title'}"

        @query(name, _bd_oracle(by, within))
        def fn(i: Inputs):
            return CR.error_breakdown(i.crash, by, within)
        fn.__doc__ = f"{x}: share of each {by} within {within or 'the whole title'} for every title."
    _mk3()
