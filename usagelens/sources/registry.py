"""App registry and other small administrative inputs.

These are configuration tables (apps, channels, event definitions, funnels,
alert rules, chart markers, carrier codes, bucket bounds).  They are bounded
by what administrators define, not by traffic, so joins against them are
planned as broadcast hash joins by Catalyst's own size estimate of the local
relation -- no hint is needed and none is forced.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Fixed values (test registry; a deployment passes its own tables)
# ---------------------------------------------------------------------------
PRODUCTS = [  # product_id, product_name, owner_id, platform, product_active
    (1, "app1", 1, "android", 1),
    (2, "app2", 1, "ios", 1),
    (3, "app3", 2, "android", 1),
]
CHANNEL_IDS = [1, 2, 3, 4]
INACTIVE_CHANNELS = {4}
EVENT_DEFS = [  # event_id, event_identifier, event_name, active
    (1, "signup", "Sign up", 1),
    (2, "view", "View", 1),
    (3, "click", "Click", 1),
    (4, "purchase", "Purchase", 1),
    (5, "error", "Error", 0),
]
FUNNELS = [  # funnel_id, funnel_name, unit_price, [(seq, event_id, alias)]
    (1, "signup to purchase", "2.50", [(1, 1, "sign up"), (2, 2, "view"), (3, 3, "click"), (4, 4, "buy")]),
    (2, "view to purchase", "10.00", [(1, 2, "view"), (2, 4, "buy")]),
]
ALERT_METRICS = ["newusers", "startusers", "sessions", "allusers", "usingtime"]
ALERT_CONDITIONS = [5, 20, 50]
MARKERS = [  # marker_id, user_id, product_id, marker date, title, private
    (1, 1, 1, "2024-01-05", "release 1.9", 0),
    (2, 1, 1, "2024-01-21", "release 1.10", 1),
    (3, 2, 1, "2024-01-12", "campaign", 1),
]
# carrier codes: mcc+mnc -> carrier name
MCCMNC = [
    ("46000", "China Mobile"),
    ("46001", "China Unicom"),
    ("46002", "China Mobile"),
    ("46003", "China Telecom"),
    ("310SP", "China Telecom"),
]
# launches per device per day, closed ranges; None = open end
LAUNCH_BUCKETS = [(1, "1-2", 1, 2), (2, "3-5", 3, 5), (3, "6-9", 6, 9),
                  (4, "10-19", 10, 19), (5, "20-49", 20, 49), (6, "50", 50, None)]
# session length in ms, [start, end); None = open end
USAGE_BUCKETS = [(1, "0-3", 0, 3000), (2, "3-10", 3000, 10000), (3, "10-30", 10000, 30000),
                 (4, "30-60", 30000, 60000), (5, "1-3", 60000, 180000),
                 (6, "3-10", 180000, 600000), (7, "10-30", 600000, 1800000),
                 (8, "30", 1800000, None)]


def _sql_literal(v) -> str:
    import datetime as dt
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    if isinstance(v, Decimal):
        return f"{v}BD"
    if isinstance(v, dt.datetime):          # before date: datetime subclasses date
        return f"TIMESTAMP_NTZ'{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE'{v.isoformat()}'"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{text}'"


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A configuration table as an inline ``VALUES`` relation.

    Unlike a DataFrame made from a Python list (an RDD scan without
    statistics), a local relation carries its exact size, so Catalyst and AQE
    broadcast it only because its measured size is under the threshold.
    """
    import re
    cols = [c.strip().split(" ", 1) for c in re.split(r",(?![^()]*\))", ddl)]
    names = [c[0] for c in cols]
    sel = ", ".join(f"CAST({n} AS {t.strip()}) AS {n}" for n, t in cols)
    if not rows:
        return spark.sql(f"SELECT {sel} FROM VALUES ({', '.join('NULL' for _ in names)}) "
                         f"AS t({', '.join(names)}) WHERE false")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {sel} FROM VALUES {values} AS t({', '.join(names)})")


def products(spark: SparkSession) -> DataFrame:
    return local_table(spark,
        PRODUCTS, "product_id int, product_name string, owner_id int, platform string, product_active int")


def channels(spark: SparkSession) -> DataFrame:
    """(product, channel) registry with activity flags and the app key."""
    rows = [(p[0], c, f"ch{c}", f"key-{p[0]}-{c}", p[4], 0 if c in INACTIVE_CHANNELS else 1)
            for p in PRODUCTS for c in CHANNEL_IDS]
    return local_table(spark,
        rows, "product_id int, channel_id int, channel_name string, app_key string, "
              "product_active int, channel_active int")


def active_channels(spark: SparkSession) -> DataFrame:
    """Keys of registry rows whose product and channel flags are both on."""
    return (channels(spark).where("product_active = 1 AND channel_active = 1")
            .select("product_id", "channel_id"))


def event_defs(spark: SparkSession) -> DataFrame:
    rows = [(p[0], e[0], e[1], e[2], e[3]) for p in PRODUCTS for e in EVENT_DEFS]
    return local_table(spark,
        rows, "product_id int, event_id int, event_identifier string, event_name string, active int")


def funnels(spark: SparkSession) -> DataFrame:
    """One row per funnel step (funnels defined for every product)."""
    rows = [(p[0], f[0], f[1], Decimal(f[2]), s[0], s[1], s[2])
            for p in PRODUCTS for f in FUNNELS for s in f[3]]
    return local_table(spark,
        rows, "product_id int, funnel_id int, funnel_name string, unit_price decimal(12,2), "
              "seq int, event_id int, alias string")


def alert_rules(spark: SparkSession) -> DataFrame:
    rows = [(p[0], m, float(ALERT_CONDITIONS[(i + p[0]) % 3]), 1)
            for p in PRODUCTS for i, m in enumerate(ALERT_METRICS)]
    return local_table(spark, rows, "product_id int, metric string, condition double, active int")


def markers(spark: SparkSession) -> DataFrame:
    import datetime as dt
    rows = [(m[0], m[1], m[2], dt.date.fromisoformat(m[3]), m[4], m[5]) for m in MARKERS]
    return local_table(spark,
        rows, "marker_id int, user_id int, product_id int, d date, title string, private int")


def mccmnc(spark: SparkSession) -> DataFrame:
    return local_table(spark, MCCMNC, "code string, carrier string")


def launch_buckets(spark: SparkSession) -> DataFrame:
    return local_table(spark, LAUNCH_BUCKETS, "bucket_id int, bucket string, lo bigint, hi bigint")


def usage_buckets(spark: SparkSession) -> DataFrame:
    return local_table(spark, USAGE_BUCKETS, "bucket_id int, bucket string, lo bigint, hi bigint")
