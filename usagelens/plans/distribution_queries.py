"""Attribute distributions (three forms per attribute), counts, API and
display forms, and the two engagement histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from usagelens.operators import distribution as DI
from usagelens.plans.catalog import Inputs, query
from usagelens.plans.kpi_queries import FLAGGED
from usagelens.sources import registry as R

ATTRS = ["brand", "os", "carrier", "network", "resolution", "country"]
TOP = 10


def dist_oracle(attr: str, new_only: bool, top_n: int | None, by: list[str] = ("product_id",),
                numerator_flagless: bool = False) -> str:
    denom = DI.DEFAULT_DENOM.get(attr, "pairs")
    byc = ", ".join(by)
    src = "(SELECT * FROM fl WHERE isnew = 1)" if new_only else "launch"
    den_cols = f"{byc}, {attr}, device_id" if denom == "pairs" else f"{byc}, device_id"
    num_src = "rw" if numerator_flagless else "fa"
    qual = f"\nQUALIFY rank <= {top_n}" if top_n else ""
    return f"""WITH {FLAGGED.strip()},
rw AS (SELECT * FROM {src}),
fa2 AS (SELECT r.* FROM rw r JOIN active_channels a ON a.product_id = r.product_id
        AND a.channel_id = r.channel_id),
num AS (SELECT {byc}, {attr}, count(DISTINCT device_id) AS devices
        FROM {num_src.replace('fa', 'fa2')} GROUP BY {byc}, {attr}),
den AS (SELECT {byc}, count(*) AS total FROM (SELECT DISTINCT {den_cols} FROM fa2) GROUP BY {byc})
SELECT {', '.join('num.' + c for c in by)}, num.{attr}, CAST(num.devices AS BIGINT) AS devices,
  CAST(den.total AS BIGINT) AS total, num.devices / den.total AS percentage,
  CAST(row_number() OVER (PARTITION BY {', '.join('num.' + c for c in by)}
                          ORDER BY num.devices DESC, num.{attr}) AS INTEGER) AS rank
FROM num LEFT JOIN den USING ({byc}){qual}"""


def _register(attr: str):
    @query(f"dist_{attr}_active", dist_oracle(attr, False, TOP))
    def active_form(i: Inputs):
        return DI.distribution(i.launch, attr, i.active, top_n=TOP)

    @query(f"dist_{attr}_new", dist_oracle(attr, True, TOP))
    def new_form(i: Inputs):
        return DI.distribution(i.launch, attr, i.active, new_only=True, top_n=TOP)

    @query(f"dist_{attr}_all", dist_oracle(attr, False, None))
    def all_form(i: Inputs):
        return DI.distribution(i.launch, attr, i.active)

    active_form.__doc__ = f"B: active devices by {attr}, top {TOP}, share."
    new_form.__doc__ = f"B: new devices by {attr}, top {TOP}, share."
    all_form.__doc__ = f"B: all values of {attr} with share."


for _a in ATTRS:
    _register(_a)


@query("dist_region_active", dist_oracle("region", False, TOP, ["product_id", "country"], True))
def dist_region_active(i: Inputs):
    """Regions within each country (numerator over all entries,
    denominator over active entries), top 10."""
    return DI.distribution(i.launch, "region", i.active, top_n=TOP, by=["product_id", "country"],
                           numerator_flagless=True)


@query("dist_region_new", dist_oracle("region", True, TOP, ["product_id", "country"], True))
def dist_region_new(i: Inputs):
    """New devices by region within country."""
    return DI.distribution(i.launch, "region", i.active, new_only=True, top_n=TOP,
                           by=["product_id", "country"], numerator_flagless=True)


@query("dist_region_all", dist_oracle("region", False, None, ["product_id", "country"], True))
def dist_region_all(i: Inputs):
    """All regions within country."""
    return DI.distribution(i.launch, "region", i.active, by=["product_id", "country"],
                           numerator_flagless=True)


@query("geo_counts", """
WITH fa AS (SELECT l.* FROM launch l JOIN active_channels a ON a.product_id = l.product_id
            AND a.channel_id = l.channel_id)
SELECT product_id, CAST(count(DISTINCT country) AS BIGINT) AS countries,
  CAST(count(DISTINCT (country, region)) AS BIGINT) AS regions FROM fa GROUP BY product_id""")
def geo_counts(i: Inputs):
    """Number of distinct countries and (country, region) pairs."""
    c = DI.distinct_count(i.launch, ["country"], i.active, out="countries")
    r = DI.distinct_count(i.launch, ["country", "region"], i.active, out="regions")
    return c.join(r, "product_id")


@query("dist_brand_api", f"""
WITH x AS ({dist_oracle("brand", False, 5)})
SELECT product_id, brand, devices, rank AS id FROM x""")
def dist_brand_api(i: Inputs):
    """API form -- counts with a rank id, honouring top n (here 5)."""
    d = DI.distribution(i.launch, "brand", i.active, top_n=5)
    return d.select("product_id", "brand", "devices", d["rank"].alias("id"))


@query("dist_os_display", f"""
WITH x AS ({dist_oracle("os", False, TOP)}),
t AS (SELECT product_id, CASE WHEN os IS NULL OR trim(os) = '' THEN 'unknown' ELSE os END AS os,
        CAST(floor(CAST(devices * 2000 + total AS DOUBLE) / CAST(2 * total AS DOUBLE)) AS BIGINT) AS t
      FROM x)
SELECT product_id, os, t / 10.0 AS percent FROM t
UNION ALL
SELECT product_id, 'others', (1000 - sum(t)) / 10.0 FROM t GROUP BY product_id HAVING sum(t) < 1000""")
def dist_os_display(i: Inputs):
    """Top-10 OS shares rounded to 0.1 % with an 'others' row."""
    return DI.with_others(DI.distribution(i.launch, "os", i.active, top_n=TOP), "os")


@query("dist_brand_display", f"""
WITH x AS ({dist_oracle("brand", False, 5)}),
t AS (SELECT product_id, CASE WHEN brand IS NULL OR trim(brand) = '' THEN 'unknown' ELSE brand END AS brand,
        CAST(floor(CAST(devices * 2000 + total AS DOUBLE) / CAST(2 * total AS DOUBLE)) AS BIGINT) AS t
      FROM x)
SELECT product_id, brand, t / 10.0 AS percent FROM t
UNION ALL
SELECT product_id, 'others', (1000 - sum(t)) / 10.0 FROM t GROUP BY product_id HAVING sum(t) < 1000""")
def dist_brand_display(i: Inputs):
    """Top-5 brand shares rounded to 0.1 % plus the remainder row."""
    return DI.with_others(DI.distribution(i.launch, "brand", i.active, top_n=5), "brand")


@query("usage_histogram", """
WITH s AS (SELECT product_id, channel_id, version, d, session_id, sum(duration_ms) AS duration_ms
           FROM page GROUP BY ALL),
c AS (SELECT s.product_id, b.bucket_id, count(*) AS sessions FROM s JOIN usage_buckets b
      ON s.duration_ms >= b.lo AND (b.hi IS NULL OR s.duration_ms < b.hi) GROUP BY ALL),
den AS (SELECT s.product_id, count(*) AS n FROM s JOIN active_channels a
        ON a.product_id = s.product_id AND a.channel_id = s.channel_id GROUP BY ALL),
g AS (SELECT p.product_id, b.bucket_id, b.bucket FROM (SELECT DISTINCT product_id FROM s) p, usage_buckets b)
SELECT g.product_id, g.bucket_id, g.bucket, CAST(coalesce(c.sessions, 0) AS BIGINT) AS sessions,
  coalesce(c.sessions, 0) / den.n AS percentage
FROM g LEFT JOIN c USING (product_id, bucket_id) LEFT JOIN den USING (product_id)""")
def usage_histogram(i: Inputs):
    """Session-length histogram (8 buckets) with share."""
    return DI.usage_histogram(i.page, R.USAGE_BUCKETS, i.active)


@query("frequency_histogram", """
WITH fa AS (SELECT l.* FROM launch l JOIN active_channels a ON a.product_id = l.product_id
            AND a.channel_id = l.channel_id),
t AS (SELECT product_id, channel_id, version, d, device_id, count(*) AS times FROM fa GROUP BY ALL),
c AS (SELECT t.product_id, b.bucket_id, count(*) AS access FROM t JOIN launch_buckets b
      ON t.times >= b.lo AND (b.hi IS NULL OR t.times <= b.hi) GROUP BY ALL),
g AS (SELECT p.product_id, b.bucket_id, b.bucket FROM (SELECT DISTINCT product_id FROM t) p, launch_buckets b)
SELECT g.product_id, g.bucket_id, g.bucket, CAST(coalesce(c.access, 0) AS BIGINT) AS access,
  coalesce(c.access, 0) / sum(coalesce(c.access, 0)) OVER (PARTITION BY g.product_id) AS percentage
FROM g LEFT JOIN c USING (product_id, bucket_id)""")
def frequency_histogram(i: Inputs):
    """Launch-frequency histogram (6 buckets) with share."""
    return DI.frequency_histogram(i.launch, R.LAUNCH_BUCKETS, i.active)


# ---------------------------------------------------------------------------
# a range of days, blank values
# ---------------------------------------------------------------------------

FROM, TO = "2024-01-06", "2024-01-22"        # report parameters
IN_RANGE = f"d BETWEEN DATE '{FROM}' AND DATE '{TO}'"


@query("dist_brand_active_range", dist_oracle("brand", False, TOP).replace("rw AS (SELECT * FROM launch)", f"rw AS (SELECT * FROM launch WHERE {IN_RANGE})"))
def dist_brand_active_range(i: Inputs):
    """B1: active devices by brand over a range of days."""
    return DI.distribution(i.launch, "brand", i.active, top_n=TOP, a=FROM, b=TO)


@query("dist_os_new_range", dist_oracle("os", True, TOP).replace("(SELECT * FROM fl WHERE isnew = 1)", f"(SELECT * FROM fl WHERE isnew = 1 AND {IN_RANGE})"))
def dist_os_new_range(i: Inputs):
    """B2: devices new in a range of days by operating system; new is judged over the whole history."""
    return DI.distribution(i.launch, "os", i.active, new_only=True, top_n=TOP, a=FROM, b=TO)


@query("geo_counts_range", f"""SELECT l.product_id, CAST(count(DISTINCT (l.country, l.region)) AS BIGINT) AS n FROM launch l
JOIN active_channels a ON a.product_id = l.product_id AND a.channel_id = l.channel_id WHERE {IN_RANGE} GROUP BY ALL""")
def geo_counts_range(i: Inputs):
    """Number of regions seen in a range of days."""
    return DI.distinct_count(i.launch, ["country", "region"], i.active, a=FROM, b=TO)


BLANK = "CASE WHEN user_no % 5 = 0 THEN NULL WHEN user_no % 5 = 1 THEN '  ' ELSE brand END"


@query("dist_brand_blank", f"""
WITH b AS (SELECT *, CAST(substr(device_id, 2) AS BIGINT) AS user_no FROM launch),
l AS (SELECT b.product_id, b.device_id, CASE WHEN trim(coalesce({BLANK}, '')) = '' THEN 'unknown' ELSE brand END AS brand
      FROM b JOIN active_channels a ON a.product_id = b.product_id AND a.channel_id = b.channel_id),
n AS (SELECT product_id, brand, count(DISTINCT device_id) AS devices FROM l GROUP BY ALL)
SELECT product_id, brand, CAST(devices AS BIGINT) AS devices, CAST(sum(devices) OVER (PARTITION BY product_id) AS BIGINT) AS total,
  devices / sum(devices) OVER (PARTITION BY product_id) AS percentage,
  CAST(row_number() OVER (PARTITION BY product_id ORDER BY devices DESC, brand) AS INTEGER) AS rank FROM n""")
def dist_brand_blank(i: Inputs):
    """Null and blank brands are one value, 'unknown'."""
    rows = i.launch.withColumn("user_no", F.substring("device_id", 2, 12).cast("long")).withColumn("brand", F.expr(BLANK))
    return DI.distribution(rows.withColumn("brand", DI.label_unknown(F.col("brand"))), "brand", i.active)
