"""Forecast, smoothing, deviation alerts, chart markers and segments
(A1-A9).

Forecast and smoothing are bounded row frames over each product's dense
daily series (one row per day), so a window partition never holds more than
the days of one product.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.ratios import pct_round

FORECAST_DAYS = 5  # fixed value: days averaged by forecast and smoothing


def forecast(series: DataFrame, cols: list[str], keys: list[str] = ("product_id",), n: int = FORECAST_DAYS,
             order: str = "d") -> DataFrame:
    """A1: forecast of each column for day t = mean of days t-n .. t-1; only
    rows with n predecessors are kept.  Also returns the n-day sum
    (``<col>_sum``) so deviation tests can stay in integer arithmetic."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1)
    sel = [*keys, order] + [F.col(c) for c in cols]
    sel += [F.avg(c).over(w).alias(f"{c}_forecast") for c in cols]
    sel += [F.sum(c).over(w).alias(f"{c}_sum") for c in cols]
    sel += [F.count(F.lit(1)).over(w).alias("_k")]
    return series.select(*sel).where(F.col("_k") == n).drop("_k")


def smooth(series: DataFrame, cols: list[str], keys: list[str] = ("product_id",), n: int = FORECAST_DAYS,
           order: str = "d", digits: int = 9) -> DataFrame:
    """A2: mean of the current and n-1 preceding rows; the first n rows of
    each series are dropped.  Results are rounded to ``digits``."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    out = series.select(*keys, order, *[F.round(F.avg(c).over(w), digits).alias(c) for c in cols],
                        pos.alias("_pos"))
    return out.where(F.col("_pos") > n).drop("_pos")


def alerts(series: DataFrame, rules: DataFrame, metrics: list[str], n: int = FORECAST_DAYS) -> DataFrame:
    """A3/A4/A5: for every product day with a forecast and every active rule
    on one of ``metrics``: deviation = round(|forecast - fact| / forecast, 2)
    * 100; a hit when deviation >= condition, or when the forecast is 0 and
    the fact differs.  Returns the hit records (fact, forecast, deviation).

    The test is exact: forecast = sum/n, so |f - x| / f = |sum - n*x| / sum.
    Counts stay whole numbers; if a metric has fractions, ``fact`` is a double
    and the test is done in millionths.
    """
    fc = forecast(series, metrics, ["product_id"], n)
    whole = all(t in ("tinyint", "smallint", "int", "bigint") for c, t in series.dtypes if c in metrics)
    kind, unit = ("bigint", 1) if whole else ("double", 1_000_000)
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast(kind).alias("fact"),
                                         F.col(f"{m}_forecast").alias("forecast"),
                                         F.col(f"{m}_sum").cast(kind).alias("fsum"))
                                for m in metrics]))
    long = fc.select("product_id", "d", stack.alias("_m")).select("product_id", "d", "_m.*")
    scaled = lambda c: c if whole else F.round(c * unit).cast("bigint")
    dev = pct_round(F.abs(scaled(F.col("fsum")) - scaled(F.col("fact")) * n), scaled(F.col("fsum")), 0, 100)
    j = long.join(rules.where("active = 1").select("product_id", "metric", "condition"),
                  ["product_id", "metric"])
    hit = (F.col("fsum") != 0) & (dev >= F.col("condition")) | \
          (F.col("fsum") == 0) & (F.col("fact") != 0)
    return j.where(hit).select("product_id", "d", "metric", "fact", "forecast",
                               dev.alias("deviation_pct"), "condition")


def select_rule(rules: DataFrame, product_id: int, metric: str, condition: float) -> DataFrame:
    """A5: the rule row of a product/metric whose condition equals
    ``condition`` up to a float tolerance of 0.001 (how an alert hit is
    matched back to its rule)."""
    return rules.where((F.col("product_id") == product_id) & (F.col("metric") == metric) &
                       (F.abs(F.col("condition") - F.lit(condition)) < 0.001))


def visible_markers(markers: DataFrame, user_id: int, product_id: int | None = None, a=None, b=None,
                    others_ignore_range: bool = False) -> DataFrame:
    """A user's own markers in the range, and other users' public
    (private=1) markers -- in the range unless ``others_ignore_range``
    reproduces the reference's operator-precedence reading."""
    m = markers
    if product_id is not None:
        m = m.where(F.col("product_id") == product_id)
    in_rng = F.lit(True)
    if a is not None:
        in_rng = in_rng & (F.col("d") >= F.lit(a).cast("date"))
    if b is not None:
        in_rng = in_rng & (F.col("d") <= F.lit(b).cast("date"))
    own = (F.col("user_id") == user_id) & in_rng
    others = (F.col("user_id") != user_id) & (F.col("private") == 1)
    if not others_ignore_range:
        others = others & in_rng
    return m.where(own | others)


def marker_counts(markers: DataFrame, user_id: int, product_id: int | None = None, a=None, b=None) -> DataFrame:
    """Number of markers visible to ``user_id``, per marker owner."""
    return (visible_markers(markers, user_id, product_id, a, b).groupBy("user_id")
            .agg(F.count(F.lit(1)).cast("bigint").alias("markers")))


TAG_COLUMNS = {"version": "version", "region": "region"}


def segment_rows(launch: DataFrame, tags_json: str, channels: DataFrame) -> DataFrame:
    """Launches that match a tag group: AND between tag types, IN within a
    type; a type that is not listed, or whose list is empty or null, does not
    restrict.  Channels are given by name.  The group is a report parameter
    and read here, so every test is a plain IN that reaches the scan."""
    values, out = _tag_values(tags_json), launch
    for kind, column in TAG_COLUMNS.items():
        if kind in values:
            out = out.where(F.col(column).isin(values[kind]))
    return out.join(_named(channels, values), ["product_id", "channel_id"], "left_semi") if "channel" in values else out


def _tag_values(tags_json: str) -> dict[str, list[str]]:
    values: dict[str, list[str]] = {}
    for tag in json.loads(tags_json):
        if tag.get("value"):
            values.setdefault(tag["type"], []).extend(str(v) for v in tag["value"])
    return values


def _named(channels: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    return channels.where(F.col("channel_name").isin(values["channel"])).select("product_id", "channel_id").distinct()


def segment_marks(launch: DataFrame, tags_json: str, channels: DataFrame) -> DataFrame:
    """All launches, with ``_match``: whether they are in the tag group."""
    values, match, out = _tag_values(tags_json), F.lit(True), launch
    for kind, column in TAG_COLUMNS.items():
        if kind in values:
            match = match & F.coalesce(F.col(column).isin(values[kind]), F.lit(False))
    if "channel" in values:
        out = out.join(_named(channels, values).withColumn("_named", F.lit(True)), ["product_id", "channel_id"], "left")
        match = match & F.col("_named").isNotNull()
    return out.withColumn("_match", match)


def segment(launch: DataFrame, tags_json: str, channels: DataFrame, by: list[str] = ("product_id",)) -> DataFrame:
    """Distinct devices matching a tag group, ordered (page with
    ``reports.page``)."""
    by = list(by)
    return (segment_rows(launch, tags_json, channels).select(*by, "device_id").distinct()
            .orderBy(*by, "device_id"))


def segment_size(launch: DataFrame, tags_json: str, channels: DataFrame, by: list[str] = ("product_id",)) -> DataFrame:
    """Matching devices and their share of all devices of the key."""
    by = list(by)
    device = segment_marks(launch, tags_json, channels).groupBy(*by, "device_id").agg(F.bool_or("_match").alias("_match"))
    out = device.groupBy(*by).agg(F.count(F.when(F.col("_match"), F.col("device_id"))).alias("devices"), F.count("device_id").alias("all_devices"))
    return out.select(*by, F.col("devices").cast("bigint").alias("devices"), F.col("all_devices").cast("bigint").alias("all_devices"),
                      F.try_divide(F.col("devices").cast("double"), F.col("all_devices").cast("double")).alias("percent"))
