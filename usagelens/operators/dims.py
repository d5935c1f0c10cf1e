"""Dimension maintenance.

Dimensions are value lists; the only ones with attributes are the product
dimension (registry x observed versions), the event dimension and the
error-title dimension.  Maintenance is ``distinct`` (a partial aggregate)
plus an anti join against what is already known -- no surrogate-key
bookkeeping: facts join on natural keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extend_dim(dim: DataFrame, src: DataFrame, cols: list[str]) -> DataFrame:
    """D1-D9 shared core: distinct ``cols`` of ``src`` not yet in ``dim``
    (null-safe comparison, so an unknown NULL value is inserted once)."""
    new = src.select(*cols).distinct()
    cond = [new[c].eqNullSafe(dim[c]) for c in cols]
    return new.join(dim.select(*cols).distinct(), cond, "left_anti")


def new_attribute_values(dim_src: DataFrame, src: DataFrame, attrs: list[str]) -> DataFrame:
    """Unseen values of several single-column dimensions at once, as
    (attribute, value) rows; each side is read once for all attributes, and a
    value is new where the known side has none of it (nulls included)."""
    def values(df: DataFrame, known: int) -> DataFrame:
        each = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attrs])
        return df.select(F.explode(each).alias("v")).select("v.*", F.lit(known).alias("known"))
    both = values(dim_src, 1).unionByName(values(src, 0)).groupBy("attribute", "value").agg(F.max("known").alias("known"))
    return both.where("known = 0").drop("known")


def surrogate_key(*cols) -> F.Column:
    """A deterministic 64-bit key from natural keys (xxhash64), for
    consumers that need one; never a generated sequence."""
    return F.xxhash64(*cols)


def sync_product_dim(channels: DataFrame, products: DataFrame, launches: DataFrame,
                     inactive_versions: DataFrame | None = None) -> DataFrame:
    """One row per (product, channel, version) observed in the
    launches for a registered (product, channel), with the registry's names,
    owner, platform and flags (version_active from an optional list of
    disabled versions).  Recomputed and overwritten each run (type-1)."""
    seen = launches.select("product_id", "channel_id", "version").distinct()
    reg = channels.join(products.select("product_id", "product_name", "owner_id", "platform"), "product_id")
    dim = seen.join(reg, ["product_id", "channel_id"])
    va = F.lit(1)
    if inactive_versions is not None:
        off = inactive_versions.select("product_id", "version", F.lit(0).alias("_va"))
        dim = dim.join(off, ["product_id", "version"], "left")
        va = F.coalesce(F.col("_va"), F.lit(1))
    return dim.select("product_id", "product_name", "channel_id", "channel_name", "version", "owner_id",
                      "platform", "product_active", "channel_active", va.alias("version_active"))


def sync_event_dim(dim: DataFrame, defs: DataFrame) -> DataFrame:
    """Type-1 refresh of the event dimension: a definition's
    attributes win whenever there is one, NULLs included; new definitions are
    inserted and dimension rows without a definition stay."""
    keys = ["product_id", "event_id"]
    attrs = ["event_identifier", "event_name", "active"]
    d = dim.alias("d")
    s = defs.withColumn("_defined", F.lit(True)).alias("s")
    return d.join(s, keys, "full").select(
        *keys, *[F.when(F.col("s._defined"), F.col(f"s.{a}")).otherwise(F.col(f"d.{a}")).alias(a) for a in attrs])


def set_fixed(titles: DataFrame, overlay: DataFrame) -> DataFrame:
    """Apply a (title, is_fixed) overlay to the error-title
    dimension."""
    o = overlay.select("product_id", "title", F.col("is_fixed").alias("_fix"))
    return (titles.join(o, ["product_id", "title"], "left")
            .withColumn("is_fixed", F.coalesce(F.col("_fix"), F.col("is_fixed"))).drop("_fix"))


def distinct_values(df: DataFrame, col: str, by: list[str] = ("product_id",)) -> DataFrame:
    """Sorted distinct values of ``col`` per key."""
    by = list(by)
    return df.select(*by, col).distinct().orderBy(*by, col)
