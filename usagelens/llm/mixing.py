"""Mixing sources to target weights by hierarchical budgeting (operator 2).

Documents hang on a tree, domain - language - source.  Every node splits its
token budget among its children by weight.  A child that can't use its share
(it has too few tokens, even repeated for ``max_epochs``) takes what it can,
and its siblings share the rest by weight.  A node's capacity is the sum of
its children's, so only what a whole family can't use reaches its parent's
siblings.  Each level is one closed-form water filling over window sums.

A leaf spends its budget in seeded epochs: whole epochs take all its documents,
and the last one a prefix of a seeded order, as many whole documents as fit.
The prefix is found by sums per slot of the order, then inside one slot only.
A leaf of n documents has about the root of n slots, and a slot as many
documents, so no leaf, however large, is sorted in one task.

Rows: null domains, languages and sources form nodes of their own, ``(none)``.
A null or blank text has no tokens.  Documents of a leaf without any token are
never drawn.  Rows with equal id and token count tie: they are drawn together
or not at all.  An empty table gives an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import stage, words

LEVELS = ("domain", "lang", "source")
SEED = 42
MAX_EPOCHS = 4
#: tokens to draw, as a share of the tokens there are
BUDGET_SHARE = 0.8
# Production parameters: the domain of each source, and weights by level (1 where none is given).
DOMAINS = {f"src{k}": d for d, ks in (("web", range(10)), ("books", range(10, 15)), ("code", range(15, 18))) for k in ks}
OTHER_DOMAIN = "reference"
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 1, "reference": 1}, "lang": {"en": 4, "de": 2, "fr": 2}, "source": {"src0": 3}}


def lookup(c: Column, values: dict, default) -> Column:
    """Value of ``c`` in a small parameter table, else the default."""
    if not values:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(table, c), F.lit(default))


def tree_columns(docs: DataFrame, domains: dict = DOMAINS) -> dict[str, Column]:
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    return {"domain": lookup(named("source"), domains, OTHER_DOMAIN), "lang": named("lang"), "source": named("source")}


def order_key(epoch: Column, seed: int) -> Column:
    """Place of a document in the seeded order of an epoch: an MD5 hex string."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("n_tokens").cast("string")))


def slot_of(key: Column, slots: Column) -> Column:
    head = F.conv(F.substring(key, 1, 7), 16, 10).cast("long")
    return F.shiftright(head * slots, 28)


def fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water filling: splits ``given`` of each parent among its children by ``weight``, none above ``cap``.

    Whole tokens; what the division leaves over goes one by one to the first
    unfilled children by name.
    """
    family = Window.partitionBy(*parent)
    # children with the least room per weight fill up first; weightless ones get nothing
    order = family.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).asc_nulls_last(), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    c = children.withColumn("room", F.col("given") - F.coalesce(F.sum("cap").over(before), zero)) \
        .withColumn("pull", F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), zero)) \
        .withColumn("full", (F.col("weight") > 0) & (F.col("cap").cast("double") * F.col("pull") <= F.col("room").cast("double") * F.col("weight")))
    c = c.withColumn("left", F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(family), zero)) \
        .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)) \
        .withColumn("share", F.when(F.col("full"), F.col("cap")).when(F.col("weight") > 0, F.floor(
            F.col("left").cast("double") * F.col("weight") / F.col("open")).cast("long")).otherwise(zero))
    takes = ~F.col("full") & (F.col("weight") > 0)
    c = c.withColumn("rest", F.col("given") - F.sum("share").over(family)) \
        .withColumn("turn", F.row_number().over(family.orderBy(takes.desc(), name)))
    return c.withColumn("budget", F.col("share") + (takes & (F.col("turn") <= F.col("rest")) & (F.col("share") < F.col("cap"))).cast("long")) \
        .drop("room", "pull", "full", "left", "open", "share", "rest", "turn", "given")


def budgets(leaves: DataFrame, total: int, weights: dict = WEIGHTS) -> DataFrame:
    """The leaves (domain, lang, source, tokens, n_rows, cap) with their ``budget`` in tokens."""
    nodes, above = None, []
    for k, level in enumerate(LEVELS):
        path = list(LEVELS[:k + 1])
        here = leaves.groupBy(*path).agg(F.sum("cap").alias("cap")) \
            .withColumn("weight", lookup(F.col(level), weights.get(level, {}), 1).cast("long"))
        if nodes is None:
            here = here.withColumn("root", F.lit(0)).withColumn(
                "given", F.least(F.lit(total).cast("long"), F.sum("cap").over(Window.partitionBy("root"))))
            nodes = fill(here, ["root"], level).drop("root")
        else:
            given = nodes.select(*above, F.col("budget").alias("given"))
            nodes = fill(here.join(given, above), above, level)
        above = path
    return leaves.join(nodes.select(*LEVELS, "budget"), list(LEVELS))


def plan(rows: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
         weights: dict = WEIGHTS) -> DataFrame:
    """Per leaf: tokens, budget, whole epochs, and the last key of the last epoch's prefix (null: none).

    ``rows`` are staged (doc_id, domain, lang, source, n_tokens).
    """
    leaves = stage(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows"))
                   .withColumn("cap", F.col("tokens") * max_epochs), "mix_leaves")
    total = int((leaves.agg(F.sum("tokens")).first()[0] or 0) * budget_share)
    leaf = budgets(leaves, total, weights) \
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long"))
    leaf = leaf.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")) \
        .withColumn("slots", F.ceil(F.sqrt("n_rows")).cast("long"))     # as many slots as documents in one
    leaf = stage(leaf, "mix_budgets")
    last = rows.join(leaf.where("rest > 0").select(*LEVELS, "epochs", "rest", "slots"), list(LEVELS)) \
        .withColumn("key", order_key(F.col("epochs"), seed)).withColumn("slot", slot_of(F.col("key"), F.col("slots")))
    through = F.sum("slot_tokens").over(Window.partitionBy(*LEVELS).orderBy("slot"))
    slots = last.groupBy(*LEVELS, "slot").agg(F.sum("n_tokens").alias("slot_tokens"), F.max("rest").alias("room"),
                                              F.max("key").alias("slot_last")) \
        .withColumn("through", through)
    slots = stage(slots, "mix_slots")
    # slots that fit whole; then the first that doesn't is searched row by row
    fits = slots.where("through <= room").groupBy(*LEVELS).agg(F.max("slot_last").alias("cut"))
    edge = slots.where("through > room").groupBy(*LEVELS) \
        .agg(F.min_by(F.struct("slot", (F.col("room") - F.col("through") + F.col("slot_tokens")).alias("space")), "slot").alias("e")) \
        .select(*LEVELS, F.col("e.slot").alias("slot"), F.col("e.space").alias("space"))
    inside = last.join(edge, [*LEVELS, "slot"]) \
        .withColumn("sum", F.sum("n_tokens").over(Window.partitionBy(*LEVELS, "slot").orderBy("key"))) \
        .where("sum <= space").groupBy(*LEVELS).agg(F.max("key").alias("inner_cut"))
    return leaf.join(fits, list(LEVELS), "left").join(inside, list(LEVELS), "left") \
        .select(*LEVELS, "tokens", "budget", "epochs", F.coalesce("inner_cut", "cut").alias("cut"))


def draw(rows: DataFrame, leaf_plan: DataFrame, seed: int = SEED) -> DataFrame:
    """Each row once per epoch that draws it (column ``epoch``, from 0); other columns stay."""
    p = leaf_plan.select(*LEVELS, "epochs", "cut")
    r = rows.join(p, list(LEVELS)).withColumn("copies", F.col("epochs") + F.coalesce(
        (order_key(F.col("epochs"), seed) <= F.col("cut")).cast("long"), F.lit(0)))
    return r.where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))) \
        .drop("epochs", "cut", "copies")


def leaf_rows(docs: DataFrame, domains: dict = DOMAINS) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens) of every document."""
    return docs.select("doc_id", *[c.alias(n) for n, c in tree_columns(docs, domains).items()],
                       F.size(words(F.col("text"))).cast("long").alias("n_tokens"))


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The mixture: doc_id, domain, lang, source, n_tokens, epoch; one row per document drawn and epoch."""
    rows = stage(leaf_rows(docs), "mix_rows")
    return draw(rows, stage(plan(rows, **parameters), "mix_plan"))


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` in the mixture, each repeated once per epoch that draws it."""
    p = stage(plan(stage(leaf_rows(docs), "mix_rows"), **parameters), "mix_plan")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", *[c.alias(n) for n, c in tree_columns(docs).items()],
                       F.size(words(F.col("text"))).cast("long").alias("n_tokens"))
    return draw(rows, p).select("row.*")


