"""Operator 5: sources mixed to target weights by budgets handed down a tree of domain, language and source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsengine.session import materialize

LEVELS = ("domain", "lang", "source")
#: Hex digits of the order key that a leaf's tokens are summed by, one after the other, before single documents are ordered.
_DIGITS = (2, 4)


@dataclass(frozen=True)
class Mixture:
    """Target weights by level and value (siblings share their parent's budget by weight), and how much to draw.

    ``share`` is the budget as a part of all tokens; a document comes at most ``epochs`` times. Values without a weight have ``other``.
    """

    weights: dict[str, dict[str, float]] = field(default_factory=dict)
    other: float = 1.0
    share: float = 1.0
    epochs: int = 2
    seed: int = 11


def n_tokens(text: Column) -> Column:
    """Words between white space; null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("bigint")


def _weight(level: str, mix: Mixture) -> Column:
    out = F.lit(float(mix.other))
    for value, weight in mix.weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(out)
    return out


def _shared_out(nodes: DataFrame, parents: list[str], level: str, mix: Mixture) -> DataFrame:
    """Budget of each child of each parent: by weight, no child over its ``capacity``, what a child cannot use to its siblings.

    Children sorted by capacity per weight: those that fill up come first, and the others share what is left by weight.
    """
    nodes = nodes.withColumn("weight", _weight(level, mix)).withColumn("ratio", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")))
    order = Window.partitionBy(*parents).orderBy(F.col("ratio").asc_nulls_last(), level)
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    used = F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("capacity"))).over(before), F.lit(0))
    nodes = nodes.withColumn("rate", (F.col("parent_budget") - used) / F.sum("weight").over(onward))
    nodes = nodes.withColumn("common", F.min(F.when(F.col("ratio") > F.col("rate"), F.struct(F.col("ratio"), F.col("rate")))).over(Window.partitionBy(*parents)))
    share = F.when(F.coalesce(F.col("ratio") <= F.col("rate"), F.lit(False)), F.col("capacity").cast("double")).otherwise(F.col("common.rate") * F.col("weight"))
    budget = F.when(F.col("weight") > 0, F.coalesce(share, F.lit(0.0))).otherwise(F.lit(0.0))
    return nodes.withColumn("budget", F.floor(F.round(budget, 3)).cast("bigint")).drop("weight", "ratio", "rate", "common", "parent_budget")


def leaf_budgets(leaves: DataFrame, mix: Mixture) -> DataFrame:
    """``leaves (domain, lang, source, tokens)`` with ``budget``.

    Budgets go down from the root. A child takes at most what its subtree holds in ``epochs`` epochs; a shortage goes to its
    siblings first, and to other branches only when all of its parent's subtree is used up.
    """
    leaves = leaves.withColumn("capacity", F.col("tokens") * mix.epochs)
    tokens, capacity = leaves.agg(F.sum("tokens"), F.sum("capacity")).first()
    budget = min(int((tokens or 0) * mix.share), capacity or 0)
    level = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity")).withColumn("parent_budget", F.lit(budget).cast("bigint"))
    level = _shared_out(level, [], "domain", mix)
    for depth in (1, 2):
        above, name = list(LEVELS[:depth]), LEVELS[depth]
        match = F.expr(" and ".join(f"{c} <=> p_{c}" for c in above))
        parents = level.select(*[F.col(c).alias(f"p_{c}") for c in above], F.col("budget").alias("parent_budget"))
        children = leaves.groupBy(*above, name).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        level = _shared_out(children.join(parents, match).select(*above, name, "capacity", "tokens", "parent_budget"), above, name, mix)
    return level


def _order_key(mix: Mixture, epoch: Column, doc: str) -> Column:
    """Place of a document in an epoch's order: 32 hex digits drawn from the seed, the epoch and the id."""
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), F.col(doc).cast("string")).cast("binary"))


def _leaf_plan(docs: DataFrame, mix: Mixture) -> DataFrame:
    """For each leaf: ``epochs`` it gives whole, and the last order key ``cut`` of the epoch it gives in part (null: none)."""
    narrow = materialize(docs, "mixture-documents")
    plan = leaf_budgets(materialize(narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mixture-leaves"), mix)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("int")
    plan = plan.withColumn("epochs", whole).withColumn("part", F.col("budget") - F.col("epochs") * F.col("tokens"))
    plan = materialize(plan.select(*[F.col(c).alias(f"p_{c}") for c in LEVELS], "budget", "epochs", "part"), "mixture-plan")
    keyed = narrow.join(plan.where("part > 0"), _same_leaf()).withColumn("key", _order_key(mix, F.col("epochs"), "doc"))
    inside = keyed.select(*LEVELS, "tokens", "part", "key", F.lit(0).cast("bigint").alias("before"))
    # Sums by the first digits of the key find the slot of a leaf's order where its budget ends, then the slot within that slot.
    for digits in _DIGITS:
        slot = F.substring("key", 1, digits)
        slots = inside.groupBy(*LEVELS, slot.alias("slot"), "part", "before").agg(F.sum("tokens").alias("slot_tokens"))
        upto = Window.partitionBy(*LEVELS).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        slots = slots.withColumn("before", F.col("before") + F.coalesce(F.sum("slot_tokens").over(upto), F.lit(0)))
        last = materialize(slots.where("before < part and before + slot_tokens >= part").select(*[F.col(c).alias(f"p_{c}") for c in LEVELS], F.col("slot").alias("p_slot"), F.col("before").alias("p_before")), "mixture-slots")
        inside = inside.join(last, F.expr(_same_leaf_sql()) & (slot == F.col("p_slot"))).select(*LEVELS, "tokens", "part", "key", F.col("p_before").alias("before"))
    running = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(running)).where("upto >= part")
    cuts = ends.groupBy(*LEVELS).agg(F.min("key").alias("cut"))
    match = F.expr(_same_leaf_sql())
    return materialize(plan.join(cuts, match, "left").select(*[f"p_{c}" for c in LEVELS], "budget", "epochs", "part", "cut"), "mixture-cuts")


def _same_leaf_sql() -> str:
    return " and ".join(f"{c} <=> p_{c}" for c in LEVELS)


def _same_leaf() -> Column:
    return F.expr(_same_leaf_sql())


def mix_sources(docs: DataFrame, mix: Mixture, domain: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Columns of ``docs`` in a struct ``row`` for each time a document is drawn, with ``domain, lang, source, tokens, epoch``.

    ``domain`` tells a row's domain. Budgets count words. A leaf (domain, language, source) gives whole epochs first and then
    the documents of one more epoch, in an order drawn from the seed, up to the one in which its budget ends (that one included).

    Null domains, languages and sources are values of their own; a null text counts no words and comes with its epoch.
    Rows that share an id share their place in the order. A leaf without words is drawn for no epoch.
    """
    leaf = {"domain": domain.cast("string"), "lang": F.col(lang_col).cast("string"), "source": F.col(source_col).cast("string")}
    narrow = docs.select(F.col(id_col).alias("doc"), n_tokens(F.col(text_col)).alias("tokens"), *[c.alias(n) for n, c in leaf.items()])
    plan = _leaf_plan(narrow, mix)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc"), n_tokens(F.col(text_col)).alias("tokens"), *[c.alias(n) for n, c in leaf.items()])
    drawn = rows.join(plan, _same_leaf())
    partly = F.coalesce(_order_key(mix, F.col("epochs"), "doc") <= F.col("cut"), F.lit(False)).cast("int")
    times = F.col("epochs") + partly
    return drawn.where(times > 0).select("row", *LEVELS, "tokens", F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch"))
