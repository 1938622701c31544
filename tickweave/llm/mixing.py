"""Mixing sources to target weights by budgets that flow down a domain-language-source tree.

The token budget is dealt out from the root: at each node in proportion to the children's weights, where a child takes no
more than its subtree can give (its tokens times ``max_epochs``) and its shortage goes to its siblings. As a node never gets
more than its subtree can give, a shortage reaches an ancestor's other children only when all siblings are exhausted. Each
leaf then takes as many whole epochs as its budget holds, and of one more epoch, in a seeded order of its own, the
prefix whose tokens fit.

Shares are computed in whole numbers with windows over the tree, which has a row per source and none per document. The
prefix of a leaf with very many documents needs no sort of the leaf: tokens are summed by the first hex digits of the order
key, and only the stretch in which the budget ends is looked at document by document.

Defined results: nulls in tree columns are the empty name; null texts have no tokens; nodes without positive weight get
nothing; repeated rows share an order key and are taken or left together; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickweave.llm.common import fresh, text_of, words_of
from tickweave.session import BROADCAST_ROWS, settle

DIGITS = 4  # 65,536 stretches of the order keys per leaf
Weights = dict[str, int]


def order_key(seed: str, epoch: Column, doc_id: Column, text: Column) -> Column:
    """Where a document stands in its leaf's seeded order of an epoch: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text)))


def _weight(name: Column, weights: Weights, default: int) -> Column:
    return F.coalesce(*[F.when(name == k, F.lit(v)) for k, v in weights.items()], F.lit(default)).cast("decimal(19,0)")


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, Weights], budget: int, max_epochs: int, default: int = 1) -> DataFrame:
    """Adds ``budget`` to a table of leaves (the ``levels`` columns and ``tokens``)."""
    whole = "decimal(19,0)"
    tree = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast(whole))
    root = leaves.agg(F.least(F.lit(budget).cast(whole), F.coalesce(F.sum(F.col("tokens") * max_epochs), F.lit(0)).cast(whole)).cast(whole).alias("given"))
    parent, above = root, []
    for k, level in enumerate(levels):
        path = levels[: k + 1]
        own = tree.groupBy(*path).agg(F.sum("cap").cast(whole).alias("cap")).withColumn("w", _weight(F.col(level), weights.get(level, {}), default))
        own = own.filter("w > 0 AND cap > 0")
        own = own.join(parent, above) if above else own.join(F.broadcast(parent), F.lit(True))  # the root is one row
        siblings = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        order = siblings.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), level)
        before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(whole)
        rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(whole)
        own = own.withColumn("full", F.col("cap") * rest <= F.col("w") * (F.col("given") - before).cast(whole))
        taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(siblings), F.lit(0)).cast(whole)
        open_ = F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings).cast(whole)
        own = own.withColumns({"left": (F.col("given") - taken).cast(whole), "open": open_})
        share = F.call_function("div", F.col("w") * F.col("left"), F.col("open"))
        parent = own.select(*path, F.when(F.col("full"), F.col("cap")).otherwise(share).cast(whole).alias("given"))
        above = path
    out = leaves.join(parent, levels, "left")
    return out.select(*levels, "tokens", F.coalesce(F.col("given"), F.lit(0)).cast("long").alias("budget"))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast only what was counted and found small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def plan(df: DataFrame, levels: dict[str, Column], weights: dict[str, Weights], share: float, max_epochs: int = 2, seed: str = "mix", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per leaf: the level columns, ``tokens``, ``budget``, ``epochs`` taken whole, and ``cut``, the last order key of the next epoch (or null).

    ``levels`` names the tree's columns from the root down; ``share`` is the budget as a part of all tokens.
    """
    names = [*levels]
    t = text_of(text)
    rows = df.select(F.col(doc_id).cast("long").alias("_id"), F.md5(t).alias("_text"), *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()], F.size(words_of(t)).cast("long").alias("n_tokens"))
    rows = settle(rows, "mix-rows")
    leaves = settle(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    tree = budgets(leaves, names, weights, int(total * share), max_epochs)
    tree = tree.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest(F.col("tokens"), F.lit(1)))).otherwise(0).cast("long"))
    tree = settle(tree.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")), "mix-tree")
    key = F.md5(F.concat_ws(":", F.lit(seed), (F.col("epochs") + 1).cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_text")))
    keyed = rows.join(_small(tree.filter("rest > 0").select(*names, "epochs", "rest")), names).withColumn("key", key).withColumn("stretch", F.substring("key", 1, DIGITS))
    keyed = keyed.select(*names, "rest", "stretch", "key", "n_tokens")
    stretches = keyed.groupBy(*names, "rest", "stretch").agg(F.sum("n_tokens").alias("n"), F.max("key").alias("last"))
    upto = Window.partitionBy(*names).orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    stretches = settle(stretches.withColumn("sum", F.sum("n").over(upto)).withColumn("before", F.col("sum") - F.col("n")), "mix-stretches")
    inside = stretches.filter("sum <= rest").groupBy(*names).agg(F.max("last").alias("cut"))
    edge = stretches.filter("sum > rest AND before <= rest").select(*names, "stretch", "before")
    docs = keyed.join(_small(edge), [*names, "stretch"])
    peers = Window.partitionBy(*names, "stretch").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    docs = docs.withColumn("sum", F.col("before") + F.sum("n_tokens").over(peers)).filter("sum <= rest").groupBy(*names).agg(F.max("key").alias("cut"))
    cuts = inside.unionByName(docs).groupBy(*names).agg(F.max("cut").alias("cut"))
    return settle(tree.join(cuts, names, "left").select(*names, "tokens", "budget", "epochs", "cut"), "mix-plan")


def with_copies(df: DataFrame, levels: dict[str, Column], leaf_plan: DataFrame, seed: str = "mix", doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with a column that says in how many epochs a row is taken, and that column's name."""
    name = fresh(df, "mix_copies")
    own = {n: fresh(df, f"mix_{n}") for n in levels}
    out = df.withColumns({own[n]: F.coalesce(c.cast("string"), F.lit("")) for n, c in levels.items()})
    part = leaf_plan.select(*[F.col(n).alias(f"{own[n]}_of") for n in levels], F.col("epochs").alias(f"{name}_epochs"), F.col("cut").alias(f"{name}_cut"))
    out = out.join(_small(part), [F.col(own[n]) == F.col(f"{own[n]}_of") for n in levels], "left")
    key = order_key(seed, F.col(f"{name}_epochs") + 1, F.col(doc_id).cast("long"), text_of(text))
    copies = F.coalesce(F.col(f"{name}_epochs"), F.lit(0)) + F.coalesce(key <= F.col(f"{name}_cut"), F.lit(False)).cast("long")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], copies.alias(name)), name


def mix(df: DataFrame, levels: dict[str, Column], weights: dict[str, Weights], share: float, max_epochs: int = 2, seed: str = "mix", **how) -> DataFrame:
    """The mixture itself: rows of ``df``, all columns unchanged, as often as they are taken."""
    out, name = with_copies(df, levels, plan(df, levels, weights, share, max_epochs, seed, **how), seed, **how)
    taken = out.filter(F.col(name) > 0).withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(name))))
    return taken.select(*[F.col(f"`{c}`") for c in df.columns])
