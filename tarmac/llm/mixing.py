"""Mixing sources to target weights by hierarchical budgets (DataFrame functions only).

Method: documents hang under the leaves of a tree (by default domain, language, source). Each
node has a weight among its siblings and a capacity, the tokens that can be taken below it
(children of weight 0 do not count) times the number of epochs. From the root down a node's budget is shared among its children by
weight; a child whose capacity is less gives the rest to its siblings, again by weight, so
a shortage moves to another branch only when all siblings are full. A leaf takes
whole epochs and then a prefix of one more: each epoch orders the leaf's documents
anew by a seeded digest, and the prefix is as many tokens as are left of the budget; the
last document is taken in part.

Shares are found in closed form: children sorted by capacity over weight fill up in that
order. Leaves are counted before anything else, so these windows hold one row per node. The
prefix sums over a leaf's documents are taken in slices of the digest, first over the
slices' totals and then inside each slice, so no task holds a large source.

Defined results: null names are a name of their own; a null or empty text has no tokens and is
taken in every whole epoch (a leaf without any tokens has none); weights missing from the table are 1, and a sibling of weight 0
gets nothing unless all have weight 0, when all are treated alike; equal rows stay
apart; documents that share an id share a digest and are taken in the order of row_key, a hash of id and text; an empty table gives an empty table; with a budget above all capacities everything is
taken max_epochs times. Columns other than the named ones are kept out of the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.store import Scratch, row_key

LEVELS = ("domain", "lang", "source")
#: Documents in a slice of the digest order, about.
SLICE_DOCS = 2000
NO_NAME = "\u0000"


def domain_of(source: Column) -> Column:
    """Example of a top level: three domains by the source's checksum."""
    return F.concat(F.lit("domain"), (F.crc32(F.coalesce(source, F.lit(""))) % 3).cast("string"))


def word_tokens(text: Column) -> Column:
    """Tokens of a text: its runs without ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def shares(children: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """Adds allotted: the parent's budget over children with weight and capacity, shortages to siblings first."""
    siblings = Window.partitionBy(*parent)
    total_weight = F.sum("weight").over(siblings)
    children = children.withColumn("weight", F.when(total_weight > 0, F.col("weight")).otherwise(F.lit(1.0)))
    children = children.withColumn("fill", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf"))))
    before = siblings.orderBy("fill", *order).rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("capacity").over(before), F.lit(0).cast("long"))
    rest = F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # a child is full if the level that the budget left by fuller ones gives reaches its fill
    level = F.when(rest > 0, (F.col("budget") - filled) / rest)
    children = children.withColumn("level", level)
    full = (F.col("level") >= F.col("fill")) & (F.col("weight") > 0)
    open_level = F.min(F.when(~full & (F.col("weight") > 0), F.struct("fill", F.struct(*order), "level"))).over(siblings)["level"]
    children = children.withColumns({"full": full, "open_level": open_level})
    allotted = F.when(F.col("weight") == 0, F.lit(0)).when(F.col("full"), F.col("capacity")).otherwise(F.floor(F.col("open_level") * F.col("weight")))
    return children.withColumn("allotted", F.least(allotted.cast("long"), F.col("capacity"))).drop("fill", "level", "full", "open_level")


def leaf_budgets(leaves: DataFrame, levels: tuple[str, ...], weights: dict[str, DataFrame], budget: Column, max_epochs: int) -> DataFrame:
    """(levels..., tokens, docs, allotted) from one row (levels..., tokens, docs) per leaf.

    weights has, by level, a table of that level's path columns and weight.
    """
    given = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    sized: dict[str, DataFrame] = {}
    nodes = given.groupBy(*levels).agg(F.sum("capacity").alias("capacity"))
    for i in reversed(range(len(levels))):
        here = list(levels[: i + 1])
        if levels[i] in weights:
            nodes = nodes.join(weights[levels[i]].select(*here, F.col("weight").cast("double").alias("weight")), here, "left")
            nodes = nodes.withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        else:
            nodes = nodes.withColumn("weight", F.lit(1.0))
        sized[levels[i]] = nodes
        # children of weight 0 get nothing unless all have weight 0, so only then their tokens can be taken
        weighted = F.sum(F.when(F.col("weight") > 0, F.col("capacity")))
        nodes = nodes.groupBy(*here[:-1]).agg(F.when(F.sum("weight") > 0, weighted).otherwise(F.sum("capacity")).alias("capacity"))
    most = nodes.select(F.coalesce("capacity", F.lit(0).cast("long")).alias("capacity"))
    root = most.crossJoin(given.agg(F.coalesce(F.sum("tokens"), F.lit(0).cast("long")).alias("tokens")))
    whole = root.select(F.least(budget.cast("long"), F.col("capacity"))).first()[0]
    path: list[str] = []
    above = None
    for level in levels:
        here = [*path, level]
        nodes = sized[level]
        nodes = nodes.withColumn("budget", F.lit(whole)) if above is None else nodes.join(above, path)
        placed = shares(nodes, path, [level])
        path = here
        above = placed.select(*here, F.col("allotted").alias("budget"))
    return given.join(above, list(levels)).select(*levels, "tokens", "docs", F.col("budget").alias("allotted"))


def digest(seed: int, epoch: Column, doc_key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), doc_key))


def mix(
    docs: DataFrame,
    levels: tuple[str, ...] = LEVELS,
    weights: dict[str, DataFrame] | None = None,
    budget: Column | None = None,
    max_epochs: int = 1,
    seed: int = 0,
) -> DataFrame:
    """doc_id, row_key, levels..., epoch, n_tokens, taken: how many tokens of each document go into each epoch.

    docs has doc_id, text and the level columns. budget may use the column ``tokens``, the
    whole corpus' tokens; by default it is half of them.
    """
    scratch = Scratch(docs.sparkSession)
    names = {c: F.coalesce(F.col(c).cast("string"), F.lit(NO_NAME)) for c in levels}
    key = F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.when(F.col("doc_id").isNull(), F.md5("text")))
    sized = docs.select("doc_id", row_key("doc_id", "text").alias("row_key"), *[c.alias(n) for n, c in names.items()], key.alias("doc_key"), word_tokens(F.col("text")).alias("n_tokens"))
    sized = scratch.save(sized, "sized")
    leaves = scratch.save(sized.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    half = F.floor(F.col("tokens") / 2)
    plan = leaf_budgets(leaves, levels, weights or {}, half if budget is None else budget, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("allotted") / F.col("tokens"))).otherwise(F.lit(0))
    plan = plan.withColumns({"whole": whole.cast("int"), "slices": F.ceil(F.col("docs") / SLICE_DOCS)})
    plan = scratch.save(plan.withColumn("part", F.col("allotted") - F.col("whole") * F.col("tokens")), "plan")

    epochs = F.sequence(F.lit(0), F.least("whole", F.lit(max_epochs - 1)))
    rows = sized.join(plan.drop("tokens", "docs", "allotted"), list(levels)).withColumn("epoch", F.explode(epochs))
    complete = rows.where("epoch < whole").withColumn("taken", F.col("n_tokens"))
    cut = rows.where("epoch = whole AND part > 0").withColumn("digest", digest(seed, F.col("epoch"), F.col("doc_key")))
    first_bits = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    cut = cut.withColumn("slice", F.floor(first_bits * F.col("slices") / F.lit(1 << 32)).cast("long"))
    cut = scratch.save(cut, "cut")
    in_leaf = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("in_slice"))
    totals = totals.select(*levels, "slice", F.coalesce(F.sum("in_slice").over(in_leaf), F.lit(0)).alias("before_slice"))
    in_slice = Window.partitionBy(*levels, "slice").orderBy("digest", "doc_key", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("inside", F.coalesce(F.sum("n_tokens").over(in_slice), F.lit(0))).join(totals, [*levels, "slice"])
    room = F.col("part") - F.col("before_slice") - F.col("inside")
    cut = cut.withColumn("taken", F.least("n_tokens", room)).where((F.col("taken") > 0))
    back = [F.when(F.col(c) != NO_NAME, F.col(c)).alias(c) for c in levels]
    columns = ["doc_id", "row_key", *back, "epoch", "n_tokens", "taken"]
    return complete.select(*columns).unionAll(cut.select(*columns))
