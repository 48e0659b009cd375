"""Mixing sources to target weights: budgets through a tree of groups, with DataFrame functions only.

The tree's levels are, for example, domain, language and source.  The token budget enters at the root and is split among
children by weight.  A child that cannot use its share (its tokens times ``max_epochs``) is filled, and the shortage goes to
its siblings by weight; only what all siblings together cannot use stays unused above, where the parent's own siblings
got it before.  All sums are whole numbers in decimals, so the result is exact and repeatable.

Each leaf then takes whole epochs and a prefix of the next.  An epoch is the leaf's documents in the order of a seeded
hash.  The prefix is found by hash bucket: token sums per (leaf, bucket), a running sum over buckets, and a running sum over
documents only inside the one bucket where the quota ends.  Buckets hold a few thousand documents whatever the leaf's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.workers import materialize

_BIG = "decimal(38,0)"


def token_count(text: str) -> Column:
    """Tokens of a text for budgeting: its words between ASCII white space."""
    return F.coalesce(F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")), F.lit(0)).cast("long")


def split_budget(children: DataFrame, by: list[str], name: str) -> DataFrame:
    """``children`` (``parent_budget, capacity, weight``) with ``budget``: water-filling among the rows of ``by``.

    Filled children are those of least capacity per weight.  Shares are rounded down.  Weight 0 gets nothing.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    order = Window.partitionBy(*by).orderBy(ratio.asc_nulls_last(), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    own = children.withColumn("filled_before", F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(_BIG)).withColumn("weight_left", F.sum("weight").over(rest).cast(_BIG))
    # The child is filled if its share of what its poorer siblings left reaches its capacity.
    fills = (F.col("weight") > 0) & (F.col("capacity") * F.col("weight_left") <= (F.col("parent_budget") - F.col("filled_before")) * F.col("weight"))
    own = own.withColumn("fills", fills)
    whole = Window.partitionBy(*by)
    own = own.withColumn("filled", F.coalesce(F.sum(F.when(F.col("fills"), F.col("capacity"))).over(whole), F.lit(0)).cast(_BIG)).withColumn("open_weight", F.coalesce(F.sum(F.when(~F.col("fills"), F.col("weight"))).over(whole), F.lit(0)).cast(_BIG))
    share = F.floor((F.col("parent_budget") - F.col("filled")) * F.col("weight") / F.col("open_weight"))
    own = own.withColumn("budget", F.when(F.col("fills"), F.col("capacity")).when(F.col("weight") > 0, F.least(share.cast(_BIG), F.col("capacity"))).otherwise(F.lit(0)).cast(_BIG))
    return own.drop("filled_before", "weight_left", "fills", "filled", "open_weight")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[Column], budget: int, max_epochs: int) -> DataFrame:
    """``leaves`` (levels and ``tokens``) with ``quota``.  ``weights[i]`` is the whole-number weight of a node of level i."""
    tree = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast(_BIG))
    nodes = None
    for depth in range(len(levels)):
        own = tree.groupBy(*levels[: depth + 1]).agg(F.sum("capacity").cast(_BIG).alias("capacity"))
        own = own.withColumn("weight", weights[depth].cast(_BIG))
        if nodes is None:
            own = own.withColumn("parent_budget", F.lit(budget).cast(_BIG)).withColumn("root", F.lit(0))
            nodes = split_budget(own, ["root"], levels[0])
        else:
            above = nodes.select(*levels[:depth], F.col("budget").alias("parent_budget"))
            nodes = split_budget(own.join(above, levels[:depth]), levels[:depth], levels[depth])
        nodes = nodes.select(*levels[: depth + 1], "budget")
    return leaves.join(nodes, levels).select(*levels, *[c for c in leaves.columns if c not in levels], F.col("budget").cast("long").alias("quota"))


def mix(docs: DataFrame, *, budget_share: float, levels: dict[str, Column], weights: list[Column], tokens: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, max_epochs: int = 4, carry: list[str] | None = None, bucket_docs: int = 4096) -> DataFrame:
    """Selected rows ``row, <levels>, tokens, epoch``: each document once for each epoch that takes it.

    ``row`` is a struct of the input columns named by ``carry`` (all by default).  The budget is ``budget_share`` of all
    tokens.  A prefix takes documents in order while the running sum stays within the quota, so a leaf falls short by less
    than one document; documents without tokens cost nothing and are in every epoch that begins at their place.  Null
    levels read as the text ``?``.  Rows with equal ids and texts are separate documents with equal order.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (carry if carry is not None else docs.columns)]).alias("row")
    names = list(levels)
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("?")), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    rows = docs.select(carried, *[F.coalesce(c.cast("string"), F.lit("?")).alias(n) for n, c in levels.items()], tokens.alias("tokens"), key.alias("key"))
    rows = materialize(rows, "mix-rows")
    leaves = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs"))
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    quotas = leaf_budgets(leaves, names, weights, int(total * budget_share), max_epochs)
    # Whole epochs, the rest of the quota, and how many bits of the order make a bucket.
    full = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(F.lit(0)).cast("int")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_docs") / bucket_docs))).cast("int")
    quotas = quotas.select(*names, full.alias("full"), (F.col("quota") - full * F.col("tokens")).alias("rest"), bits.alias("bits"))
    quotas = materialize(quotas, "mix-quotas")
    placed = rows.join(quotas, names)
    # 60 bits of an md5 are the place in the epoch's order.
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("full").cast("string"), F.col("key")).cast("binary")), 1, 15), 16, 10).cast("long")
    placed = placed.withColumn("place", place).withColumn("bucket", F.expr("shiftright(place, 60 - bits)"))
    sums = placed.groupBy(*names, "bucket").agg(F.sum("tokens").alias("bucket_tokens"), F.first("rest").alias("rest"))
    running = Window.partitionBy(*names).orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("bucket_tokens").over(running))
    sums = sums.select(*names, "bucket", (F.col("upto") - F.col("bucket_tokens")).alias("from_tokens"), (F.col("upto") <= F.col("rest")).alias("inside"))
    placed = placed.join(sums, [*names, "bucket"])
    # Only the bucket where the quota ends is ordered document by document.
    edge = placed.filter(~F.col("inside") & (F.col("from_tokens") <= F.col("rest")))
    order = Window.partitionBy(*names, "bucket").orderBy("place", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.col("from_tokens") + F.sum("tokens").over(order)).filter(F.col("upto") <= F.col("rest")).drop("upto")
    last = placed.filter("inside").unionByName(edge).select("row", *names, "tokens", F.col("full").alias("epoch"))
    whole = rows.join(quotas.filter("full > 0"), names).select("row", *names, "tokens", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("epoch"))
    # A leaf that is used up has no further epoch.
    return whole.unionByName(last.filter(F.col("epoch") < max_epochs))
