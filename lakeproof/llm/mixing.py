"""Mixing sources to target weights by hierarchical budgeting, in DataFrame expressions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeproof.llm import frames

# Order keys are split into this many ranges, so that a leaf's prefix is found by sums and one range's order.
RANGES = 1 << 12


def words(text: Column) -> Column:
    """Number of words, the measure of tokens when none is given."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))).cast("long")


def _same(a: Sequence[Column], b: Sequence[Column]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b, strict=True):
        out = out & x.eqNullSafe(y)
    return out


def _weight(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    out = F.lit(1.0)
    for value, w in weights.get(level, {}).items():
        if not w > 0:
            raise ValueError(f"weight of {level} {value} must be above 0")
        out = F.when(F.col(level) == value, F.lit(float(w))).otherwise(out)
    return out


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], fraction: float, max_epochs: int) -> DataFrame:
    """``leaves`` (levels…, tokens) with the tokens each shall give (``quota``).

    From the root down, a node's budget is shared among its children in
    proportion to their weights. A child can give no more than its own leaves
    hold in ``max_epochs`` passes; what it cannot give goes to its siblings by
    their weights, and only what all of them cannot give goes back to the parent,
    whose own siblings then take it: the parent's room is the sum of its
    children's. The share per weight at which a node's budget is spent follows
    from running sums over its children, ordered by room per weight.
    """
    levels = list(levels)
    room = F.col("tokens") * F.lit(max_epochs)
    leaves = leaves.withColumn("_root", F.lit(0))
    frame = leaves.groupBy("_root").agg(
        F.least(F.floor(F.sum("tokens") * F.lit(fraction)), F.sum(room)).cast("double").alias("_budget")
    )
    parent = ["_root"]
    for level in levels:
        path = [*parent, level]
        children = leaves.groupBy(*path).agg(F.sum(room).cast("double").alias("_room")).withColumn("_weight", _weight(level, weights))
        renamed = frame.select(*[F.col(c).alias(f"_p_{c}") for c in parent], "_budget")
        children = children.join(renamed, _same([F.col(c) for c in parent], [F.col(f"_p_{c}") for c in parent])).drop(*[f"_p_{c}" for c in parent])
        ratio = F.col("_room") / F.col("_weight")
        own = Window.partitionBy(*parent).orderBy(ratio, *path)
        before = own.rowsBetween(Window.unboundedPreceding, -1)
        rest = own.rowsBetween(0, Window.unboundedFollowing)
        share = (F.col("_budget") - F.coalesce(F.sum("_room").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
        children = children.withColumn("_share", share).withColumn("_ratio", ratio)
        # Children whose room per weight is below the share at their turn give all; the first that is not sets it
        # for the rest, and the shares of those after it can only be smaller.
        level_share = F.max(F.when(F.col("_ratio") >= F.col("_share"), F.col("_share"))).over(Window.partitionBy(*parent))
        frame = children.withColumn("_level", level_share).select(
            *path, F.least("_room", F.coalesce(F.col("_level"), F.col("_ratio")) * F.col("_weight")).alias("_budget")
        )
        parent = path
    quota = frame.select(*[F.col(c).alias(f"_p_{c}") for c in levels], F.floor(F.col("_budget") + 1e-6).cast("long").alias("quota"))
    return leaves.join(quota, _same([F.col(c) for c in levels], [F.col(f"_p_{c}") for c in levels])).drop(*[f"_p_{c}" for c in levels], "_root")


def mixture(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, float]],
    fraction: float,
    max_epochs: int = 2,
    seed: int = 7,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the levels, n_tokens, quota (of the leaf) and n_copies.

    ``levels`` names the tree from the root down, e.g. domain, language, source,
    each by an expression over ``docs``; ``weights`` gives values of a level
    their weight among siblings, 1 where none is named. ``fraction`` of all
    tokens is the budget. A leaf whose quota is q and which holds t tokens gives
    all its documents q // t times, and once more those at the start of the next
    epoch's order whose tokens together stay within what is left. Each epoch has
    an order of its own, drawn from ``seed``, the epoch and the row.

    n_copies is 0 for documents left out. A null level is a value of its own. A
    null or empty text has no tokens: it is taken wherever its place in the order
    lies within the prefix. Equal rows have the same place and are taken together
    or not at all. An empty table gives an empty result. Added columns replace
    columns of ``docs`` of the same name.

    A leaf may hold any part of all rows: its prefix is found from sums over
    ranges of the order key, and only the one range where the quota ends is
    sorted. Texts are read twice and never shuffled.
    """
    names = [f"_level_{n}" for n in levels]
    measure = tokens if tokens is not None else words(F.col(f"`{text_col}`"))
    tagged = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        *[c.alias(n) for n, c in zip(names, levels.values(), strict=True)],
        frames.row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_key"),
        measure.alias("tokens"),
    )
    weights = {f"_level_{n}": w for n, w in weights.items()}
    small = frames.materialise(tagged.select(*names, "_key", "tokens"), "mixing")
    leaves = frames.materialise(
        budgets(small.groupBy(*names).agg(F.sum("tokens").alias("tokens")), names, weights, fraction, max_epochs)
        .withColumn("_full", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.greatest("tokens", F.lit(1)))).otherwise(F.lit(0)).cast("int"))
        .withColumn("_left", F.col("quota") - F.col("_full") * F.col("tokens"))
        .select(*[F.col(n).alias(f"_p_{n}") for n in names], "quota", "_full", "_left"),
        "mixing-leaves",
    )
    on = _same([F.col(n) for n in names], [F.col(f"_p_{n}") for n in names])
    order = F.xxhash64(F.lit(seed), F.col("_full"), F.col("_key"))
    placed = small.join(leaves, on).select(
        *[f"_p_{n}" for n in names], "_left", "tokens", order.alias("_order"), F.shiftright(order, 52).alias("_range")
    )
    leaf = [f"_p_{n}" for n in names]
    sums = placed.groupBy(*leaf, "_left", "_range").agg(F.sum("tokens").alias("_sum"))
    running = F.sum("_sum").over(Window.partitionBy(*leaf).orderBy("_range"))
    last = (
        sums.withColumn("_through", running)
        .where(F.col("_through") > F.col("_left"))
        .groupBy(*leaf)
        .agg(F.min(F.struct("_range", (F.col("_through") - F.col("_sum")).alias("_before"))).alias("_cut"))
        .select(*[F.col(c).alias(f"{c}2") for c in leaf], F.col("_cut._range").alias("_cut_range"), F.col("_cut._before").alias("_before"))
    )
    inside = placed.join(last, _same([F.col(c) for c in leaf], [F.col(f"{c}2") for c in leaf]) & (F.col("_range") == F.col("_cut_range")))
    so_far = F.col("_before") + F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("_order"))
    border = (
        inside.withColumn("_through", so_far)
        .where(F.col("_through") > F.col("_left"))
        .groupBy(*leaf)
        .agg(F.min("_order").alias("_stop"))
        .select(*[F.col(c).alias(f"{c}3") for c in leaf], "_stop")
    )
    cuts = leaves.join(border, _same([F.col(c) for c in leaf], [F.col(f"{c}3") for c in leaf]), "left").select(
        *leaf, "quota", "_full", "_stop"
    )
    again = F.coalesce(order < F.col("_stop"), F.lit(False)).cast("int")
    added = [*levels, "n_tokens", "quota", "n_copies"]
    chosen = tagged.join(frames.materialise(cuts, "mixing-cuts"), on)
    return chosen.select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in added],
        *[F.col(n).alias(name) for n, name in zip(names, levels, strict=True)],
        F.col("tokens").alias("n_tokens"),
        "quota",
        (F.col("_full") + again).alias("n_copies"),
    )
