"""Item co-occurrence C, similarity S and their checks, in coordinate form (absent = 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.functions import similarity
from covista.operators.counts import viewers_per_item
from covista.plans import fan_out_join, spread, stored

HISTORY_BLOCK = 1024
PAIRS_OF_TASK = 4_000_000  # pairs of items that one task counts


def _pairs_inside(blocks: DataFrame) -> DataFrame:
    return (blocks.select("items", F.explode("items").alias("a"))
            .select("a", F.explode("items").alias("b")).where(F.col("a") < F.col("b"))
            .select(F.col("a").alias("item_id"), F.col("b").alias("other_id")))


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """(left, right): different blocks of one history; every block pair is its own unit of work."""
    low = blocks.where(F.col("part") < F.col("parts") - 1).select(
        "user_id", F.col("part").alias("lo"),
        F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("hi"), F.col("items").alias("left"))
    high = blocks.where(F.col("part") > 0).select(
        "user_id", F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("lo"),
        F.col("part").alias("hi"), F.col("items").alias("right"))
    tasks, key = spread(blocks), ["user_id", "lo", "hi"]
    return low.repartition(tasks, *key).join(high.repartition(tasks, *key), key).select("left", "right")


def _pairs_across(blocks: DataFrame) -> DataFrame:
    return (_block_pairs(blocks).select("right", F.explode("left").alias("a")).select("a", F.explode("right").alias("b"))
            .select(F.least("a", "b").alias("item_id"), F.greatest("a", "b").alias("other_id")))


def _partners_inside(blocks: DataFrame) -> DataFrame:
    """(a, others): each item of a sorted block with those after it."""
    return (blocks.select("items", F.posexplode("items").alias("p", "a"))
            .select("a", F.slice("items", F.col("p") + 2, F.size("items")).alias("others")))


def _partners_across(blocks: DataFrame) -> DataFrame:
    """(a, others) between different blocks of one history, again with others that come after the item."""
    sides = F.explode(F.array(F.struct(F.col("left").alias("one"), F.col("right").alias("two")),
                              F.struct(F.col("right").alias("one"), F.col("left").alias("two")))).alias("s")
    return (_block_pairs(blocks).select(sides).select(F.explode("s.one").alias("a"), F.col("s.two").alias("two"))
            .select("a", F.filter("two", lambda x: x > F.col("a")).alias("others")))


def _histories(pairs: DataFrame, item: Column, history_block: int) -> tuple[DataFrame, DataFrame | None]:
    """(items) of short histories, and (user_id, part, parts, items) of the blocks of long ones if there are any."""
    long = stored(pairs.groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n") > history_block)
                  .select("user_id", F.ceil(F.col("n") / history_block).cast("int").alias("parts")), "long-histories")
    any_long = not long.isEmpty()
    short = pairs.join(long, "user_id", "left_anti") if any_long else pairs
    # a fixed partition number: what follows is quadratic in the array length, so the few
    # bytes of the arrays say nothing about the work and partitions must not be merged
    inside = short.repartition(spread(pairs), "user_id").groupBy("user_id").agg(F.collect_list(item).alias("items"))
    if not any_long:
        return inside, None
    cut = pairs.join(long, "user_id").withColumn("part", F.pmod(F.xxhash64("item_id"), F.col("parts")).cast("int"))
    return inside, stored(cut.groupBy("user_id", "part", "parts").agg(F.collect_list(item).alias("items")),
                          "history-blocks").repartition(spread(pairs), "user_id", "part")


def _counted_in_maps(pairs: DataFrame, history_block: int) -> DataFrame:
    inside, blocks = _histories(pairs, F.col("item_id"), history_block)
    made = _pairs_inside(inside)
    if blocks is not None:
        made = made.unionAll(_pairs_inside(blocks)).unionAll(_pairs_across(blocks))
    return made.groupBy("item_id", "other_id").agg(F.count("*").alias("both"))


def narrowest(low: int | None, high: int | None) -> str:
    """The smallest integer type that holds a range."""
    return next((kind for kind, bits in (("tinyint", 7), ("smallint", 15), ("int", 31))
                 if low is None or (-(1 << bits) <= low and high < 1 << bits)), "bigint")


def _counted_at_items(pairs: DataFrame, history_block: int, made: int, with_viewers: bool) -> DataFrame:
    own = viewers_per_item(pairs).select("item_id", "viewers")
    # arrays of partners are nearly all that moves, and compression leaves six bytes of a small long
    id_kind = kind = pairs.schema["item_id"].dataType.simpleString()
    low, high, most = own.agg(*[F.min("item_id"), F.max("item_id")] if kind == "bigint" else [F.lit(None), F.lit(None)], F.max("viewers")).first()
    if kind == "bigint":
        kind = narrowest(low, high)
    item = F.struct(F.col("viewers").cast(narrowest(0, most or 0)).alias("v"), F.col("item_id").cast(kind).alias("i"))
    inside, blocks = _histories(pairs.join(own, "item_id"), item, history_block)
    rows = _partners_inside(inside.select(F.array_sort("items").alias("items")))
    if blocks is not None:
        rows = (rows.unionAll(_partners_inside(blocks.select(F.array_sort("items").alias("items"))))
                .unionAll(_partners_across(blocks)))
    rows = rows.where(F.size("others") > 0)
    ids, tasks = F.transform("others", lambda x: x["i"]), max(spread(pairs), -(-made // PAIRS_OF_TASK))
    if with_viewers:
        sent = rows.select(F.col("a.i").alias("one"), F.col("a.v").alias("v"), ids.alias("items"),
                           F.transform("others", lambda x: x["v"]).alias("w"))
        pair = (sent.repartition(tasks, "one").select("one", "v", F.explode(F.arrays_zip("items", "w")).alias("x"))
                .select("one", F.col("x.items").alias("two"), "v", F.col("x.w").alias("w")))
    else:
        sent = rows.select(F.col("a.i").alias("one"), ids.alias("items"))
        pair = sent.repartition(tasks, "one").select("one", F.explode("items").alias("two"))
    cells = pair.where(F.col("one") != F.col("two")).groupBy(*pair.columns).agg(F.count("*").alias("both"))
    ordered = F.col("one") < F.col("two")
    counts = [F.when(ordered, F.col("v")).otherwise(F.col("w")).cast("bigint").alias("viewers"),
              F.when(ordered, F.col("w")).otherwise(F.col("v")).cast("bigint").alias("other_viewers")] if with_viewers else []
    return cells.select(F.least("one", "two").cast(id_kind).alias("item_id"), F.greatest("one", "two").cast(id_kind).alias("other_id"), *counts, "both")


def half_cells(pairs: DataFrame, history_block: int = HISTORY_BLOCK, with_viewers: bool = False, at_items: bool | None = None) -> DataFrame:
    """(item_id, other_id, both) for item_id < other_id; ``with_viewers`` adds viewers and other_viewers before both.

    Where the items have few cells for the pairs made, pairs are counted in the task that makes them and partial counts
    move. Where most cells are counted once or a few times (``at_items``), an item gets from each viewer one array of the
    other items instead of a row per pair, and is counted where it lies. A pair goes to the item with fewer viewers: an
    item meets only items with at least its viewers, so none gets more than there are rows in ``pairs``.
    """
    made = (pairs.groupBy("user_id").agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0))).first()[0])
    if at_items is None:
        items = pairs.select("item_id").distinct().count()
        at_items = spread(pairs) * items * (items - 1) // 2 * 4 > made
    if at_items:
        return _counted_at_items(pairs, history_block, made, with_viewers)
    cells = _counted_in_maps(pairs, history_block)
    if not with_viewers:
        return cells
    own = viewers_per_item(pairs).select("item_id", "viewers")
    return (cells.join(own, "item_id").join(own.select(F.col("item_id").alias("other_id"), F.col("viewers").alias("other_viewers")), "other_id")
            .select("item_id", "other_id", "viewers", "other_viewers", "both"))


def cooccurrence(pairs: DataFrame, history_block: int = HISTORY_BLOCK, both_orders: bool = True,
                 diagonal: bool = True) -> DataFrame:
    """(item_id, other_id, both): users who viewed both items, from distinct ``pairs``.

    Each unordered pair is made once (``half_cells``) and mirrored after counting; the diagonal is
    the viewer count. Histories over ``history_block`` items are cut in blocks, and their block
    pairs are spread over tasks, so one user with very many items is no hot task.
    """
    cells = half_cells(pairs, history_block)
    if both_orders:
        cells = mirrored(cells)
    if diagonal:
        own = viewers_per_item(pairs).select("item_id", F.col("item_id").alias("other_id"),
                                             F.col("viewers").alias("both"))
        cells = cells.unionAll(own)
    return cells


def cooccurrence_delta(old: DataFrame, new: DataFrame, history_block: int = HISTORY_BLOCK) -> DataFrame:
    """(item_id, other_id, both): what the distinct pairs ``new``, none of them in ``old``, add to the co-occurrence
    of ``old``: BᵀD + DᵀB + DᵀD for the incidences B and D. Only histories of users in ``new`` are read."""
    known = old.join(new.select("user_id").distinct(), "user_id", "left_semi")
    across = (fan_out_join(known.select("user_id", "item_id"), new.select("user_id", F.col("item_id").alias("other_id")),
                           ["user_id"], ["item_id"])
              .groupBy("item_id", "other_id").agg(F.count("*").alias("both")))
    # mirroring gives both products; a pair of items can be new to one user and known to another either way round
    return mirrored(across).unionAll(cooccurrence(new, history_block))


def extended_cooccurrence(cells: DataFrame, old: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells and distinct pairs after more events, from those before; ``cells`` in both orders with the diagonal.

    Old histories are counted again for users with new pairs only.
    """
    new = stored(events.select("user_id", "item_id").distinct()
                 .join(old, ["user_id", "item_id"], "left_anti"), "new-pairs")
    grown = (cells.unionByName(cooccurrence_delta(old, new)).groupBy("item_id", "other_id")
             .agg(F.sum("both").alias("both")))
    return grown, old.select("user_id", "item_id").unionAll(new)


def mirrored(cells: DataFrame) -> DataFrame:
    """Every (item_id, other_id, value) row in both orders."""
    value = cells.columns[-1]
    orders = F.array(F.struct(F.col("item_id").alias("i"), F.col("other_id").alias("j")),
                     F.struct(F.col("other_id").alias("i"), F.col("item_id").alias("j")))
    return (cells.select(F.explode(orders).alias("p"), value)
            .select(F.col("p.i").alias("item_id"), F.col("p.j").alias("other_id"), value))


def item_similarity(cells: DataFrame, metric: str = "counts", viewers: DataFrame | None = None) -> DataFrame:
    """(item_id, other_id, similarity) from co-occurrence cells.

    jaccard and lift need ``viewers(item_id, viewers)``; by default the columns viewers and other_viewers
    of ``cells``, else their diagonal.
    """
    if metric == "counts":
        none = F.lit(None)
        return cells.select("item_id", "other_id", similarity(metric, F.col("both"), none, none).alias("similarity"))
    if viewers is None and "other_viewers" in cells.columns:
        return cells.select("item_id", "other_id", similarity(metric, F.col("both"), F.col("viewers"), F.col("other_viewers")).alias("similarity"))
    if viewers is None:
        viewers = cells.where(F.col("item_id") == F.col("other_id")).select("item_id", F.col("both").alias("viewers"))
    left = viewers.select("item_id", F.col("viewers").alias("_l"))
    right = viewers.select(F.col("item_id").alias("other_id"), F.col("viewers").alias("_r"))
    return (cells.join(left, "item_id").join(right, "other_id")
            .select("item_id", "other_id",
                    similarity(metric, F.col("both"), F.col("_l"), F.col("_r")).alias("similarity")))


def cooccurrence_table(cells: DataFrame, items: list[int]) -> DataFrame:
    """Wide table for a given list of items: one row per item, one column per listed item."""
    wide = (cells.where(F.col("other_id").isin(items)).groupBy("item_id")
            .pivot("other_id", items).agg(F.sum("both")))
    return wide.na.fill(0)


def pairs_per_item(pairs: DataFrame) -> DataFrame:
    """(item_id, pairs): row sums of C. The row of an item adds up the history sizes of its
    viewers, so C itself is not built."""
    sizes = pairs.groupBy("user_id").agg(F.count("*").alias("_n"))
    return pairs.join(sizes, "user_id").groupBy("item_id").agg(F.sum("_n").alias("pairs"))


def most_connected(pairs: DataFrame) -> DataFrame:
    """The item with the largest row sum of C, lowest id on ties."""
    best = F.min(F.struct((-F.col("pairs")).alias("v"), F.col("item_id").alias("i"))).alias("best")
    return pairs_per_item(pairs).agg(best).select(F.col("best.i").alias("item_id"), (-F.col("best.v")).alias("pairs"))


def pair_audit(pairs: DataFrame, audit: DataFrame) -> DataFrame:
    """(item_id, other_id, viewers_a, viewers_b, viewers_both) for given item pairs, counted
    from the viewers themselves."""
    own = viewers_per_item(pairs)
    wanted = audit.select("item_id", "other_id").distinct()
    first = fan_out_join(pairs, wanted, ["item_id"], ["user_id"])
    second = pairs.select("user_id", F.col("item_id").alias("other_id"))
    both = (first.join(second, ["user_id", "other_id"], "left_semi")
            .groupBy("item_id", "other_id").agg(F.count("*").alias("viewers_both")))
    return (wanted.join(both, ["item_id", "other_id"], "left")
            .join(own.select("item_id", F.col("viewers").alias("viewers_a")), "item_id", "left")
            .join(own.select(F.col("item_id").alias("other_id"), F.col("viewers").alias("viewers_b")),
                  "other_id", "left")
            .select("item_id", "other_id",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("viewers_a", "viewers_b", "viewers_both")]))


def consistency_check(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: cells, cells that differ from a recount, asymmetric cells, wrong diagonals.

    The recount joins the pairs with themselves instead of using histories. Both counts of a
    pair of items, in both orders, meet in one aggregation keyed by the unordered pair.
    """
    other = pairs.select("user_id", F.col("item_id").alias("other_id"))
    recount = (fan_out_join(pairs, other, ["user_id"], ["item_id"]).where(F.col("item_id") <= F.col("other_id"))
               .groupBy("item_id", "other_id").agg(F.count("*").alias("n")))
    own = viewers_per_item(pairs).select("item_id", F.col("item_id").alias("other_id"), F.col("viewers").alias("n"))
    low, high = F.least("item_id", "other_id").alias("low"), F.greatest("item_id", "other_id").alias("high")
    names = ["up", "down", "again", "viewers"]

    def tagged(value: str, tag: Column | int) -> Column:
        """Count and source in one number: the rows that meet are three numbers wide."""
        return (F.col(value) * len(names) + tag).alias("n")

    order = F.when(F.col("item_id") <= F.col("other_id"), 0).otherwise(1)
    rows = (cells.select(low, high, tagged("both", order))
            .unionAll(recount.select(low, high, tagged("n", 2)))
            .unionAll(own.select(low, high, tagged("n", 3))))
    sides = rows.groupBy("low", "high").agg(*[
        F.max(F.when(F.pmod("n", F.lit(len(names))) == i, F.expr(f"n div {len(names)}"))).alias(name) for i, name in enumerate(names)])
    apart = F.col("low") != F.col("high")

    def differs(a: str, b: str, where: Column) -> Column:
        return (~F.col(a).eqNullSafe(F.col(b)) & where).cast("long")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return sides.agg(
        (F.count("up") + F.count("down")).alias("cells"),
        total(differs("up", "again", F.lit(True)) + differs("down", "again", apart)).alias("mismatches"),
        total(2 * differs("up", "down", apart)).alias("asymmetric"),
        total(differs("up", "viewers", ~apart)).alias("wrong_diagonal"))
