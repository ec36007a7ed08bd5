"""Mixing sources to target weights by entropy balancing.

Every row gets a rate of copies between 0 and ``MOST``. Among all rates that give each source its
target number of words, those nearest to one copy per row (in relative entropy) are
``min(MOST, exp(l * size))`` with one multiplier ``l`` per source, the solution of a convex dual.
Newton iterations find all multipliers at once; an iteration is one aggregation over the counts of
rows by source and size, and a bracket guards its steps. Rates are then rounded into copies by
systematic selection along each source's sizes, so that a source misses its target by about one
long row at most.

Sources weigh 5, 2, 1, repeating in the order of their code points, the null source last. A target
above ``MOST`` times the source's size stops there and the excess is shared out by weight again.
Null and empty texts have size 0 and get no copies; a source without words has target 0. Repeated
rows count each on their own. All orders are by hashes of the row itself, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matrixq.llm.common import count_words, small, written

WEIGHTS = (5, 2, 1)
#: Most copies of a row, on the average and for each.
MOST = 3
#: Newton steps end when every source is this near to its target; more than so many are an error.
NEARNESS, STEPS = 1e-9, 60
#: Rows of one source and size that are ranked by one task.
CELL_ROWS = 1_000
#: Large cells listed for a broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 200_000


def source_key(source: Column) -> Column:
    """Orders by code point with null last, and is never null."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def numbered(df: DataFrame, order: str) -> DataFrame:
    """Adds ``n``, the place from 0 in the order of the distinct keys ``order``.

    Ranges are numbered on their own, after the number of rows in the ranges before them.
    """
    ranged = written(
        df.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "ranged"
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__rows"))
    starts = counts.select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start")
    )
    within = Window.partitionBy("__part").orderBy(order)
    return (
        ranged.join(F.broadcast(starts), "__part")  # one row per partition of the shuffle
        .withColumn("n", F.col("__start") + F.row_number().over(within) - 1)
        .drop("__part", "__start")
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   most: float = MOST) -> DataFrame:
    """Rows ``(skey, source_size, target)`` from rows ``(skey, source_size)``.

    Each round takes out the sources whose share exceeds the bound and shares the rest anew. A
    share only grows from round to round, so a source that is out stays out.
    """
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")
    )
    rows = written(
        numbered(sizes, "skey").select("skey", "source_size", weight.alias("weight")), "sources"
    )
    full = most * F.col("source_size")
    share, out = 0.0, -1
    while True:
        capped = F.col("weight") * F.lit(share) >= full
        seen = rows.agg(
            F.sum("source_size").alias("all"), F.sum(capped.cast("long")).alias("out"),
            F.sum(F.when(capped, full)).alias("fixed"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weights"),
        ).first()
        if not seen["all"] or not seen["weights"] or seen["out"] == out:
            break
        out = seen["out"]
        share = (seen["all"] - (seen["fixed"] or 0)) / seen["weights"]
    target = F.least(full.cast("double"), F.col("weight") * F.lit(share))
    return rows.select("skey", "source_size", target.alias("target"))


def tilts(cells: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """Rows ``(skey, l)``: each source's multiplier, null where all rates are ``most``.

    ``cells`` has rows ``(skey, size, rows)``. Sizes are taken relative to the source's mean word's
    text, so that multipliers are near the logarithm of the share to take.
    """
    scale = cells.groupBy("skey").agg(
        (F.sum(F.col("rows") * F.col("size") * F.col("size").cast("double"))
         / F.sum(F.col("rows") * F.col("size"))).alias("scale")
    )
    open_ = targets.where(
        (F.col("target") > 0) & (F.col("target") < most * F.col("source_size") * (1 - 1e-12))
    )
    state = written(
        open_.join(scale, "skey").select(
            "skey", "target", "scale", F.lit(0.0).alias("l"), F.lit(-1e9).alias("low"),
            F.lit(1e9).alias("high"),
        ), "tilts",
    )
    lever = F.col("size") / F.col("scale")
    rate = F.exp(F.least(F.col("l") * lever, F.lit(50.0)))
    for _ in range(STEPS):
        words = F.col("rows") * F.col("size")
        sums = cells.join(state, "skey").groupBy(*state.columns).agg(
            F.sum(words * F.least(rate, F.lit(float(most)))).alias("got"),
            F.sum(F.when(rate < most, words * rate * lever).otherwise(0.0)).alias("slope"),
        )
        above = F.col("got") > F.col("target")
        low = F.when(above, F.col("low")).otherwise(F.col("l"))
        high = F.when(above, F.col("l")).otherwise(F.col("high"))
        newton = F.col("l") + (F.col("target") - F.col("got")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        halved = (
            F.when(high >= 1e9, F.greatest(low, F.lit(0.0)) * 2 + 1)
            .when(low <= -1e9, F.least(high, F.lit(0.0)) * 2 - 1)
            .otherwise((low + high) / 2)
        )
        away = F.abs(F.col("got") / F.col("target") - 1)
        done = away < NEARNESS
        state = written(
            sums.select(
                "skey", "target", "scale",
                F.when(done, F.col("l")).when(inside, newton).otherwise(halved).alias("l"),
                low.alias("low"), high.alias("high"), away.alias("away"),
            ), "tilts",
        )
        if not state.where(F.col("away") >= NEARNESS).limit(1).count():
            break
        state = state.drop("away")
    else:
        raise RuntimeError(f"the rates of a source have not met its target in {STEPS} steps")
    return state.select("skey", (F.col("l") / F.col("scale")).alias("l"))


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size",
        weights: tuple[float, ...] = WEIGHTS, most: float = MOST,
        order: Column | None = None) -> DataFrame:
    """Adds ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size) to rows.

    ``df`` has a column of whole numbers ``size``; columns with the added names are replaced.
    ``order`` is a hash that decides among rows of one source and size; by default of the key.
    """
    names = ("source_size", "target", "copies", "taken")
    order = F.xxhash64(F.col(f"`{key}`")) if order is None else order
    rows = df.drop(*names).select(
        "*", source_key(F.col(f"`{source}`")).alias("__skey"),
        F.col(f"`{size}`").cast("long").alias("__size"), order.alias("__order"),
    )
    cells = written(
        rows.groupBy(F.col("__skey").alias("skey"), F.col("__size").alias("size"))
        .agg(F.count("*").alias("rows")), "cells",
    )
    targets = source_targets(
        cells.groupBy("skey").agg(F.sum(F.col("rows") * F.col("size")).alias("source_size")),
        weights, most,
    )
    tilt = tilts(cells.where("size > 0"), targets, most)
    rate = (
        F.when((F.col("target") <= 0) | (F.col("size") == 0), F.lit(0.0))
        .when(F.col("l").isNull(), F.lit(float(most)))
        .otherwise(F.least(F.exp(F.col("l") * F.col("size")), F.lit(float(most))))
    )
    # Large cells are cut into parts by hash, as many as their rows need.
    large = small(
        written(
            cells.where(F.col("rows") > CELL_ROWS).select(
                F.col("skey").alias("__skey"), F.col("size").alias("__size"),
                F.ceil(F.col("rows") / CELL_ROWS).alias("__parts"),
            ), "large-cells",
        ), BROADCAST_CELLS,
    )
    rows = rows.join(large, ["__skey", "__size"], "left").withColumn(
        "__part", F.coalesce(F.pmod("__order", "__parts"), F.lit(-1))
    )
    cut = rows.where("__parts is not null").groupBy(
        F.col("__skey").alias("skey"), F.col("__size").alias("size"), F.col("__part").alias("part")
    ).agg(F.count("*").alias("rows"))
    whole = cells.where(F.col("rows") <= CELL_ROWS).select(
        "skey", "size", F.lit(-1).cast("long").alias("part"), "rows"
    )
    rated = (
        whole.unionByName(cut)
        .join(targets, "skey").join(tilt, "skey", "left")
        .withColumn("rate", rate)
        .withColumn("more", F.col("rows") * (F.col("rate") - F.floor("rate")))
    )
    along = Window.partitionBy("skey").orderBy(F.desc("size"), "part")
    upto = F.sum("more").over(along) + 0.5
    picked = written(
        rated.withColumn("upto", upto).withColumn(
            "extra", (F.floor("upto") - F.floor(F.col("upto") - F.col("more"))).cast("long")
        ).select(
            F.col("skey").alias("__skey"), F.col("size").alias("__size"),
            F.col("part").alias("__part"), F.floor("rate").cast("long").alias("__whole"),
            F.least("extra", "rows").alias("__extra"), "source_size", "target",
        ), "picked",
    )
    ranked = Window.partitionBy("__skey", "__size", "__part").orderBy("__order", f"`{key}`")
    joined = rows.withColumn("__rank", F.row_number().over(ranked)).join(
        picked, ["__skey", "__size", "__part"]
    )
    copies = F.col("__whole") + (F.col("__rank") <= F.col("__extra")).cast("long")
    return (
        joined.withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("__size"))
        .select(*[F.col(f"`{c}`") for c in df.columns if c not in names], *names)
    )


def sized(df: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """Adds the number of words of the text."""
    return df.withColumn(size, count_words(F.col(f"`{text}`")))
