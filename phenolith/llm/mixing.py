"""Mixing sources to target weights by entropy balancing.

Each document gets a rate (its expected number of copies); the rates are those nearest to 1 in relative
entropy, none above ``limit``, that give each source its target of words. Their form is an exponential tilt,
rate = min(limit, exp(lambda * size / mean size)), with one multiplier per source; the multipliers solve the
convex dual by Newton's method, held in a bracket by bisection. A source whose target is ``limit`` times its
size has the rate ``limit`` throughout.

The gradient and curvature of the dual depend on the sizes only, so every iteration is one aggregation over
the histogram of (source, size), made once in a single pass. Rates are whole multiples of 2**-20 and the sums
are exact decimals: neither the order of rows nor the partitioning changes a result.

Rates become copies by systematic rounding along the sizes of a source: the copies of a size are the difference
of the rounded running sum of rates, so a source misses its target by less than its largest document; then
single copies move, largest fitting size first. The copies of a size are dealt evenly over its documents, whose
ranks are taken in buckets of bounded size: a hot size (many copies of one text) is no single group.

Targets: sources in code point order, null last, weigh ``weights`` in turn and share ``total`` (default: all
words); a target stops at ``limit`` times its source's size, and the excess is shared again by weight until
none is above it. If all are at their limit the rest stays unshared.

Null texts have size 0; documents of size 0 have rate 1 and add no words; ties and repeated rows are ranked
one by one; an empty table gives no rows. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from phenolith.llm.common import WORD_PATTERN, fresh, materialise

UNIT = 1 << 20
BUCKET = 4096
EXACT = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3,
                   total: float | None = None) -> DataFrame:
    """source, source_size, target of the table (source, source_size); one row per source, null among them.

    Shared out round by round: each round is one aggregation, and at least one source reaches its limit in
    all but the last."""
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1  # one row per source
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    table = materialise(
        sizes.select("source", "source_size", turn.cast("long").alias("weight"),
                     (F.col("source_size") * limit).alias("most")), "sources")
    if total is None:
        total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        at_limit = F.col("weight") * F.lit(level) >= F.col("most")
        row = table.agg(
            F.sum(F.when(at_limit, F.col("most")).otherwise(0)).alias("fixed"),
            F.sum(F.when(at_limit, 0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(at_limit, 1)).alias("n"),
        ).first()
        if not row.open:
            break
        higher = (total - row.fixed) / row.open
        if higher <= level:
            break
        level = higher
    return table.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def _rate(multiplier: Column, size: Column, mean: Column, limit: int) -> Column:
    """Whole units of 2**-20, at most ``limit``. exp is capped first: beyond the limit its value is unused."""
    power = F.least(multiplier * size / mean, F.lit(math.log(limit) + 1))
    return F.least(F.lit(limit * UNIT), F.round(F.exp(power) * UNIT)).cast("long")


def multipliers(histogram: DataFrame, targets: DataFrame, limit: int = 3, most_rounds: int = 200) -> DataFrame:
    """source_key, multiplier, mean by safeguarded Newton iterations on the dual; ``histogram``: source_key,
    size, n. A source at its limit, or without words, is not here."""
    facts = histogram.where(F.col("size") > 0).groupBy("source_key").agg(
        (F.sum((F.col("n") * F.col("size")).cast(EXACT)) / F.sum(F.col("n").cast(EXACT))).cast("double").alias("mean"),
        F.min("size").alias("least"))
    state = targets.join(facts, "source_key").where(
        (F.col("target") > 0) & (F.col("target") < F.col("source_size") * limit))
    share, reach = F.col("target") / F.col("source_size"), F.col("mean") / F.col("least")
    state = state.select(
        "source_key", "target", "mean",
        F.lit(0.0).alias("multiplier"),
        # at these ends the words taken are surely below, or above, the target
        (F.least(F.lit(0.0), F.log(share)) * reach - 1).alias("low"),
        (F.lit(math.log(limit)) * reach + 1).alias("high"),
        F.lit(False).alias("done"))
    state = materialise(state, "multipliers")
    for _ in range(most_rounds):
        feature = F.col("size") / F.col("mean")
        words = (F.col("n") * F.col("size")).cast(EXACT)
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), limit)
        steep = F.when(rate < limit * UNIT, F.round(rate * feature).cast("long")).otherwise(0)
        sums = (
            histogram.where(F.col("size") > 0)
            .join(state.select("source_key", "multiplier", "mean"), "source_key")
            .groupBy("source_key")
            .agg(F.sum(words * rate.cast(EXACT)).alias("taken"), F.sum(words * steep.cast(EXACT)).alias("slope"))
        )
        over = F.col("taken").cast("double") / UNIT - F.col("target")
        low = F.when(over < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - over / (F.nullif(F.col("slope").cast("double"), F.lit(0.0)) / UNIT)
        near = F.abs(over) <= F.greatest(F.lit(0.5), F.col("target") * 1e-6)
        step = state.join(sums, "source_key").select(
            "*", low.alias("lo"), high.alias("hi"), newton.alias("newton"), near.alias("near"))
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        moved = F.when(F.col("near"), F.col("multiplier")).when(inside, F.col("newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = materialise(step.select(
            "source_key", "target", "mean", moved.alias("multiplier"), F.col("lo").alias("low"), F.col("hi").alias("high"),
            (F.col("near") | (F.col("hi") - F.col("lo") < 1e-12)).alias("done")), "multipliers")
        if state.where(~F.col("done")).isEmpty():
            break
    else:
        raise RuntimeError("the multipliers did not settle")
    return state.select("source_key", "multiplier", "mean")


def _key(source: Column) -> Column:
    """A join key that is never null and keeps null apart from every string."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3, total: float | None = None,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target (of its source), rate, copies; one row per row of ``docs``."""
    rows = materialise(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size")), "sizes")
    histogram = materialise(
        rows.groupBy("source", "size").agg(F.count("*").alias("n")).withColumn("source_key", _key(F.col("source"))), "histogram")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = materialise(source_targets(sizes, weights, limit, total).withColumn("source_key", _key(F.col("source"))), "targets")
    solved = multipliers(histogram.select("source_key", "size", "n"), targets.select("source_key", "source_size", "target"), limit)
    rate = (
        F.when(F.col("size") == 0, F.lit(UNIT))
        .when(F.col("target") <= 0, F.lit(0))
        .when(F.col("multiplier").isNull(), F.lit(limit * UNIT))
        .otherwise(_rate(F.col("multiplier"), F.col("size"), F.col("mean"), limit)).cast("long")
    )
    # running sum of rates up to each size; a group has at most as many rows as the longest document words
    upto = F.sum(F.col("n").cast(EXACT) * F.col("rate")).over(
        W.partitionBy("source_key").orderBy("size").rowsBetween(W.unboundedPreceding, 0))
    cells = (
        histogram.drop("source").join(targets.drop("source"), "source_key").join(solved, "source_key", "left")
        .withColumn("rate", rate)
        .withColumn("upto", upto)
        .withColumn("total", (F.floor((F.col("upto") + UNIT // 2) / UNIT)
                              - F.floor((F.col("upto") - F.col("n") * F.col("rate") + UNIT // 2) / UNIT)).cast("long"))
        .select("source_key", "size", "n", "source_size", "target", "rate", "total")
    )
    cells = _settle(materialise(cells, "cells"), limit).withColumn("buckets", F.ceil(F.col("n") / BUCKET))
    dealt = rows.select("doc_id", "size", _key(F.col("source")).alias("source_key")).join(cells, ["source_key", "size"]).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id"), F.col("buckets")))
    dealt = materialise(dealt, "dealt")
    ahead = F.coalesce(
        F.sum("m").over(W.partitionBy("source_key", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    buckets = dealt.groupBy("source_key", "size", "bucket").agg(F.count("*").alias("m")).select(
        "source_key", "size", "bucket", ahead.alias("ahead"))
    nth = F.row_number().over(W.partitionBy("source_key", "size", "bucket").orderBy("doc_id")) - 1
    ranked = dealt.withColumn("nth", nth).join(buckets, ["source_key", "size", "bucket"])
    upto = lambda k: F.expr(f"(ahead + nth + {k}) * total div n")  # noqa: E731  the copies of a size, dealt evenly
    return ranked.select("doc_id", "size", "source_size", "target", (F.col("rate") / UNIT).alias("rate"),
                         (upto(1) - upto(0)).alias("copies"))


def _settle(cells: DataFrame, limit: int, most_rounds: int = 1000) -> DataFrame:
    """Moves copies of one size at a time, the size that brings the source nearest, until a source is within 0.1% of its target or no
    size can bring it nearer: every round brings a source nearer. Each is one aggregation over the histogram."""
    for _ in range(most_rounds):
        gap = cells.groupBy("source_key").agg(
            (F.first("target") - F.sum(F.col("total").cast(EXACT) * F.col("size")).cast("double")).alias("gap"),
            F.first("target").alias("goal")).where(F.abs("gap") > F.col("goal") * 1e-3).select("source_key", "gap")
        able = F.when(F.col("gap") > 0, F.col("n") * limit - F.col("total")).otherwise(F.col("total"))
        fitting = cells.join(gap, "source_key").where((F.col("size") > 0) & (F.col("size") < 2 * F.abs("gap")) & (able > 0))
        copies = F.least(F.greatest(F.lit(1), F.floor(F.abs("gap") / F.col("size"))), able)
        rest = F.abs(F.abs("gap") - copies * F.col("size"))
        chosen = fitting.groupBy("source_key").agg(
            F.min(F.struct(rest.alias("rest"), (-F.col("size")).alias("size"))).alias("x"), F.first("gap").alias("gap")).select(
            "source_key", (-F.col("x.size")).alias("size"), "gap")
        if chosen.isEmpty():
            break
        moved = copies * F.signum("gap")
        cells = materialise(
            cells.join(chosen, ["source_key", "size"], "left")
            .withColumn("total", F.col("total") + F.coalesce(moved, F.lit(0)).cast("long")).drop("gap"), "cells")
    else:
        raise RuntimeError("the copies did not settle")
    return cells


def repeated(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it has copies. Equal ids share one number of
    copies, the largest of their rows', and rows without an id are taken once."""
    key, times, nth = (fresh(docs, c) for c in ("__id", "__copies", "__nth"))
    copies = mix(docs, doc_id=doc_id, **options).groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times))
    taken = docs.join(copies, F.col(f"`{doc_id}`") == F.col(key), "left").withColumn(
        times, F.coalesce(F.col(times), F.lit(1)).cast("int"))
    return taken.where(F.col(times) > 0).withColumn(nth, F.explode(F.array_repeat(F.lit(0), F.col(times)))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def mixed_digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                            "rate", "copies")
