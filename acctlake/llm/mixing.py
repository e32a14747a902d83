"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source is a queue of its documents in a fixed pseudo-random order, repeated as often as
``max_repeats`` allows. A document's virtual finish time is the number of words of its source up to and
including it, divided by the source's target. The mix takes documents by finish time until the budget
is used: as every queue moves in proportion to its target, each source ends near it.

Scale. Running sums are built from two levels, so no source is sorted in one task: a source is cut
by the leading bits of the documents' shuffle keys, sums of the cuts are added up in a small table and
only the documents within one cut are sorted. The global order by finish time is cut into bins of equal
virtual time, which hold about equal numbers of words; sums per bin tell in which bin the budget ends, and
only that bin is sorted. Targets come from one row per source.

Defined results. NULL or empty text: size 0, taken 0. Sources are compared by code point, a NULL source is
a queue of its own and comes last. Equal finish times are decided by source, shuffle key and
document, then repeat; identical rows are interchangeable. A source without words has target 0. An empty
table gives no rows. Columns of ``docs`` other than the named ones are not read; those in ``carried`` come back in a struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctlake.llm.common import slices, stage, word_count

#: Documents of one source that are sorted together, and entries of one bin of virtual time.
ROWS_PER_CUT = 4096
#: Hexadecimal digits of the shuffle key that choose a cut; at most 16 ** 6 cuts a source.
CUT_DIGITS = 6


def source_targets(
    sources: DataFrame, weights: Sequence[float], share: float, max_repeats: int
) -> DataFrame:
    """Columns ``source, source_size, target`` from ``source, source_size``.

    Weights are dealt to the sources in order, NULL last. A target stops at ``max_repeats`` times its
    source's size and the excess is shared again by weight until none is above.
    """
    dealt = stage(_dealt(sources, weights), "targets")
    limit = F.col("source_size") * F.lit(max_repeats)
    total = dealt.agg(F.sum("source_size")).first()[0] or 0
    budget, rate = share * total, 0.0
    # Each round fixes the sources that are full at this rate. The rate only rises, so a
    # source that is full stays full; rounds are as many as there are steps of that kind, not sources.
    while True:
        full = F.lit(rate) * F.col("weight") >= limit
        fixed, open_weight = dealt.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not open_weight:
            break
        raised = (budget - fixed) / open_weight
        if raised <= rate:
            break
        rate = raised
    target = F.when(F.lit(rate) * F.col("weight") >= limit, limit.cast("double")).otherwise(
        F.lit(rate) * F.col("weight")
    )
    return dealt.select("source", "source_size", target.alias("target"))


def _dealt(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """The n-th source in code point order gets the n-th weight, repeating.

    The order is global but made in two levels: sources are sorted within ranges, and a range's first
    number is the count of the ranges before it.
    """
    ranged = stage(
        sources.withColumn("absent", F.col("source").isNull())
        .repartitionByRange("absent", "source")
        .sortWithinPartitions("absent", "source")
        .withColumn("place", F.monotonically_increasing_id()),
        "sources",
    )
    part = F.shiftright("place", 33)
    counts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    number = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    return (
        ranged.withColumn("part", part)
        .join(before, "part")
        .select(
            "source", "source_size",
            F.element_at(dealt, (number % len(weights)).cast("int") + 1).alias("weight"),
        )
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_repeats: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carried: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``, and if ``carried`` names columns, these as
    the struct ``carried``.

    ``taken`` is the number of words the mix takes of the document, repeats counted; the budget is
    ``share`` times all words.
    """
    key = F.coalesce(F.md5(F.col(doc_id).cast("string")), F.lit("f" * 32))
    sized = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"), key.alias("key"),
            *([F.struct(*carried).alias("carried")] if carried else []),
        ),
        "sized",
    )
    rows, words = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = int(share * words)

    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(per_source, weights, share, max_repeats)

    cut = F.conv(F.substring("key", 1, CUT_DIGITS), 16, 10).cast("long")
    cut = F.floor(cut * slices(rows, ROWS_PER_CUT) / 16**CUT_DIGITS).alias("cut")
    sized = sized.withColumn("cut", cut)
    by_cut = sized.groupBy("source", "cut").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_cut.select(
        "source", "cut", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("source", "cut").orderBy("key", "doc_id", "size")
    queue = sized.withColumn(
        "words", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("place", F.row_number().over(within))
    start = _same(queue, offsets, ["source", "cut"]).withColumn("words", F.col("words") + F.col("before"))
    queued = stage(_same(start, targets, ["source"]).drop("before"), "queue")

    finish = [
        F.when(F.col("target") > 0, (F.col("words") + F.col("source_size") * n) / F.col("target"))
        .otherwise(F.lit(0.0))
        for n in range(max_repeats)
    ]
    entries = queued.where("size > 0").select(
        "size", "source", "cut", "place",
        F.posexplode(F.array(*finish)).alias("repeat", "finish"),
    )
    last = _last_entry(entries, budget, slices(rows * max_repeats, ROWS_PER_CUT))
    copies = sum(
        (F.when(_taken(finish[n], n, last), 1).otherwise(0) for n in range(max_repeats)), F.lit(0)
    )
    return queued.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"),
        *(["carried"] if carried else []),
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL equals NULL; columns of ``right`` other than the keys are added."""
    renamed = right.select(
        *[F.col(k).alias(f"{k}__right") for k in keys], *[c for c in right.columns if c not in keys]
    )
    same = [F.col(k).eqNullSafe(F.col(f"{k}__right")) for k in keys]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    return left.join(renamed, on).drop(*[f"{k}__right" for k in keys])


def _order(entries: DataFrame) -> list[Column]:
    return [F.col("finish"), F.col("source").isNull(), F.col("source"), F.col("cut"), F.col("place"), F.col("repeat")]


def _last_entry(entries: DataFrame, budget: int, bins: int):
    """The last entry by finish time that the budget holds; None if it holds none.

    Only one bin is sorted: that in which the budget ends.
    """
    bin_of = F.floor(F.col("finish") * bins).alias("bin")
    per_bin = entries.groupBy(bin_of).agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.orderBy("bin"))
    # As many rows as bins, that is one for each ROWS_PER_CUT entries.
    up_to = stage(per_bin.select("bin", "words", running.alias("up_to")), "bins")
    over = up_to.where(F.col("up_to") > budget).orderBy("bin").first()
    if over is None:
        ending = entries.agg(F.max("finish")).first()[0]
        return None if ending is None else (ending, True, None, None, None, None)
    room = budget - (over["up_to"] - over["words"])
    last_bin = entries.where(bin_of == over["bin"])
    order = _order(entries)
    taken = F.sum("size").over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    entry = (
        last_bin.withColumn("so_far", taken)
        .where(F.col("so_far") <= room)
        .orderBy(*[c.desc() for c in order])
        .select(*[c.alias(f"c{i}") for i, c in enumerate(order)])
        .first()
    )
    if entry is not None:
        return tuple(entry)
    # The first entry of this bin is already too much: everything before the bin is taken.
    return (over["bin"] / bins, None, None, None, None, None)


def _taken(finish: Column, repeat: int, last) -> Column:
    """Whether an entry comes no later than ``last``."""
    if last is None:
        return F.lit(False)
    limit, absent, source, cut, place, last_repeat = last
    if absent is None:
        return finish < F.lit(limit)
    if cut is None:
        return finish <= F.lit(limit)
    here = [F.col("source").isNull(), F.coalesce("source", F.lit("")), F.col("cut"), F.col("place"), F.lit(repeat)]
    there = [F.lit(absent), F.lit(source or ""), F.lit(cut).cast("long"), F.lit(place), F.lit(last_repeat)]
    tie = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(here)]) <= F.struct(
        *[c.alias(f"c{i}") for i, c in enumerate(there)]
    )
    return (finish < F.lit(limit)) | ((finish == F.lit(limit)) & tie)
