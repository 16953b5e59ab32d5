"""Mixing sources to target weights: each source's share of words is met by fitting documents of exact lengths.

Every document of a source is taken as often as the target holds the whole source. What is left of the budget is
spread over the lengths in proportion; the last words are fitted as a bounded subset sum over the counts that
remain of each length. Which documents of a length are taken is a matter of a seeded hash of their ids.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm.columns import WORDS, stage, without

# The words that the subset sum fits at most, beside one longest document.
EXACT_WORDS = 1 << 16
# Documents of one source and length are ranked in so many separate parts.
RANK_PARTS = 64

_NEW = ("size", "source_size", "target", "copies", "taken")


def word_count(text: str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def ranked(sources: DataFrame, key: str) -> DataFrame:
    """The rows with ``rank``, their place from 0 by the key's code points, null last; no task gets them all."""
    ordered = sources.repartitionByRange(F.col(key).asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parted = stage(ordered, "mix-ranks")
    counts = parted.groupBy("part").agg(F.count("*").alias("rows"))
    earlier = counts.alias("a").join(counts.select(F.col("part").alias("before"), F.col("rows").alias("more")),
                                     F.col("before") < F.col("part"), "left")
    starts = earlier.groupBy("part").agg(F.coalesce(F.sum("more"), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col(key).asc_nulls_last()))
    return parted.join(starts, "part").withColumn("rank", F.col("start") + place - 1).drop("part", "start")


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``target`` for each source and its ``source_size``: all words, shared by weight.

    No target is over ``most`` times the source's size; what that leaves over is shared anew among the others,
    until none is above. Each round takes two sums over the sources.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = stage(ranked(sources, "source").withColumn("weight", weight), "mix-sources")
    limit = F.col("source_size") * most
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share, full = 0.0, F.lit(False)
    while True:
        over = full | (F.col("weight") * share > limit)
        words, open_weight = weighted.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        anew = (total - words) / open_weight if open_weight else share
        if anew <= share:
            break
        share, full = anew, F.col("weight") * anew > limit
    return weighted.select("source", "source_size", F.when(full, limit.cast("double"))
                           .otherwise(F.col("weight") * F.lit(share)).alias("target"))


def fitted(budget: int, sizes: Sequence[int], counts: Sequence[int]) -> list[int]:
    """How many documents of each size to take: at most their counts, with as nearly the budget's words as can be.

    In proportion first, then the longest first until at most EXACT_WORDS are left, then the subset sum, whose sets
    of reachable sums are the bits of integers. Of two sums equally near the smaller one is met.
    """
    total = sum(s * c for s, c in zip(sizes, counts))
    if total <= 0 or budget <= 0:
        return [0] * len(sizes)
    budget = min(budget, total)
    take = [c * budget // total for c in counts]
    rest = budget - sum(s * t for s, t in zip(sizes, take))
    order = sorted((i for i, s in enumerate(sizes) if s > 0), key=lambda i: -sizes[i])
    for i in order:
        more = min(counts[i] - take[i], max(0, rest - EXACT_WORDS) // sizes[i])
        take[i] += more
        rest -= more * sizes[i]
    reach, steps, mask = 1, [], (1 << (2 * rest + 1)) - 1
    for i in order:
        left, power = min(counts[i] - take[i], 2 * rest // sizes[i]), 1
        while left and not reach >> rest & 1:
            n = min(power, left)
            steps.append((i, n, reach))
            reach = (reach | reach << n * sizes[i]) & mask
            left, power = left - n, power * 2
    below = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = reach >> rest
    at = rest + (above & -above).bit_length() - 1 if above else below
    if rest - below <= at - rest:
        at = below
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= n * sizes[i]
    return take


def _fit_source(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("size")
    take = fitted(rows["budget"][0].as_py(), rows["size"].to_pylist(), rows["docs"].to_pylist())
    return rows.select(["source", "size"]).append_column("take", pa.array(take, pa.int64()))


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: int = 7,
        id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What the mix takes of each document: id, source, size, source_size, target, rows, copies.

    There is one row for each different (id, source, size); ``rows`` says how many documents share it and
    ``copies`` how often these are taken in all. Sources weigh ``weights`` in turn, by code point, null last; a
    null source is a source of its own, a null or empty text has size 0, a null id is an id like any other. No
    document is taken more than ``most`` times. An empty table gives an empty result. Groups need one row for each
    length of a source in one task, never one for each document.
    """
    units = stage(
        docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"))
        .groupBy("id", "source", "size").agg(F.count("*").alias("rows")), "mix-units", docs.count())
    lengths = units.groupBy("source", "size").agg(F.sum("rows").alias("docs"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    aims = targets(sizes, weights, most).withColumn(
        "base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("budget", F.round(F.col("target") - F.col("base") * F.col("source_size")).cast("long"))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    budgeted = lengths.alias("a").join(aims.alias("b"), same).select("a.source", "size", "docs", "budget")
    takes = budgeted.groupBy("source").applyInArrow(_fit_source, "source string, size long, take long")

    # Of each source and length the first ``take`` by hash: whole parts, and the first of the part that is cut.
    hashed = units.withColumn("hash", F.xxhash64(F.lit(seed), "id", "source", "size")) \
        .withColumn("part", F.pmod("hash", F.lit(RANK_PARTS)).cast("int"))
    parts = hashed.groupBy("source", "size", "part").agg(F.sum("rows").alias("held"))
    earlier = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("start", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    plan = starts.alias("a").join(
        takes.alias("b"), same & (F.col("a.size") == F.col("b.size"))
    ).join(aims.alias("c"), F.col("a.source").eqNullSafe(F.col("c.source"))).select(
        "a.source", "a.size", "part", "start", "take", "source_size", "target", "base")
    ahead = Window.partitionBy("a.source", "a.size", "a.part").orderBy("hash", "id") \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("rows").over(ahead), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("take") - before, F.col("rows")))
    joined = hashed.alias("a").join(
        plan.alias("b"), same & (F.col("a.size") == F.col("b.size")) & (F.col("a.part") == F.col("b.part")))
    return joined.select(
        F.col("id").alias(id_col), F.col("a.source").alias(source), F.col("a.size"), "source_size", "target", "rows",
        (F.col("base") * F.col("rows") + extra).cast("long").alias("copies"))


def taken_words(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document, repeated ones too: id, size, source_size, target, copies, taken words."""
    each = mixed.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return _own_copies(each).select(id_col, *_NEW)


def _own_copies(each: DataFrame) -> DataFrame:
    """Copies of the ``nth`` of ``rows`` documents that share their copies."""
    rest = F.col("copies") % F.col("rows")
    own = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("nth") <= rest, 1).otherwise(0)
    return each.withColumn("copies", own.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text: str = "text",
                    source: str = "source") -> DataFrame:
    """The documents that the mix takes, each as often as it takes it, with the columns of docs."""
    kept = without(docs, ["__size", "__nth", "__id", "__source", "__words", "__rows", "__copies", "__own", "__copy"])
    numbered = docs.select(*kept).withColumn("__size", word_count(text)).withColumn("__nth", F.row_number().over(
        Window.partitionBy(id_col, source, "__size").orderBy(F.xxhash64(text))))
    what = mixed.select(F.col(id_col).alias("__id"), F.col(source).alias("__source"), F.col("size").alias("__words"),
                        F.col("rows").alias("__rows"), F.col("copies").alias("__copies"))
    found = numbered.join(what, F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source).eqNullSafe(F.col("__source"))
                          & (F.col("__size") == F.col("__words")))
    more = F.when(F.col("__nth") <= F.col("__copies") % F.col("__rows"), 1).otherwise(0)
    own = (F.floor(F.col("__copies") / F.col("__rows")) + more).cast("long")
    return found.withColumn("__own", own).filter("__own > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__own")))
    ).select(*[f"`{c}`" for c in kept])
