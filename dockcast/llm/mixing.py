"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, twice over. A document's virtual finish
time is the number of words its source has sent up to and with it, divided by the source's
target; the second pass comes after the whole first one. Ordered by finish time, all sources
reach their targets together at time 1. The order is cut where the words taken would exceed
the budget.

How the work is spread: a source's running sum is made of two parts, the sums of its hash
slots (a few thousand numbers per source) and a running sum inside each slot, so a source
with a third of all rows is no larger a group than any slot. The global order is never
materialised: finish times fall into bins, the bin in which the budget runs out is found from
the bins' sums, cut into bins again, and only what is left there is ordered.

Null text has size 0. A null source is a source of its own and comes last. A null id is
shuffled like an id called 'null'. Repeated rows are queued one after the other. Documents of
size 0 take no words. No words at all: every target and every taken number is 0. Columns of
the input beyond the three named ones don't matter. The shuffle is a hash of id and text, so reruns
agree and rows that share an id, or have none, are spread like others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockcast.llm.common import words
from dockcast.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
SLOT_ROWS = 200_000_000  # rows for which 16 ** 3 slots suffice; sixteen times as many get a digit more
BINS = 4096


def _place() -> Column:
    """A row's place in the shuffle."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")))))


def sizes(docs: DataFrame) -> DataFrame:
    """Per row: id, source, its number of words, and its place in the shuffle."""
    return docs.select(
        "doc_id",
        "source",
        F.size(words(F.col("text"))).cast("long").alias("size"),
        _place().alias("place"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias("queue"),
    )


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row per source: its size and target.

    Targets are ``least(passes * size, level * weight)``. The level at which they sum to the
    budget is the largest of the levels that hold once the sources before one, in order of
    size per weight, have all they can give.
    """
    per = sized.groupBy("queue").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = per.withColumns(
        {
            "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn % len(weights) + 1),
            "most": F.col("source_size") * float(passes),
        }
    ).withColumn("budget", F.sum("source_size").over(everything) * share)
    order = W.orderBy(F.col("most") / F.col("weight"), "queue")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    level = F.max("level").over(everything)
    return rows.withColumn("level", (F.col("budget") - before) / rest).select(
        "queue", "source_size", "budget", F.least("most", level * F.col("weight")).alias("target")
    )


def _queued(sized: DataFrame, per_source: DataFrame, digits: int) -> DataFrame:
    """Rows with their source's words up to and with them."""
    slotted = sized.withColumn("slot", F.substring("place", 1, digits))
    sums = slotted.groupBy("queue", "slot").agg(F.sum("size").alias("in_slot"))
    ahead = F.sum("in_slot").over(W.partitionBy("queue").orderBy("slot")) - F.col("in_slot")
    offsets = sums.select("queue", "slot", ahead.alias("ahead")).join(per_source, "queue")
    running = F.sum("size").over(
        W.partitionBy("queue", "slot").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    )
    return slotted.join(offsets, ["queue", "slot"]).withColumn("sent", F.col("ahead") + running)


def _item(finish: Column, turn: int) -> Column:
    """What orders the queue: finish time, then names that are the same on every run."""
    return F.struct(finish.alias("finish"), F.col("queue"), F.col("place"), F.col("sent"), F.lit(turn).alias("turn"))


def _bin(finish: Column, scale: int) -> Column:
    return F.floor(F.least(finish, F.lit(2.0)) * scale)


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES, bins: int = BINS
) -> DataFrame:
    """Per row: ``doc_id, source, size, source_size, target, taken`` and ``place``.

    ``taken`` is the number of words of this row in the mix, a multiple of its size between
    0 and ``passes`` times it.
    """
    sized = materialise(sizes(docs), "mix-sizes")
    digits = 3 + max(0, math.ceil(math.log(max(1, sized.count()) / SLOT_ROWS, 16)))
    queued = materialise(_queued(sized, targets(sized, weights, share, passes), digits), "mix-queue")
    goal = F.when(F.col("target") > 0, F.col("target"))
    finish = [(F.col("source_size") * k + F.col("sent")) / goal for k in range(passes)]
    items = queued.select("size", "budget", F.explode(F.array(*[_item(f, k) for k, f in enumerate(finish)])).alias("item"))
    items = items.where("item.finish IS NOT NULL")

    cut, spent = [], 0
    for scale in (bins, bins * bins):
        inside = items
        for s, b in cut:
            inside = inside.where(_bin(F.col("item.finish"), s) == b)
        found = _cut(inside.withColumn("key", _bin(F.col("item.finish"), scale)), spent)
        if found is None:
            break
        cut.append((scale, found["key"]))
        spent = found["total"] - found["size"]
    else:
        for s, b in cut:
            items = items.where(_bin(F.col("item.finish"), s) == b)
        found = _last(items, spent)
    return queued.select(
        "doc_id", "source", "size", "source_size", "target", "place",
        (F.col("size") * sum((_taken(f, k, cut, found) for k, f in enumerate(finish)), F.lit(0))).alias("taken"),
    )


def _cut(keyed: DataFrame, spent: int):
    """The first bin with which the words exceed the budget, None if none does."""
    sums = keyed.groupBy("key").agg(F.sum("size").alias("size"), F.first("budget").alias("budget"))
    totals = sums.withColumn("total", F.sum("size").over(W.orderBy("key")) + spent)
    return totals.where("total > budget").orderBy("key").first()


def _last(items: DataFrame, spent: int):
    """The last item of the bin the budget runs out in that still fits, None if none does."""
    total = F.sum("size").over(W.orderBy("item").rowsBetween(W.unboundedPreceding, 0)) + spent
    return items.withColumn("total", total).where("total <= budget").orderBy(F.col("item").desc()).first()


def _taken(finish: Column, turn: int, cut: list, last) -> Column:
    """1 for an item before the cut, else 0."""
    if len(cut) < 2:  # the budget never runs out
        return F.lit(1) if not cut else F.lit(0)
    (coarse, b1), (fine, b2) = cut
    first, second = _bin(finish, coarse), _bin(finish, fine)
    inside = F.lit(False)
    if last is not None:
        item = last["item"]
        kinds = {"finish": "double", "queue": "string", "place": "string", "sent": "long", "turn": "int"}
        end = F.struct(*[F.lit(item[k]).cast(kind).alias(k) for k, kind in kinds.items()])
        inside = _item(finish, turn) <= end
    before = (first < b1) | ((first == b1) & (second < b2)) | ((first == b1) & (second == b2) & inside)
    return F.when(before, 1).otherwise(0)


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the columns they came with.

    To the mix, rows of one id, source and text are interchangeable. What it takes of such rows
    is dealt out evenly among them, in order of their other columns.
    """
    key = lambda: F.concat_ws("|", F.col("place"), F.concat(F.lit("s"), F.col("source")))
    taken = mix(docs, **options).groupBy(key().alias("key")).agg(
        F.sum(F.when(F.col("size") > 0, F.col("taken") / F.col("size"))).cast("long").alias("times"),
        F.count(F.lit(1)).alias("rows"),
    ).where("times > 0")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), "source", _place().alias("place")).select("row", key().alias("key")).join(taken, "key")
    order = F.when(F.col("rows") > 1, F.to_json("row"))
    turn = F.row_number().over(W.partitionBy("key").orderBy(order))
    own = F.floor(F.col("times") / F.col("rows")) + F.when(turn <= F.col("times") % F.col("rows"), 1).otherwise(0)
    each = keyed.withColumn("own", own.cast("int")).select("row", F.explode(F.array_repeat(F.lit(1), F.col("own"))))
    return each.select("row.*")
