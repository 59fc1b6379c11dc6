"""How filters of a corpus overlap: removals in every order, from one table of mask counts.

1. Each text is scanned once for its failure bits and two 64-bit hashes, kept as narrow rows.
2. Counting-Bloom prepass: every task counts its hashes into sketches, blocks of ``BLOCK``
   counters of which a text has ``PROBES``; equal blocks of all tasks are added up. A text with a
   counter of one is the only one of its kind. The marks of counters above one (a bit each) are
   broadcast; there are never more than ``MAX_BLOCKS`` blocks, 512 MB. Beyond the number of rows
   for which that gives ``SPARE`` counters a row fewer texts are cleared, and the result is the same.
3. Only texts that may repeat are shuffled, whole, for the smallest id of each.
4. A row fails the duplicate filter if its text may repeat and the row isn't that of the smallest
   id. Rows meet the ids and labels after equal ones are counted together, and are then counted
   per part and mask: 32 numbers a part, which every order and step is added up from.

Null text is an empty one. A null part is the empty string. A row without an id is never a
repeat and no row repeats it; rows of one id and text are no repeats of each other. An id with several
labels is good or toxic if one of them says so. Every row of ``docs`` counts, repeated ones too.
Other columns don't matter; an empty table gives an empty result. The smallest ids are found on
whole texts; two texts are confused only if they belong to one id and agree in both hashes.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import words
from dockcast.session import materialise

LETTERS = "ABCDE"
REPEAT = 4  # the bit of the duplicate filter, the last letter
BLOCK = 65_536
SPARE = 8
PROBES = 2
MAX_BLOCKS = 65_536
AT_A_TIME = 4_000_000


def rules(text: Column, ws: Column) -> list[Column]:
    """Failure conditions of the filters that look at one text, in order of their letters."""
    capitals = F.length(text) - F.length(F.translate(text, string.ascii_uppercase, ""))
    return [
        F.size(ws) < 100,
        100 * F.size(F.array_distinct(ws)) < 80 * F.size(ws),
        100 * capitals > 10 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")]


def _scanned(docs: DataFrame, part: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"), words(text).alias("ws"))
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(rules(F.col("text"), F.col("ws")))), F.lit(0))
    return split.select("doc_id", "part", bits.alias("bits"), *_hashes(F.col("text")))


# --- the sketch ----------------------------------------------------------------------


def _codes(h: np.ndarray, blocks: int) -> np.ndarray:
    """The counters of each hash: its block and two places there, from bits of their own."""
    h = h.view(np.uint64)
    block = (h & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)
    first, second = (h >> np.uint64(32)) & np.uint64(BLOCK - 1), h >> np.uint64(48)
    codes = np.concatenate([block * np.uint64(BLOCK) + first, (block * np.uint64(BLOCK) + second)[first != second]])
    return codes.astype(np.int64)


def _counted(blocks: int):
    """A task's own sketch: the counters it touched, at most 255 each."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes, n = np.unique(_codes(np.concatenate(held), blocks), return_counts=True)
        block = codes // BLOCK
        cuts = np.flatnonzero(np.diff(block)) + 1
        places = (codes % BLOCK).astype("<u2")
        counts = np.minimum(n, 255).astype(np.uint8)
        for p, c, b in zip(np.split(places, cuts), np.split(counts, cuts), block[np.concatenate([[0], cuts])], strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(b)], pa.int64()), pa.array([p.tobytes()], pa.binary()), pa.array([c.tobytes()], pa.binary())],
                names=["block", "places", "counts"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column("h").to_numpy())
                rows += batch.num_rows
            if rows >= AT_A_TIME:
                yield from flush(held)
                held, rows = [], 0
        if held:
            yield from flush(held)

    return run


def _added(parts: pa.Table) -> pa.Table:
    """One block of the merged sketch; what counts above one is marked in 64-bit integers."""
    total = np.zeros(BLOCK, np.int64)
    for places, counts in zip(parts["places"].to_pylist(), parts["counts"].to_pylist(), strict=True):
        total[np.frombuffer(places, "<u2")] += np.frombuffer(counts, np.uint8)
    marks = np.packbits(total > 1, bitorder="little").view("<i8")
    return pa.table({"block": parts["block"][:1], "marks": pa.array([marks.tolist()], pa.list_(pa.int64()))})


def repeat_marks(hashes: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The marks ``block, marks`` of counters that were hit more than once, and the number of blocks."""
    blocks = min(MAX_BLOCKS, max(1, -(-SPARE * rows // BLOCK)))
    partial = hashes.select("h").mapInArrow(_counted(blocks), "block long, places binary, counts binary")
    merged = partial.groupBy("block").applyInArrow(_added, "block long, marks array<long>")
    return materialise(merged, "audit-marks"), blocks


def _may_repeat(blocks: int) -> Column:
    """Whether all counters of ``h`` are marked."""
    bit = lambda shift: F.expr(f"getbit(get(marks, cast(shiftrightunsigned(h, {shift + 6}) & {BLOCK // 64 - 1} AS int)), cast(shiftrightunsigned(h, {shift}) & 63 AS int)) = 1")
    return bit(32) & bit(48)


def _block(blocks: int) -> Column:
    return F.expr(f"(h & 4294967295L) % {blocks}L")


def _firsts(docs: DataFrame, marks: DataFrame, blocks: int) -> DataFrame:
    """The smallest id of every text that may repeat: ``doc_id, h, g``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = docs.where("doc_id IS NOT NULL").select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    found = hashed.withColumn("block", _block(blocks)).join(F.broadcast(marks), "block").where(_may_repeat(blocks))
    least = found.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return least.select("doc_id", *_hashes(F.col("text"))).distinct().withColumn("first", F.lit(True))


# --- counts --------------------------------------------------------------------------


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Per part and mask of failed filters: ``part, mask, n, n_good, n_toxic``."""
    scanned = materialise(_scanned(docs, part), "audit-rows")
    marks, blocks = repeat_marks(scanned, scanned.count())
    firsts = _firsts(docs, marks, blocks)
    keys = ["doc_id", "part", "bits", "h", "g"]
    alike = scanned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    tested = alike.withColumn("block", _block(blocks)).join(F.broadcast(marks), "block").withColumn("may", _may_repeat(blocks)).drop("block", "marks")
    flag = lambda name: F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0))).alias(name)
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(flag("quality"), flag("toxic")).where("quality = 1 OR toxic = 1")
    named = tested.where("doc_id IS NOT NULL").join(known, "doc_id", "left").join(firsts, ["doc_id", "h", "g"], "left")
    repeat = F.col("may") & F.col("first").isNull()
    named = named.select("part", "n", "quality", "toxic", (F.col("bits") + F.when(repeat, 1 << REPEAT).otherwise(0)).alias("mask"))
    unnamed = tested.where("doc_id IS NULL").select("part", "n", F.lit(0).alias("quality"), F.lit(0).alias("toxic"), F.col("bits").alias("mask"))
    both = named.unionByName(unnamed)
    of = lambda name: F.coalesce(F.sum(F.when(F.col(name) == 1, F.col("n"))), F.lit(0)).alias({"quality": "n_good"}.get(name, f"n_{name}"))
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("quality"), of("toxic"))


def interactions(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Per part, order and step what the step's filter does: see ``COLUMNS`` of the result.

    ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``; all are sums over masks.
    A filter removes a row in the orders that have it before the row's other failures, so the
    removals over all orders are the orders divided by the row's number of failures.
    """
    orders = ["".join(p) for p in itertools.permutations(letters)]
    bit = {c: 1 << k for k, c in enumerate(letters)}
    steps = [(order, k + 1, bit[c], sum(bit[b] for b in order[:k])) for order in orders for k, c in enumerate(order)]
    cases = sorted({s[2:] for s in steps})  # a filter and what came before it
    case = F.explode(F.array(*[F.struct(F.lit(own).alias("own"), F.lit(prior).alias("prior")) for own, prior in cases]))
    spread = counts.select("*", case.alias("case")).select("*", "case.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("prior")) != 0
    total = lambda name, value, when: F.coalesce(F.sum(F.when(when, F.col(value))), F.lit(0)).cast("long").alias(name)
    share = F.expr(f"n * ({len(orders)} div greatest(bit_count(mask), 1))")
    sums = spread.groupBy("part", "own", "prior").agg(
        total("kept", "n", ~fails & ~earlier), total("removed", "n", fails & ~earlier), total("redundant", "n", fails & earlier),
        total("unique_fails", "n", F.col("mask") == F.col("own")), total("good_lost", "n_good", fails & ~earlier),
        total("toxic_lost", "n_toxic", fails & ~earlier), F.coalesce(F.sum(F.when(fails, share)), F.lit(0)).cast("long").alias("shapley"),
    )
    named = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, own int, prior int")
    return sums.join(named, ["own", "prior"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    return interactions(mask_counts(docs, labels, part))
