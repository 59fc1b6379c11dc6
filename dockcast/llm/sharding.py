"""Shards by proportional stratified interleaving.

Each source's rows are shuffled by a seeded hash and ranked. A row's fractional rank is
``(rank - u) / rows of the source``, where ``u`` is a seeded number of the source between 0 and 1, so that
the rows of many small sources don't meet in one place; ordered by it, every stretch of the table holds each
source in proportion. That order is cut into shards whose row counts differ by one at most.
A shard's number of rows of a source differs from that of the whole mixture by few rows: one, and its
share of as many rows as there are sources.

How the work is spread: a rank is the number of rows in the earlier hash slots of the source (16 **
3 or more slots, whose sums are few) plus a running count inside a slot. The place in the whole
order is found the same way over bins of the fractional rank; each source spreads evenly over
them, so bins are equal whatever the sources' sizes. There are about as many bins as rows in a
bin. Rows that agree in all that is kept are counted first and told apart only at the end, in
blocks, so one row repeated millions of times is no hot slot.

Null text is an empty one (size 1). A null source is a source of its own, the last one; a null id
is shuffled like one called 'null'. Repeated rows get places of their own. With fewer rows than shards
the last ones may be empty; an empty table gives an empty result. Input columns of any name can
be kept: they come in a struct, but maps can't (they have no order). Equal input and seed give
equal shards, however the input is dealt over files.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockcast.session import materialise

SHARDS = 16
SEED = 0
SLOT_ROWS = 100_000_000  # rows for which 16 ** 3 slots suffice; sixteen times as many get a digit more
BINS = 4096
COPIES = 65_536  # equal rows told apart in one go


def _condensed(docs: DataFrame, seed: int, keep: list[str]) -> DataFrame:
    """Rows with their size, checksum and place in the shuffle; equal ones once, with their number."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    parts = [F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text)]
    if keep:
        parts.append(F.xxhash64(row).cast("string"))
    rows = docs.select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(F.concat_ws(":", *parts)).alias("place"),
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source"))).alias("queue"),
        *([row.alias("row")] if keep else []),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def _ranked(rows: DataFrame, digits: int) -> DataFrame:
    """Rows with the rows of their source, and the rank of the last of their copies."""
    slotted = rows.withColumn("slot", F.substring("place", 1, digits))
    sums = slotted.groupBy("queue", "slot").agg(F.sum("copies").alias("in_slot"))
    of_queue = W.partitionBy("queue")
    offsets = sums.select(
        "queue", "slot", (F.sum("in_slot").over(of_queue.orderBy("slot")) - F.col("in_slot")).alias("ahead"),
        F.sum("in_slot").over(of_queue).alias("of_source"),
    )
    order = W.partitionBy("queue", "slot").orderBy("place", "doc_id", *(["row"] if "row" in rows.columns else []))
    joined = slotted.join(offsets, ["queue", "slot"])
    ended = joined.withColumn("last", F.col("ahead") + F.sum("copies").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return ended.withColumn("first", F.col("last") - F.col("copies") + 1).drop("slot", "ahead")


def _apart(ranked: DataFrame, most: int) -> DataFrame:
    """One row for each copy, with its rank; many copies are cut into blocks that are dealt out first."""
    each = lambda df: df.withColumn("rank", F.explode(F.sequence("first", "last")))
    few = each(ranked.where(F.col("copies") <= most))
    blocks = ranked.where(F.col("copies") > most).withColumn("first", F.explode(F.sequence("first", "last", F.lit(most).cast("long"))))
    blocks = blocks.withColumn("last", F.least(F.col("last"), F.col("first") + most - 1)).repartition("queue", "place", "first")
    return few.unionByName(each(blocks)).drop("first", "last", "copies")


def shards(
    docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED, keep: list[str] | None = None, bins: int = BINS, copies: int = COPIES
) -> DataFrame:
    """Per row: ``doc_id, source, size, text_crc32, shard, slot``, and ``row`` with the kept columns.

    ``size`` is the number of UTF-8 bytes of the text plus one; ``slot`` counts from 0 inside a shard.
    """
    keep = keep or []
    rows = materialise(_condensed(docs, seed, keep), "shard-rows")
    total = rows.agg(F.sum("copies")).first()[0] or 0
    digits = 3 + max(0, math.ceil(math.log(max(1, total) / SLOT_ROWS, 16)))
    bins = max(bins, math.isqrt(total))
    spread = _apart(_ranked(rows, digits), copies)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("queue"))), 1, 8), 16, 10).cast("double") / 2.0**32
    spread = spread.withColumn("fraction", (F.col("rank") - offset) / F.col("of_source").cast("double"))
    placed = materialise(spread.withColumn("bin", F.floor(F.col("fraction") * bins)), "shard-ranks")
    per_bin = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("in_bin"))
    ahead = per_bin.select("bin", (F.sum("in_bin").over(W.orderBy("bin")) - F.col("in_bin")).alias("ahead"))
    turn = F.row_number().over(W.partitionBy("bin").orderBy("fraction", "queue", "rank"))
    ordered = placed.join(ahead, "bin").withColumn("at", F.col("ahead") + turn - 1)
    shard = F.expr(f"(at * {n_shards}L) div {max(1, total)}L")
    cut = ordered.withColumn("shard", shard).withColumn("slot", F.expr(f"at - (shard * {total}L + {n_shards - 1}L) div {n_shards}L"))
    return cut.select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot", *(["row"] if keep else [])
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, seed: int = SEED, files: int | None = None) -> None:
    """Writes the rows of ``docs`` below ``path``, one folder per shard, ordered by slot.

    A shard may be many files, each a run of its slots. The input's columns are in the struct ``row``.
    """
    dealt = shards(docs, n_shards, seed, keep=docs.columns).select("shard", "slot", "row")
    files = files or max(n_shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
