"""Exact dedup over a cuckoo-filter index of content digests.

The index is cut by digest into shards, one per task. A shard holds a cuckoo filter of short
fingerprints (two candidate buckets of four slots) and, behind each filled slot, the number of
the full digest. A lookup that misses both buckets is a new digest. A hit is only a hint and is
verified against the full digest that the slot names. When an insertion finds no free slot
within a bounded number of moves, the filter doubles and is filled again from the stored
digests. A digest is live while documents with it remain; taking the last away frees its slot.

Tasks first fold their own rows into such an index, so a group of copies with a third of all
rows sends one row per task to its shard.

Texts are equal when they are the same after deleting every blank; null counts as empty, and
all empty texts are equal. Of equal texts the longest original stays, then the smallest id (a
null id is last), then the first of repeated rows. Other input columns don't matter.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import without_blanks
from dockcast.session import materialise

SLOTS = 4
MOVES = 200
SHARD_ROWS = 2_000_000  # rows of the input per shard: some 400 MB in a worker if all texts differ
INDEX_SCHEMA = "digest binary, live long, chars long, keep_id long, keep_row long"
_ARROW = pa.schema([("digest", pa.binary()), *[(c, pa.int64()) for c in ("live", "chars", "keep_id", "keep_row")]])
_LAST = (1 << 63) - 1


class CuckooIndex:
    """Digests with a cuckoo filter in front; numbers of digests are stable while they live."""

    def __init__(self, buckets: int = 256):
        self.keys: list[bytes | None] = []
        self._free: list[int] = []
        self._state = 1
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * SLOTS * buckets))
        self.owners = array("q", bytes(8 * SLOTS * buckets))

    def __len__(self) -> int:
        return len(self.keys) - len(self._free)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        h = int.from_bytes(digest[:8], "little")
        mark = (h & 0xFFFF) or 1
        first = (h >> 16) & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x9E3779B1 >> 7) & self.mask)

    def _slot(self, digest: bytes) -> int:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.keys[self.owners[slot]] == digest:
                    return slot
        return -1

    def find(self, digest: bytes) -> int:
        """The digest's number, -1 if it isn't live."""
        slot = self._slot(digest)
        return -1 if slot < 0 else self.owners[slot]

    def insert(self, digest: bytes) -> int:
        """Adds a digest that isn't live; gives its number."""
        if self._free:
            number = self._free.pop()
            self.keys[number] = digest
        else:
            number = len(self.keys)
            self.keys.append(digest)
        if not self._put(digest, number):
            self._grow()
        return number

    def delete(self, digest: bytes) -> bool:
        slot = self._slot(digest)
        if slot < 0:
            return False
        number = self.owners[slot]
        self.marks[slot] = 0
        self.keys[number] = None
        self._free.append(number)
        return True

    def _put(self, digest: bytes, number: int) -> bool:
        mark, bucket, second = self._places(digest)
        for b in (bucket, second):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.owners[slot] = mark, number
                    return True
        for _ in range(MOVES):
            self._state = (self._state * 1103515245 + 12345) & 0x7FFFFFFF
            slot = bucket * SLOTS + (self._state >> 16) % SLOTS
            self.marks[slot], mark = mark, self.marks[slot]
            self.owners[slot], number = number, self.owners[slot]
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.owners[slot] = mark, number
                    return True
        return False  # one fingerprint has no slot now; the caller fills the filter anew

    def _grow(self) -> None:
        buckets = 2 * (self.mask + 1)
        while True:
            self._clear(buckets)
            if all(self._put(k, n) for n, k in enumerate(self.keys) if k is not None):
                return
            buckets *= 2


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: id, digest of the text without blanks, code points of the original, row number.

    Written once, so that the row numbers stay what they are.
    """
    return materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.unhex(F.sha2(without_blanks(F.col("text")).cast("binary"), 256)).alias("digest"),
            F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of a task folded into one row per live digest.

    Rows that take documents away have a negative ``live`` and come after the others.
    """
    index = CuckooIndex()
    best: list[list[int]] = []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for digest, live, chars, doc, row in zip(*columns, strict=True):
            number = index.find(digest)
            if number < 0:
                if live <= 0:
                    continue
                number = index.insert(digest)
                if number == len(best):
                    best.append([])
                best[number] = [0, -1, 0, 0]
            entry = best[number]
            entry[0] += live
            if entry[0] <= 0:
                index.delete(digest)
            elif live > 0:
                rank = (-chars, _LAST if doc is None else doc, row)
                if entry[1] < 0 or rank < (-entry[1], _LAST if entry[2] is None else entry[2], entry[3]):
                    entry[1:] = [chars, doc, row]
    rows = [(k, *best[n]) for n, k in enumerate(index.keys) if k is not None]
    for start in range(0, len(rows), 10_000):
        part = list(zip(*rows[start : start + 10_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(part, _ARROW, strict=True)], schema=_ARROW)


def _as_index_rows(prints: DataFrame, live: int) -> DataFrame:
    return prints.select(
        "digest", F.lit(live).cast("long").alias("live"), "chars",
        F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
    )


def _sharded(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` dealt by digest, so that no shard has to hold many more than ``SHARD_ROWS`` digests."""
    shards = -(-n // SHARD_ROWS)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(shards, "digest") if shards > usual else rows.repartition("digest")


def build_index(prints: DataFrame) -> DataFrame:
    """One row per live digest: number of documents and the one that stays."""
    local = _as_index_rows(prints, 1).mapInArrow(_fold, INDEX_SCHEMA)
    return _sharded(local, prints.count()).mapInArrow(_fold, INDEX_SCHEMA)


def _remaining(held: DataFrame, removed: DataFrame) -> DataFrame:
    """Index rows of the documents of removed digests that stay, one per digest, id and length."""
    signed = held.select(*held.columns, F.lit(1).alias("sign")).unionByName(removed.select(*held.columns, F.lit(-1).alias("sign")))
    counts = signed.groupBy("digest", "doc_id", "chars").agg(
        F.sum("sign").alias("live"), F.min(F.when(F.col("sign") > 0, F.col("row"))).alias("keep_row")
    )
    return counts.where("live > 0").select("digest", "live", "chars", F.col("doc_id").alias("keep_id"), "keep_row")


def update_index(
    index: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None, members: DataFrame | None = None
) -> DataFrame:
    """The index after adding and taking away documents (as ``fingerprints`` gives them).

    Digests that no document has any more leave the index. With ``members``, the fingerprints of
    the documents the index holds, a digest of which documents are taken away is looked up in
    that content: a removal counts if such a document (digest, id, length) is there, and the
    document that stays is chosen anew. The index then equals one that is built of what is left.

    Without ``members`` a removal takes one from the count of its digest, and the length and id of a
    digest that lives on are those of its last build. Taking away a digest that isn't there
    changes nothing either way.
    """
    parts = index.select(*_ARROW.names)
    if added is not None:
        parts = parts.unionByName(_as_index_rows(added, 1).mapInArrow(_fold, INDEX_SCHEMA))
    if removed is not None and members is not None:
        columns = ["digest", "doc_id", "chars", "row"]
        held = members.select(*columns) if added is None else members.select(*columns).unionByName(added.select(*columns))
        touched = removed.select("digest").distinct()
        parts = parts.join(touched, "digest", "left_anti").unionByName(_remaining(held.join(touched, "digest", "left_semi"), removed))
    elif removed is not None:
        gone = removed.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
        parts = parts.unionByName(
            gone.selectExpr("digest", "-n AS live", "0L AS chars", "cast(null AS long) AS keep_id", "0L AS keep_row")
        )
    ordered = _sharded(parts, index.count()).sortWithinPartitions(F.col("live").desc())
    return ordered.select(*_ARROW.names).mapInArrow(_fold, INDEX_SCHEMA)


def groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, digest``."""
    prints = fingerprints(docs)
    index = build_index(prints)
    return prints.join(index, "digest").select(
        "doc_id", "keep_id", F.col("live").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), "digest"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns they came with.

    The key of the last join names the document that stays, so the copies of a large group
    are spread over all tasks.
    """
    index = build_index(fingerprints(docs))
    stays = index.select("digest", "chars", F.col("keep_id").alias("keep"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # whatever the names of the input, they don't meet ours
    keyed = docs.select(
        row.alias("row"), F.unhex(F.sha2(without_blanks(F.col("text")).cast("binary"), 256)).alias("d"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("c"), F.col("doc_id").cast("long").alias("i"),
    )
    match = (F.col("d") == F.col("digest")) & (F.col("c") == F.col("chars")) & F.col("i").eqNullSafe(F.col("keep"))
    return keyed.join(stays, match).dropDuplicates(["d", "c", "i"]).select("row.*")
