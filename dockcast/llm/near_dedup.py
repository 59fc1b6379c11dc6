"""Near-duplicates by HyperMinHash sketches, banding and exact confirmation.

1. Each text becomes the set of its word shingles (64-bit hashes) and a sketch: for each of
   ``BUCKETS`` hash functions the smallest hash, kept as its number of leading zeros and the
   ``MANTISSA`` bits after them. Equal sets are one node from here on.
2. Registers in groups of ``ROWS`` are a band; nodes with the same band share a bucket. With
   four registers in 32 bands a pair at similarity 0.75 shares no bucket with probability
   (1 - 0.75 ** 4) ** 32 = 5e-6, pairs above it less.
3. Each node is first held against one node only, the smallest leader of its buckets. What is
   confirmed is merged into components.
4. Buckets whose nodes lie in different components are then compared in blocks, twice. First by
   sketches: a node with a possible partner in another component is named, once a block. Then the
   named nodes come with their full shingle sets: partners are tried in order of their estimate,
   confirmed on the sets, and only links between nodes not yet connected are emitted. So a
   block gives a spanning forest of its confirmed links, fewer rows than it has nodes, however many
   pairs resemble each other. Blocks are cut by hash, by number of nodes and by bytes of their sets.
5. Every candidate is estimated from the sketches, corrected for registers that are equal by
   chance, and dropped only if the estimate is five standard errors below the threshold.
6. Components come from alternating star steps on the links, written to the shared folder.

Rows of one bucket go to the same task only in blocks: the few buckets with more than ``HOT`` nodes are
met by a broadcast while there are at most ``HOT_BUCKETS`` of them, and beyond that by a join whose
skew is split at run time.

A text of fewer words than a shingle is one shingle; a text without words and a null text are
empty and linked with nothing. Repeated rows and equal texts share a node. A component's id is
its smallest non-null ``doc_id`` (null if it has none). Other input columns don't matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import slices
from dockcast.session import materialise

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
BUCKETS = BANDS * ROWS
MANTISSA = 10
BLOCK = 512
BLOCK_BYTES = 32 << 20  # of shingle sets
HOT = 1024
HOT_BUCKETS = 100_000
CACHED = 256  # shingles hashed at a time, so that the hashes stay in a core's cache
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (two rounds of shift and multiply)."""
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _drawn(seed: int, n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _U(2 * seed + 1) + _U(seed << 32))


_BYTE = _drawn(1, 256)
_PLACE = _drawn(2, SHINGLE)
_TIMES = _drawn(3, BUCKETS) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x5851F42D4C957F2D


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[offsets[i]:offsets[i + 1]]``, and words per text."""
    rows = len(offsets) - 1
    data = _LOWER[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    power, inverse = _powers(1 << (len(data) + 1).bit_length())
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    hashes = _mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    counts = np.bincount(np.searchsorted(offsets, starts, "right") - 1, minlength=rows)
    return hashes, counts


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    hashes, counts = _word_hashes(np.frombuffer(data or b"", np.uint8), offsets)
    grams = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        grams += hashes[k : k + len(grams)] * _PLACE[k]
    grams = _mix(grams)
    out, at = [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            own = np.sort(grams[at : at + n - SHINGLE + 1])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif n:
            out.append(_mix((hashes[at : at + n] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + _U(n)))
        else:
            out.append(grams[:0])
        at += n
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The registers of a set that isn't empty."""
    low = np.full(BUCKETS, ~_U(0))
    for start in range(0, len(shingles), CACHED):
        part = shingles[start : start + CACHED, None] * _TIMES
        np.minimum(low, np.minimum.reduce(part, axis=0), out=low)
    fraction, exponent = np.frexp(low.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63)
    bits = ((fraction - 0.5) * (2 << MANTISSA)).clip(0, (1 << MANTISSA) - 1)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | bits.astype(np.uint16)


def bands(registers: np.ndarray) -> np.ndarray:
    """The bucket of each band, for sketches in rows; the band's number is part of the bucket."""
    packed = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), BANDS)
    return _mix(packed ^ _drawn(5, BANDS))


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of these sizes is equal.

    Smallest hashes are about exponential with rates n and m; in the octave that starts at
    2 ** -(i + 1) the cells of a register are 2 ** -(i + 1 + MANTISSA) wide.
    """
    n, m = np.asarray(n, np.float64), np.asarray(m, np.float64)
    total = n + m
    out = np.zeros(np.broadcast(n, m).shape)
    for i in range(40):
        low = 2.0 ** -(i + 1)
        out = out + low * 2.0**-MANTISSA * n * m / total * (np.exp(-total * low) - np.exp(-total * 2 * low))
    return out


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, corrected for chance."""
    by_chance = chance(n, m)
    return (equal - by_chance) / (1 - by_chance)


def _least() -> float:
    t = PERCENT / 100
    return t - 5 * (t * (1 - t) / BUCKETS) ** 0.5


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        sizes, nodes, sketches = [], [], []
        for s in _sets(part.column("text")):
            sizes.append(len(s))
            nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sketches.append(sketch(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sketches, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "node", "sketch"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), "text")


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        buckets = bands(_registers(part.column("sketch"))).view(np.int64).ravel()
        repeat = np.repeat(np.arange(part.num_rows), BANDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(buckets), *[part.column(c).take(pa.array(repeat)) for c in ("node", "size")]], names=["bucket", "node", "size"]
        )


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose estimate doesn't rule a link out."""
    for batch in batches:
        if batch.num_rows:
            n, m = (batch.column(c).to_numpy() for c in ("a_size", "b_size"))
            equal = (_registers(batch.column("a_sketch")) == _registers(batch.column("b_sketch"))).mean(axis=1)
            able = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
            yield batch.select(["a", "b"]).filter(pa.array(able & (estimate(equal, n, m) >= _least())))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        keep = []
        for a, b in zip(_sets(part.column("a_text")), _sets(part.column("b_text")), strict=True):
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _with_both(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    for side in ("b", "a"):
        renamed = nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(renamed, side)
    return pairs.select("a", "b", *[f"{s}_{c}" for s in "ab" for c in columns])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    confirmed = _with_both(pairs, texts, ["text"]).mapInArrow(_confirmed, "a binary, b binary")
    return materialise(confirmed, "near-links")


def components(links: DataFrame) -> DataFrame:
    """Per linked node: ``node, comp``, the smallest node it reaches.

    Large-star and small-star steps in turn until the edges no longer change. Edges point from
    a node to a smaller one, so each step's minimum is an aggregate with a partial step before.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "near-large")
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialise(small.where("u != v").distinct(), "near-small")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        state = now


def _met(rows: DataFrame, buckets: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``rows`` joined with what is known of their buckets; ``hot`` are the buckets of many rows.

    Rows of hot buckets stay where they are. Without ``hot`` (there are too many) the join is left to
    adaptive execution, which splits hot keys.
    """
    if hot is None:
        return rows.join(buckets, "bucket")
    names = F.broadcast(hot.select("bucket"))
    few = rows.join(F.broadcast(buckets.join(names, "bucket", "left_semi")), "bucket")
    return rows.join(names, "bucket", "left_anti").join(buckets.join(names, "bucket", "left_anti"), "bucket").unionByName(few)


def _dealt(rows: DataFrame) -> DataFrame:
    """Members of buckets dealt out as pairs of blocks: rows of one ``(bucket, one, two)`` are compared."""
    parts = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(8 * F.col("sizes") / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("node"), parts).cast("int")
    cut = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    one, two = F.least("block", "other"), F.greatest("block", "other")
    return cut.select("bucket", one.alias("one"), two.alias("two"), (F.col("block") == one).alias("first"), "node", "comp", "size")


def _cross(g: _Rows, start: int, end: int, registers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of different components that may be links, with their estimates."""
    comp, size, first = g.comp[start:end], g.size[start:end], g.first[start:end]
    left = np.flatnonzero(first)
    right = left if g.same[start] else np.flatnonzero(~first)
    i, j = np.nonzero(comp[left][:, None] != comp[right][None, :])
    i, j = left[i], right[j]
    ok = (i < j) if g.same[start] else np.ones(len(i), bool)
    ok &= 100 * np.minimum(size[i], size[j]) >= PERCENT * np.maximum(size[i], size[j])
    i, j = i[ok], j[ok]
    found = [(i[:0], j[:0], np.zeros(0))]
    for at in range(0, len(i), 50_000):
        a, b = i[at : at + 50_000], j[at : at + 50_000]
        guess = estimate((registers[a] == registers[b]).mean(axis=1), size[a], size[b])
        near = guess >= _least()
        found.append((a[near], b[near], guess[near]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _named(g: _Rows, start: int, end: int, payload: list[bytes]) -> np.ndarray:
    """Rows with a possible partner not met in an earlier band."""
    registers = np.frombuffer(b"".join(payload), np.uint16).reshape(-1, BUCKETS)
    a, b, _ = _cross(g, start, end, registers)
    if len(a):
        bucket = bands(registers)
        here = int(np.flatnonzero(bucket[0] == g.bucket[start])[0])
        if here:
            fresh = np.concatenate([~(bucket[a[k : k + 50_000], :here] == bucket[b[k : k + 50_000], :here]).any(axis=1) for k in range(0, len(a), 50_000)])
            a, b = a[fresh], b[fresh]
    return np.unique(np.concatenate([a, b])) + start


def _forest(g: _Rows, start: int, end: int, payload: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed links that connect the rows' components as far as any of their links do."""
    sets = [np.frombuffer(p, np.uint64) for p in payload]
    a, b, guess = _cross(g, start, end, np.stack([sketch(s) for s in sets]))
    order = np.argsort(-guess, kind="stable")
    top = {c: c for c in g.comp[start:end].tolist()}

    def find(c: int) -> int:
        while top[c] != c:
            top[c] = c = top[top[c]]
        return c

    comp, out = g.comp[start:end].tolist(), []
    for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
        x, y = find(comp[i]), find(comp[j])
        if x != y:
            short, long = sorted((sets[i], sets[j]), key=len)
            both = int((long[np.minimum(np.searchsorted(long, short), len(long) - 1)] == short).sum())
            if 100 * both >= PERCENT * (len(short) + len(long) - both):
                top[x] = y
                out.append((i + start, j + start))
    return tuple(np.array(out, np.int64).reshape(-1, 2).T)


def _compared(payload: str, judge, names: list[str]):
    """Streams sorted groups; ``judge`` gives the rows (of each named column) to emit for a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
            starts = _starts(table)
            yield from compare(table, starts)
            rest = table.slice(starts[-1])
        if rest is not None and rest.num_rows:
            yield from compare(rest.combine_chunks(), [0, rest.num_rows])

    def compare(table: pa.Table, starts: list[int]) -> Iterator[pa.RecordBatch]:
        g = _Rows.of(table)
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            if e - s < 2 or (g.comp[s:e] == g.comp[s]).all():
                continue
            found = judge(g, s, e, table[payload].slice(s, e - s).to_pylist())
            found = found if isinstance(found, tuple) else (found,)
            if len(found[0]):
                if len(names) == 1:
                    yield table.take(pa.array(found[0])).select(["bucket", "one", "two", "first", "node", "comp", "size"]).combine_chunks().to_batches()[0]
                else:
                    node = table["node"].combine_chunks()
                    yield pa.RecordBatch.from_arrays([node.take(pa.array(f)) for f in found], names=names)

    return run


class _Rows(NamedTuple):
    """Columns of sorted groups; components as numbers that hold within this table."""

    bucket: np.ndarray
    comp: np.ndarray
    size: np.ndarray
    first: np.ndarray
    same: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> _Rows:
        return cls(
            rows["bucket"].to_numpy().view(np.uint64),
            rows["comp"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64),
            rows["size"].to_numpy(), rows["first"].to_numpy(), rows["one"].to_numpy() == rows["two"].to_numpy(),
        )


def _starts(rows: pa.Table) -> list[int]:
    """Where groups begin; rows are sorted by group."""
    change = np.zeros(rows.num_rows, bool)
    change[:1] = True
    for name in ("bucket", "one", "two"):
        v = rows[name].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change).tolist()


GROUP = "bucket long, one int, two int, first boolean, node binary, comp binary, size long"


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("node"), pa.array([s.tobytes() for s in _sets(part.column("text"))], pa.binary())], names=["node", "shingles"]
        )


def _across(members: DataFrame, hot: DataFrame | None, nodes: DataFrame, texts: DataFrame, comps: DataFrame) -> DataFrame:
    """Links between components: of each pair of blocks a spanning forest of its confirmed links."""
    keys = ["bucket", "one", "two"]
    labelled = materialise(members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "near-labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("bucket")
    dealt = _dealt(_met(labelled, materialise(mixed, "near-mixed"), hot)).join(nodes.select("node", "sketch"), "node")
    named = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compared("sketch", _named, ["node"]), GROUP)
    named = materialise(named, "near-named")
    wanted = texts.join(named.select("node").distinct(), "node", "left_semi").mapInArrow(_set_rows, "node binary, shingles binary")
    whole = named.join(wanted, "node").repartition(*keys).sortWithinPartitions(*keys)
    return materialise(whole.mapInArrow(_compared("shingles", _forest, ["a", "b"]), "a binary, b binary"), "near-links")


def classes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_key, n_shingles, component_id, kept``.

    ``kept`` marks the row with the component's smallest id, and rows without a component.
    """
    keyed = _keyed(docs)
    rows = materialise(
        keyed.mapInArrow(_sketched, "doc_id long, text_key binary, n_shingles long, node binary, sketch binary"), "near-rows"
    )
    some = rows.where("node IS NOT NULL")
    nodes = materialise(
        some.groupBy("node").agg(
            F.min("doc_id").alias("smallest"), F.min(F.struct("doc_id", "text_key")).alias("of"),
            F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"),
        ), "near-nodes",
    )
    banded = nodes.select("node", "size", "sketch").mapInArrow(_banded, "bucket long, node binary, size long")
    buckets = materialise(
        banded.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("sizes")).where("n > 1"),
        "near-buckets",
    )
    hot = buckets.where(F.col("n") > HOT)
    hot = hot if hot.limit(HOT_BUCKETS + 1).count() <= HOT_BUCKETS else None
    members = materialise(_met(banded, buckets, hot), "near-members")
    stars = members.groupBy("node").agg(F.min("leader").alias("a")).where("a < node").select("a", F.col("node").alias("b"))

    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "of.doc_id", "of.text_key")
    same = keyed["doc_id"].eqNullSafe(wanted["doc_id"]) & (keyed["text_key"] == wanted["text_key"])
    texts = materialise(keyed.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "near-texts")

    likely = _with_both(stars, nodes, ["size", "sketch"]).mapInArrow(_likely, "a binary, b binary")
    tested = materialise(likely, "near-pairs")
    links = _links(tested, texts)
    comps = components(links)
    more = _across(members, hot, nodes, texts, comps)
    if not more.isEmpty():
        comps = components(links.unionByName(more))
    ids = nodes.select("node", "smallest").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = ids.groupBy("comp").agg(F.min("smallest").alias("component_id"))
    named = ids.join(least, "comp").select("node", F.col("component_id").alias("found"))
    whole = rows.drop("sketch").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("found"))
    return whole.select("doc_id", "text_key", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component, and all rows without words, with the columns they came with."""
    kept = classes(docs).where("kept").select(F.col("doc_id").alias("keep"), F.col("text_key").alias("of")).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("i"), F.unhex(F.md5(text)).alias("k"))
    joined = keyed.join(kept, F.col("i").eqNullSafe(F.col("keep")) & (F.col("k") == F.col("of")))
    return joined.dropDuplicates(["i", "k"]).select("row.*")
