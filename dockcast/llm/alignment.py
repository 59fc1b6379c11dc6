"""Alignment of two tokenizers' tokens over whole texts.

Both tokenizers read every text; byte lengths of their tokens give byte ends. A place where
tokens of both end, and where both next tokens begin with a space, is an anchor. Anchors cut the
text into windows, which are pairs of id tuples. What a window holds is worked out once for a
pair of tuples and then looked up: its groups (between places where both tokenizers' tokens
end) and its links (pairs of tokens whose bytes overlap).

The alignments are written once; then id pairs are counted over the corpus (in how many rows
each is linked), partly in the tasks, and each row's links meet the counts. Pairs of one row
aren't looked up: a pair not found has a count of one. The pairs in most rows, ``MAX_PAIRS`` at
most, are broadcast; if there are more, the others are few in each case and are joined by a shuffle.

Tokens of a text count only if the joined bytes of either tokenizer's tokens are a space and the
text. Otherwise, and for null and empty texts, there are none: zeros and empty ``groups``. Every
row of ``docs`` is a document, repeated ones too. Other columns don't matter; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import slices, texts_of
from dockcast.session import materialise

MAX_KEPT = 100_000  # windows, and those of one run of rows
LONG = 64  # tokens of a window that is kept at most
MAX_PAIRS = 2_000_000  # pairs broadcast, 13 bytes each
PAIRS_AT_A_TIME = 4_000_000


class Tokenizer(NamedTuple):
    """Ids of texts, and each id's bytes."""

    encode: Callable[[list[str]], list[np.ndarray]]
    spelled: list[bytes]


def byte_level(path: str, pattern: str | None = None) -> Tokenizer:
    """A byte-level BPE file. A space goes before the text; special strings are plain text.

    ``pattern`` is that by which the file's library cuts a text. With it, and if each token is made by
    one merge and ids are in order of the merges, the ids are the ranks of the faster of two libraries that
    merge alike; otherwise the file's own library encodes.
    """
    code = _byte_code()
    raw = lambda t: bytes(code[c] for c in t)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, front = spec["model"], spec["pre_tokenizer"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {t: n for t, n in model["vocab"].items() if t not in special}
    names = {n: raw(t) for t, n in vocab.items()} | {n: t.encode() for t, n in special.items()}
    spelled = [names.get(n, b"") for n in range(max(names) + 1)]
    made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    plain = front["type"] == "ByteLevel" and not front["add_prefix_space"] and not model.get("ignore_merges")
    ordered = made == sorted(set(made)) and len(made) + 256 == len(vocab) and min(made) >= 256
    if pattern and plain and ordered:
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={raw(t): n for t, n in vocab.items()}, special_tokens={})
        return Tokenizer(lambda texts: [fast.encode_to_numpy(" " + t, disallowed_special=()) for t in texts], spelled)

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer as Library

    library = Library.from_file(path)
    library.encode_special_tokens = True
    return Tokenizer(
        lambda texts: [np.array(e.ids, "<u4") for e in library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], spelled
    )


def pieces(path: str) -> Tokenizer:
    """A sentence-piece model with byte fallback, which puts the space before the text itself."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [library.id_to_piece(n) for n in range(library.get_piece_size())]
    spelled = [bytes([int(t[3:5], 16)]) if library.is_byte(n) else t.replace("▁", " ").encode() for n, t in enumerate(names)]
    return Tokenizer(lambda texts: [np.array(ids, "<u4") for ids in library.encode(texts, num_threads=1)], spelled)


def _byte_code() -> dict[str, int]:
    """The printable characters by which byte-level files write bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


OTHER = 1 << 31  # marks the ids of the second tokenizer in a window's key


class Window(NamedTuple):
    """The groups as text, each with its end sign, their number, and the linked id pairs, one for each link."""

    groups: str
    n_groups: int
    links: np.ndarray


class Row(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: np.ndarray


NOTHING = Row(0, 0, 0, "", np.zeros(0, np.int64))


class Aligner:
    """Cuts texts into windows and keeps what was found for their id tuples, packed as one key."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a, self.b = a, b
        self.kept: dict[bytes, Window] = {}
        self._length = [np.array([len(t) for t in x.spelled], np.int64) for x in (a, b)]
        self._spaced = [np.array([t[:1] == b" " for t in x.spelled]) for x in (a, b)]
        # An id is written with the sign behind it: inside a group, at the end of its first half, at its end.
        self._written = [f"{n}{sign}" for x, signs in ((a, ",|"), (b, ",;")) for sign in signs for n in range(len(x.spelled))]

    def align(self, keys: list[bytes]) -> list[Window]:
        """The windows of all keys, in one pass over their ids one after the other.

        Tokens of both end where a window ends, so windows don't touch each other's groups and links.
        """
        ids = np.frombuffer(b"".join(keys), "<u4").astype(np.int64)
        ends = np.array([len(k) // 4 for k in keys], np.int64).cumsum()
        of_b = ids >= OTHER
        a, b = ids[~of_b], ids[of_b] - OTHER
        cut_b = of_b.cumsum()[ends - 1]
        cut_a = ends - cut_b
        end_a, end_b = self._length[0][a].cumsum(), self._length[1][b].cumsum()
        last = np.searchsorted(end_b, end_a)
        closes_a = end_b[last] == end_a
        closes_b = end_a[np.searchsorted(end_a, end_b)] == end_b
        group_a, group_b = (np.cumsum(c) - c for c in (closes_a, closes_b))
        # A token overlaps those from the one that holds its first byte to the one that holds its last.
        first = np.searchsorted(end_b, end_a - self._length[0][a], "right")
        many = last - first + 1
        ends = many.cumsum()
        at = np.repeat(first - (ends - many), many) + np.arange(ends[-1])
        links = np.repeat(a, many) * len(self.b.spelled) + b[at]
        written = np.concatenate([a + len(self.a.spelled) * closes_a, b + 2 * len(self.a.spelled) + len(self.b.spelled) * closes_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        signs = list(map(self._written.__getitem__, written[order].tolist()))
        cut_links = [0, *ends[cut_a - 1].tolist()]
        cut_signs = [0, *(cut_a + cut_b).tolist()]
        n_groups = np.diff(np.concatenate([[0], closes_a.cumsum()[cut_a - 1]])).tolist()
        return [
            Window("".join(signs[i:j]), n, links[k:m].copy())
            for i, j, n, k, m in zip(cut_signs[:-1], cut_signs[1:], n_groups, cut_links[:-1], cut_links[1:], strict=True)
        ]

    def _spell(self, raw: bytes, ids: tuple[np.ndarray, np.ndarray]) -> bool:
        return all(b"".join([x.spelled[n] for n in own.tolist()]) == raw for x, own in zip((self.a, self.b), ids, strict=True))

    def windows(self, a: np.ndarray, b: np.ndarray) -> list[bytes]:
        """The text's windows: the ids of the first tokenizer, then, marked, those of the second."""
        end_a, end_b = self._length[0][a].cumsum(), self._length[1][b].cumsum()
        at_b = np.searchsorted(end_b, end_a[:-1])
        anchors = np.flatnonzero((end_b[at_b] == end_a[:-1]) & self._spaced[0][a[1:]])
        after = at_b[anchors] + 1
        spaced = self._spaced[1][b[np.minimum(after, len(b) - 1)]]
        cut_a, cut_b = anchors[spaced] + 1, after[spaced]
        number = [np.zeros(len(x), np.int64) for x in (a, b)]
        for n, cut in zip(number, (cut_a, cut_b), strict=True):
            n[cut] = 2
        order = np.argsort(np.concatenate([number[0].cumsum(), number[1].cumsum() + 1]), kind="stable")
        packed = np.concatenate([a, b | np.uint32(OTHER)])[order].tobytes()
        ends = (4 * np.append(cut_a + cut_b, len(a) + len(b))).tolist()
        return [packed[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]

    def rows(self, texts: list[str | None]) -> list[Row]:
        texts = [t or "" for t in texts]
        if len(self.kept) >= MAX_KEPT:
            self.kept.clear()
        both = list(zip(self.a.encode(texts), self.b.encode(texts), strict=True)) if texts else []
        both = [ids if t and self._spell(b" " + t.encode(), ids) else None for t, ids in zip(texts, both, strict=True)]
        number: dict[bytes, int] = {}
        cut = [[number.setdefault(k, len(number)) for k in self.windows(*ids)] if ids else [] for ids in both]
        distinct = list(number)
        found = [self.kept.get(k) for k in distinct]
        new = [n for n, w in enumerate(found) if w is None]
        for n, w in zip(new, self.align([distinct[n] for n in new]) if new else [], strict=True):
            found[n] = w
            if len(distinct[n]) <= 4 * LONG:
                self.kept[distinct[n]] = w
        n_groups = np.array([w.n_groups for w in found], np.int64)
        links = np.concatenate([NOTHING.links, *[w.links for w in found]])
        many = np.array([len(w.links) for w in found], np.int64)
        starts = many.cumsum() - many
        groups = [w.groups for w in found]
        out = []
        for ids, own in zip(both, cut, strict=True):
            if not ids:
                out.append(NOTHING)
                continue
            of = np.array(own)
            size = many[of]
            at = np.repeat(starts[of] - (size.cumsum() - size), size) + np.arange(size.sum())
            out.append(Row(len(ids[0]), len(ids[1]), int(n_groups[of].sum()), "".join([groups[n] for n in own])[:-1], links[at]))
        return out


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str, pattern: str | None) -> Aligner:
    return Aligner(byte_level(path_a, pattern), pieces(path_b))


SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, pattern: str | None = None) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times``.

    ``groups`` lists the ids of each group, ``a1,a2|b1;a3|b2,b3`` (with ``digest`` its SHA-256);
    ``pairs`` are the distinct linked pairs, an id of the first tokenizer times the size of the
    second plus an id of that, in 32-bit integers; ``times`` says how often each is linked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b, pattern)
        if len(both.a.spelled) * len(both.b.spelled) > 1 << 32:
            raise ValueError("pairs of these tokenizers don't fit 32 bits")
        for part in slices(batches):
            rows, groups, pairs, times = [], [], [], []
            for r in both.rows(texts_of(part)):
                own, n = np.unique(r.links, return_counts=True)
                rows.append((r.n_a, r.n_b, r.n_groups, len(r.links)))
                groups.append(hashlib.sha256(r.groups.encode()).hexdigest() if digest and r.groups else r.groups)
                pairs.append(own.astype("<u4").tobytes())
                times.append(n.astype("<u4").tobytes())
            numbers = np.array(rows, np.int64).T
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(n) for n in numbers], pa.array(groups, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCHEMA}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- counts over the corpus ------------------------------------------------------------


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed ones, and how many each row has."""
    values = column.to_pylist()
    sizes = np.array([len(v) // 4 for v in values], np.int64)
    return np.frombuffer(b"".join(values), "<u4").astype(np.int64), sizes


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a task's rows each pair is linked."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

    held, size = [], 0
    for batch in batches:
        held.append(_numbers(batch.column("pairs"))[0])
        size += len(held[-1])
        if size >= PAIRS_AT_A_TIME:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """Per linked pair: ``pair, n, best``, its rows and whether its first id has no pair with more."""
    counts = rows.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "align-counts")
    first = F.floor(F.col("pair") / width)
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return materialise(counts.join(most, first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-best")


def _looked_up(shared, whole: bool):
    """Sums over the pairs found; with ``whole`` a pair that isn't found has a count of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best, one_best, width = shared.value
        for part in slices(batches):
            own, sizes = _numbers(part.column("pairs"))
            times = _numbers(part.column("times"))[0]
            row = np.repeat(np.arange(part.num_rows), sizes)
            at = np.minimum(np.searchsorted(pairs, own), max(0, len(pairs) - 1))
            found = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            count, top = (np.where(found, x[at] if len(pairs) else 0, 0) for x in (counts, best))
            if whole:
                count = np.where(found, count, 1)
                top = np.where(found, top, np.isin(own // width, one_best))
            n_best = np.bincount(row, times * top, part.num_rows).astype(np.int64)
            total = np.zeros(part.num_rows, np.int64)
            np.add.at(total, row, times * count)
            left = ~found & (not whole)
            cuts = np.cumsum(np.bincount(row, left, part.num_rows).astype(np.int64))[:-1]
            rest = [np.split(x[left], cuts) for x in (own, times)]
            kept = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in kept] + [pa.array(n_best), pa.array(total), *[pa.array([v.tolist() for v in r], pa.list_(pa.int64())) for r in rest]],
                names=[*kept, "n_best", "count_sum", "rare_pairs", "rare_times"],
            )

    return run


def _least(counts: DataFrame, most: int) -> int:
    """The smallest count above one such that at most ``most`` pairs have it or more."""
    sizes = counts.where("n > 1").groupBy(F.floor(F.log2("n")).cast("int").alias("bits")).agg(F.count(F.lit(1)).alias("pairs"))
    least, held = 1 << 62, 0
    for r in sorted(sizes.collect(), reverse=True):  # 64 rows at most
        held += r["pairs"]
        if held > most:
            break
        least = 1 << r["bits"]
    return max(2, least)


def align(
    docs: DataFrame, path_a: str, path_b: str, digest: bool = False, pattern: str | None = None, max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum``.

    A link's count is that of its id pair: in how many rows it is linked. ``n_best`` are the links
    whose count is the highest of all pairs of their first id, ``count_sum`` is the sum over the links.
    """
    spark = docs.sparkSession
    width = len(pieces(path_b).spelled)
    numbered = aligned(docs, path_a, path_b, digest, pattern).withColumn("rid", F.monotonically_increasing_id())
    rows = materialise(numbered, "align-rows")
    counts = pair_counts(rows, width)
    least = _least(counts, max_pairs)
    common = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    whole = least == 2
    one_best = []
    if whole:  # first ids whose pairs are all pairs of one row; bounded by the vocabulary
        one_best = counts.where("best AND n = 1").select(F.floor(F.col("pair") / width).alias("a")).distinct().toArrow()["a"].to_numpy()
    shared = spark.sparkContext.broadcast((
        common["pair"].to_numpy(), common["n"].to_numpy(), np.array(common["best"].to_pylist(), bool), np.array(one_best, np.int64), width))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"rid long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, "
              "n_best long, count_sum long, rare_pairs array<long>, rare_times array<long>")
    summed = rows.mapInArrow(_looked_up(shared, whole), schema)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    if whole:
        return summed.select(*columns)
    summed = materialise(summed, "align-summed")
    rare = summed.select("rid", F.inline(F.arrays_zip(F.col("rare_pairs").alias("pair"), F.col("rare_times").alias("times"))))
    met = rare.join(counts.where(F.col("n") < least), "pair").groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    return summed.join(met, "rid", "left").select(
        *columns[:-2], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
