"""Byte-level BPE as a tree reduction: halves are encoded on their own and joined.

``encode`` halves a text until the parts are short, encodes those, and joins neighbours up the
tree. A join encodes a window around the seam again and keeps the tokens outside it. The window
grows until both its ends are safe cuts. A safe cut is a space between two characters that are
no blanks, seen whole inside one half: the pattern never matches across it, because a match
holds a space only as its first character or among blanks, and a run of blanks that ends
before it is followed by the same characters in the half and in the whole. So the halves'
tokens beyond a safe cut are the tokens of the whole. Without a safe cut the window grows to
the whole half, which is then encoded again. ``decode`` halves the ids and joins the bytes.

Only the leaves call the encoder of the installed library. A text is a row of its own and is
encoded inside one task; memory is that of a short run of rows.

A null text is an empty one: no tokens, no bytes. Repeated rows get equal results. Columns of
the input beyond ``doc_id`` and ``text`` don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from dockcast.llm.common import slices, texts_of

LEAF_CHARS = 4096
LEAF_IDS = 2048
REACH = 64
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF_CHARS):
        self._library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.leaf = max(2, leaf)

    def _encode(self, text: str) -> np.ndarray:
        return self._library.encode_to_numpy(text, disallowed_special=())

    def encode(self, text: str) -> np.ndarray:
        return self._tree(text, 0, len(text))

    def _tree(self, text: str, start: int, end: int) -> np.ndarray:
        if end - start <= self.leaf:
            return self._encode(text[start:end])
        seam = (start + end) // 2
        return self._join(text, start, self._tree(text, start, seam), seam, self._tree(text, seam, end), end)

    def _join(self, text: str, start: int, left: np.ndarray, seam: int, right: np.ndarray, end: int) -> np.ndarray:
        a, b = _cut_before(text, start, seam), _cut_after(text, seam, end)
        inside_left, inside_right = len(self._encode(text[a:seam])), len(self._encode(text[seam:b]))
        window = self._encode(text[a:b])
        return np.concatenate([left[: len(left) - inside_left], window, right[inside_right:]])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_IDS:
            return self._library.decode_bytes(ids.tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _cut_before(text: str, start: int, seam: int) -> int:
    """The last safe cut of the left half, found in windows that double; its start if none."""
    reach = REACH
    while True:
        low = max(start, seam - reach)
        cuts = [m.start() for m in _SAFE.finditer(text, low, seam) if m.start() > start]
        if cuts:
            return cuts[-1]
        if low == start:
            return start
        reach *= 2


def _cut_after(text: str, seam: int, end: int) -> int:
    """The first safe cut of the right half; its end if none."""
    reach = REACH
    while True:
        high = min(end, seam + reach)
        found = _SAFE.search(text, seam + 1, high)
        if found:
            return found.start()
        if high == end:
            return end
        reach *= 2


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and rank file."""
    return Codec(read_ranks(path), pattern)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: id, number of tokens, and digests of the ids and of the bytes decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for part in slices(batches):
            n, ids_sha, decoded_sha = [], [], []
            for text in texts_of(part):
                ids = c.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.astype("<u4", copy=False).tobytes()).hexdigest())
                decoded_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: id, source, number of tokens, ids as little-endian unsigned 32-bit integers, and
    whether the bytes decoded from them are the text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for part in slices(batches):
            n, packed, same = [], [], []
            for text in texts_of(part):
                ids = c.encode(text)
                n.append(len(ids))
                packed.append(ids.astype("<u4", copy=False).tobytes())
                same.append(c.decode(ids) == text.encode())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("source"), pa.array(n, pa.int64()), pa.array(packed, pa.binary()), pa.array(same, pa.bool_())],
                names=["doc_id", "source", "n_tokens", "token_ids", "round_trip"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, n_tokens long, token_ids binary, round_trip boolean"
    return docs.select("doc_id", "source", "text").mapInArrow(run, schema)
