"""Quality by votes of the nearest labelled texts in a latent-semantic space.

A text's terms are its words (lower case, without signs around them) and what the words look
like: the shape of each word (runs of upper and lower case, digits and every other character),
pairs of neighbouring shapes, and marks for words that stutter, for words inside repeated
windows and for repeated lines. Long words and words of scripts without blanks count as the
character trigrams they hold. Words are hashed into ``WORDS`` slots, the rest into ``SHAPES``. Both
kinds are weighted by the share of a text they take, dampened, and by how few texts hold them, and
stand side by side, each kind as a vector of length one. The leading singular vectors of a bounded labelled
sample span the latent space. The sample's vectors are broadcast (at most ``SAMPLE_ROWS`` of
``DIMS`` numbers), and every text is held against all of them by blocked cosine products. The
``NEAREST`` vote, each with its similarity's weight.

Null and empty texts have no terms; their score is the share of good labels, as is every score
if there are no labels (then 0). Repeated rows get equal results; other input columns don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dockcast.llm.common import slices, texts_of
from dockcast.llm.sample import training_texts

SAMPLE_ROWS = 4000
WORDS = 8192
SHAPES = 1024
TERMS = SHAPES + WORDS
DIMS = 64
SPARE = 16  # further directions while the leading ones are sought
STEPS = 8
LONG = 16  # characters of a word that is more than one term
GRAM = 3
NEAREST = 25
WINDOW = 5
MEMO = 300_000
_SIGNS = re.compile(r"^[\W_]+|[\W_]+$")
_MARKS = 8  # slots of their own, before the hashed ones


class Model(NamedTuple):
    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float


def shape(word: str) -> str:
    """Runs of character classes, each run one character."""
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _is_long(word: str) -> bool:
    return len(word) > LONG or max(word) >= "\u0e00"  # from there on scripts without blanks


class Terms:
    """Counts of hashed terms; the codes of words met lately are kept."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def _code(self, word: str) -> int:
        """Shape, and above it one more than the word's slot; 0 there if the word is long."""
        if len(self.known) > MEMO:
            self.known.clear()
        slot = 0 if _is_long(word) else 1 + _word_slot(word)
        code = zlib.crc32(shape(word).encode()) | slot << 32
        if len(word) <= 4 * LONG:
            self.known[word] = code
        return code

    def _words(self, words: list[str], slots: np.ndarray) -> np.ndarray:
        out = np.bincount(slots[slots > 0] - 1, minlength=WORDS).astype(np.float32)
        for i in np.flatnonzero(slots == 0):
            word = words[i].lower()
            grams = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
            n = max(1, len(grams) - GRAM + 1)
            code = np.zeros(n, np.uint64)
            for k in range(min(GRAM, len(grams))):
                code = code * np.uint64(0x9E3779B1) + grams[k : k + n] + np.uint64(1)
            found = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(WORDS)
            out += np.bincount(found.astype(np.int64), minlength=WORDS)
        return out

    def counts(self, text: str) -> np.ndarray:
        out = np.zeros(TERMS, np.float32)
        words = text.split()
        n = len(words)
        if not n:
            return out
        known, code = self.known, self._code
        codes = np.fromiter((known[w] if w in known else code(w) for w in words), np.uint64, n)
        shapes = codes & np.uint64(0xFFFFFFFF)
        pairs = shapes[:-1] * np.uint64(31) + shapes[1:]
        room = np.uint64(SHAPES - _MARKS)
        slots = np.concatenate([shapes % room, (pairs * np.uint64(0x9E3779B1) >> np.uint64(7)) % room]).astype(np.int64) + _MARKS
        out[:SHAPES] += np.bincount(slots, minlength=SHAPES)
        same = np.fromiter(map(hash, words), np.int64, n)
        out[0] = (same[1:] == same[:-1]).sum()
        if n > WINDOW:
            grams = sum(same[k : n - WINDOW + 1 + k] * (2 * k + 3) ** 9 for k in range(WINDOW))
            _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
            out[1] = (times[which] > 1).sum()
        lines = [line for line in text.split("\n") if line.strip()]
        out[2] = (len(lines) - len(set(lines))) * n / max(1, len(lines))
        found = self._words(words, (codes >> np.uint64(32)).astype(np.int64))
        out[SHAPES:] = found * (n / max(1.0, float(found.sum())))
        return out / n


def _word_slot(word: str) -> int:
    plain = _SIGNS.sub("", word.lower()) or word
    return zlib.crc32(plain.encode()) % WORDS


def _weights(shares: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    weighted = np.sqrt(shares) * rarity
    return np.concatenate([_unit(weighted[:, :SHAPES]), _unit(weighted[:, SHAPES:])], axis=1)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=-1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def _leading(rows: np.ndarray) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    width = min(DIMS + SPARE, *rows.shape)
    basis = np.random.default_rng(7).standard_normal((rows.shape[0], width)).astype(np.float32)
    for _ in range(STEPS):
        side, _ = np.linalg.qr(rows.T @ basis)
        basis, _ = np.linalg.qr(rows @ side)
    _, _, axes = np.linalg.svd(basis.T @ rows, full_matrices=False)
    return np.ascontiguousarray(axes[:DIMS].T)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms = Terms()
    for part in slices(batches):
        rows = [terms.counts(t) for t in texts_of(part)]
        held = [np.flatnonzero(r) for r in rows]
        slots = pa.array([h.astype(np.uint16).tobytes() for h in held], pa.binary())
        shares = pa.array([r[h].tobytes() for r, h in zip(rows, held, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([slots, shares, part.column("label")], names=["slots", "shares", "label"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    sample = training_texts(docs, labels, "quality", rows).mapInArrow(_sampled, "slots binary, shares binary, label int")
    got = sorted((bytes(r["slots"]), bytes(r["shares"]), r["label"]) for r in sample.collect())  # bounded by ``rows``
    if not got:
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.0)
    shares = np.zeros((len(got), TERMS), np.float32)
    for row, (slots, values, _) in zip(shares, got, strict=True):
        row[np.frombuffer(slots, np.uint16)] = np.frombuffer(values, np.float32)
    y = np.array([float(label) for _, _, label in got])
    del got
    rarity = np.log((1 + len(shares)) / (1 + (shares > 0).sum(axis=0))).astype(np.float32) + np.float32(0.3)
    for start in range(0, len(shares), 256):
        shares[start : start + 256] = _weights(shares[start : start + 256], rarity)
    axes = _leading(shares)
    return Model(rarity, axes, _unit(shares @ axes), y, float(y.mean()))


def vote(model: Model, shares: np.ndarray) -> np.ndarray:
    """Scores of texts given by their term shares."""
    out = np.full(len(shares), model.share)
    rows = _unit(_weights(shares, model.rarity) @ model.axes)
    real = np.flatnonzero(np.abs(rows).sum(axis=1) > 0)
    if not len(model.vectors) or not len(real):
        return out
    near = rows[real] @ model.vectors.T
    k = min(NEAREST, near.shape[1])
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, best, axis=1), 0.0).astype(np.float64) ** 8 + 1e-12
    out[real] = np.clip((weight * model.labels[best]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, terms = shared.value, Terms()
        for part in slices(batches):
            shares = np.stack([terms.counts(t) for t in texts_of(part)]) if part.num_rows else np.zeros((0, TERMS), np.float32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(vote(m, shares))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
