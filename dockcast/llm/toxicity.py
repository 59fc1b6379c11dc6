"""Toxic passages as maximum-scoring segments of token log-odds.

Fit, on a bounded sample of labelled texts: for every word and every short begin of a word the
numbers of toxic and of other texts that hold it give a log-odds with an informative Dirichlet
prior (the pooled frequencies times ``PRIOR``, and ``FLOOR``). All terms whose log-odds is significant
make the lexicon. A word's score is that of its most specific term with enough support; every
other word costs a small drift, so that a random text's score sinks.

Score: one pass over a text's words keeps all disjoint maximal segments of positive score. For
random text the best score of m words follows an extreme-value law, P(S >= s) = 1 -
exp(-K m exp(-lambda s)); lambda solves sum p(x) exp(lambda x) = 1 for the scores of non-toxic
texts, and K is fitted to their best scores. The segments' normalised scores are combined by
the law of their sum, and a logistic curve turns the result into a probability.

The law and the curve are fitted on scores that a text got from lexicons it had no part in: the
sample is cut into ``FOLDS`` by a hash of the text, and each fold is scored by the lexicon of the
others. In the lexicon's own texts the evidence would be far stronger than in new ones.

Null and empty texts have no words and get the curve's value for no evidence, like any text
without a passage. Without labels of both classes every score is the share of toxic labels (0
without labels). Repeated rows get equal results; other input columns don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import slices, texts_of
from dockcast.llm.sample import training_texts

SAMPLE_ROWS = 20_000
FOLDS = 5
SUPPORT = 5
SIGNIFICANT = 3.2
LEAST_ODDS = 1.0
PRIOR = 1000.0
FLOOR = 0.5
BEGINS = (6, 5, 4)
REACH = 60
MEMO = 300_000
_WORD = re.compile(r"[^\W_]+")


class Model(NamedTuple):
    odds: dict[str, float]  # terms that decide; 0 for those that aren't significant
    drift: float
    rate: float  # lambda
    log_k: float
    curve: tuple[float, float]


class Segment(NamedTuple):
    start: int
    end: int
    score: float


def _terms(word: str) -> list[str]:
    """A word's terms, the most specific first. Begins carry a mark that no word holds."""
    return [word, *[f"{word[:k]}*" for k in BEGINS if len(word) >= k]]


def segments(hits: list[tuple[int, float]], drift: float) -> list[Segment]:
    """All maximal segments, left to right, from the places and scores of the words that count.

    ``drift`` (negative) is the score of each other word. Linear: every hit is stacked and taken
    off the stack once. A candidate holds the sums before and after it.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, earlier with a smaller sum
    total, at = 0.0, 0
    for place, score in hits:
        total += drift * (place - at)
        start, before = place, total
        total += score
        at = place + 1
        if score <= 0:
            continue
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                stack.append((start, place + 1, before, total, j))
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [Segment(s, e, after - before) for s, e, before, after, _ in stack]


class Scorer:
    def __init__(self, odds: dict[str, float], drift: float):
        self.odds, self.drift, self.known = odds, drift, {}

    def _score(self, word: str) -> float:
        if len(self.known) > MEMO:
            self.known.clear()
        found = next((self.odds[t] for t in _terms(word) if t in self.odds), 0.0)
        self.known[word] = found
        return found

    def hits(self, text: str) -> tuple[int, list[tuple[int, float]]]:
        words = _WORD.findall(text.lower())
        known, score = self.known, self._score
        return len(words), [(i, s) for i, w in enumerate(words) if (s := known[w] if w in known else score(w))]


def evidence(found: list[Segment], n_words: int, rate: float, log_k: float) -> float:
    """-log of the smallest probability that random text has r segments of this total score, over r."""
    best, total = 0.0, 0.0
    for r, score in enumerate(sorted((s.score for s in found), reverse=True), 1):
        total += rate * score - (log_k + math.log(n_words))
        if total <= 0:
            break
        log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
        best = max(best, -log_p)
    return best


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per term, fold and class, of this task's texts. The sample is bounded, and so is this."""
    toxic: Counter[tuple[str, int]] = Counter()
    other: Counter[tuple[str, int]] = Counter()
    for part in slices(batches):
        for text, label, fold in zip(texts_of(part), part.column("label").to_pylist(), part.column("fold").to_pylist(), strict=True):
            words = set(_WORD.findall(text.lower()))
            (toxic if label else other).update({(t, fold) for w in words for t in _terms(w)})
    terms = list(toxic.keys() | other.keys())
    for start in range(0, len(terms), 50_000):
        some = terms[start : start + 50_000]
        names, folds = zip(*some, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(folds, pa.int32()), *[pa.array([n[t] for t in some], pa.int64()) for n in (toxic, other)]],
            names=["term", "fold", "y1", "y0"],
        )


def _folded(sample: DataFrame) -> DataFrame:
    """The sample with the fold of each text; equal texts are in one fold."""
    return sample.withColumn("fold", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int"))


def _counts(sample: DataFrame) -> DataFrame:
    """Per term: texts of each class, ``y1, y0``, and those of each fold."""
    counts = sample.mapInArrow(_count_terms, "term string, fold int, y1 long, y0 long")
    of_fold = lambda c, k: F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}_{k}")
    folds = [of_fold(c, k) for k in range(FOLDS) for c in ("y1", "y0")]
    return counts.groupBy("term").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"), *folds).where(F.col("y1") + F.col("y0") >= SUPPORT)


def _lexicon(counts: DataFrame, without: int | None = None) -> dict[str, float]:
    """Log-odds of the terms that decide, from all folds or all but one. The bounded sample bounds their number."""
    if without is not None:
        counts = counts.select("term", *[(F.col(c) - F.col(f"{c}_{without}")).alias(c) for c in ("y1", "y0")]).where(F.col("y1") + F.col("y0") >= SUPPORT)
    counts = counts.select("term", "y1", "y0").persist()
    try:
        n1, n0 = counts.agg(F.sum("y1"), F.sum("y0")).first()
        if not n1 or not n0:
            return {}
        prior = F.lit(FLOOR) + F.lit(PRIOR) * (F.col("y1") + F.col("y0")) / float(n1 + n0)
        side = lambda y, n: F.log((F.col(y) + prior) / (n + PRIOR - F.col(y) - prior))
        odds = side("y1", n1) - side("y0", n0)
        spread = F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
        scored = counts.select("term", odds.alias("odds"), (odds / spread).alias("z"))
        strong = (F.col("z") >= SIGNIFICANT) & (F.col("odds") >= LEAST_ODDS)
        chosen = scored.where(strong)
        lexicon = {r["term"]: r["odds"] for r in chosen.collect()}
        begins = [t for t in lexicon if t.endswith("*")]
        if begins:  # more specific terms that aren't significant stand against a begin that is
            begin = F.explode(F.array(*[F.concat(F.rtrim(F.substring("term", 1, k)), F.lit("*")) for k in BEGINS]))
            against = scored.where(~strong).withColumn("begin", begin)
            held = against.join(chosen.select(F.col("term").alias("begin")), "begin", "left_semi").select("term").distinct()
            lexicon |= {r["term"]: 0.0 for r in held.collect() if r["term"] not in lexicon}
        return lexicon
    finally:
        counts.unpersist()


def _drift(odds: dict[str, float]) -> float:
    positive = [v for v in odds.values() if v > 0]
    return -(sum(positive) / len(positive) if positive else 1.0) / REACH


def _measured(sample: DataFrame, lexicons: list[dict[str, float]]) -> list:
    """Scores of each sample text by the lexicon that its fold had no part in."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicons)  # terms of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drifts = [_drift(odds) for odds in shared.value]
        scorers = [Scorer(odds, drift) for odds, drift in zip(shared.value, drifts, strict=True)]
        for part in slices(batches):
            out = []
            for text, label, fold in zip(texts_of(part), part.column("label").to_pylist(), part.column("fold").to_pylist(), strict=True):
                n, hits = scorers[fold].hits(text)
                out.append({"label": label, "n": n, "hits": [s for _, s in hits], "scores": [s.score for s in segments(hits, drifts[fold])]})
            yield pa.RecordBatch.from_pylist(
                out, schema=pa.schema([("label", pa.int32()), ("n", pa.int64()), ("hits", pa.list_(pa.float64())), ("scores", pa.list_(pa.float64()))])
            )

    return sample.mapInArrow(run, "label int, n long, hits array<double>, scores array<double>").collect()


def _rate(scores: np.ndarray, words: int, drift: float) -> float:
    """lambda > 0 with sum p(x) exp(lambda x) = 1 over the words of non-toxic texts."""
    values, counts = np.unique(np.round(scores, 3), return_counts=True)
    counts = counts + 1.0 / max(1, len(values))
    rest = max(1.0, words - counts.sum())

    def over(x: float) -> float:
        return (counts * np.exp(x * values)).sum() + rest * math.exp(x * drift) - counts.sum() - rest

    if not len(values):
        return 1.0
    low, high = 1e-6, 50.0 / float(values.max())
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) > 0 else (middle, high)
    return max(low, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for a curve in one variable, slightly held back."""
    a, b = math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([(y - p).sum() - 1e-3 * a, ((y - p) * x).sum() - 1e-3 * b])
        h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step /= max(1.0, float(np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    sample = _folded(training_texts(docs, labels, "toxic", rows)).persist()
    counts = _counts(sample).persist()
    try:
        odds = _lexicon(counts)
        positive = any(v > 0 for v in odds.values())
        drift = _drift(odds)
        measured = _measured(sample, [_lexicon(counts, k) for k in range(FOLDS)])
    finally:
        counts.unpersist()
        sample.unpersist()
    y = np.array([float(r["label"]) for r in measured])
    if not len(y) or not positive or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model({}, drift, 1.0, 0.0, (math.log((share + 1e-9) / (1 - share + 1e-9)), 0.0))
    clean = [r for r in measured if not r["label"]]
    rate = _rate(np.array([s for r in clean for s in r["hits"]]), sum(r["n"] for r in clean), drift)
    # The share of non-toxic texts without a segment above s is exp(-K sum(m) / texts exp(-lambda s)), taken at s = 0.
    held = sum(bool(r["scores"]) for r in clean) + 0.5
    log_k = math.log(-math.log(1 - min(0.99, held / (len(clean) + 1))) / (sum(r["n"] for r in clean) / len(clean) + 1))
    x = np.array([evidence([Segment(0, 0, s) for s in r["scores"]], max(1, r["n"]), rate, log_k) for r in measured])
    return Model(odds, drift, rate, log_k, _logistic(np.log1p(x), y))


def probability(model: Model, found: list[Segment], n_words: int) -> float:
    a, b = model.curve
    x = evidence(found, max(1, n_words), model.rate, model.log_k)
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, a + b * math.log1p(x)))))


PASSAGES = "array<struct<start:int,end:int,score:double>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, score, passages`` (word numbers, end exclusive, of the significant ones)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # terms of the bounded sample with SUPPORT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m.odds, m.drift)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for part in slices(batches):
            scores, passages = [], []
            for text in texts_of(part):
                n, hits = scorer.hits(text)
                found = segments(hits, m.drift)
                scores.append(probability(m, found, n))
                passages.append([s._asdict() for s in found if evidence([s], max(1, n), m.rate, m.log_k) > 0])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array(passages, kind)], names=["doc_id", "score", "passages"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, passages {PASSAGES}")
