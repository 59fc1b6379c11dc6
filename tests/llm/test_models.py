"""Segment search against brute force, held-out accuracy of both classifiers."""

import random
import zlib
from pathlib import Path

import pytest

from dockcast.llm import neighbours, queries, sample, toxicity

SF = "/root/testdata/sf0.01"


def slow_segments(scores):
    """Maximal segments by their definition: the best one, then those left and right of it."""
    best = None
    for a in range(len(scores)):
        total = 0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 0 and (best is None or (total, a - b) > (best[2], best[0] - best[1] + 1)):  # of equal ones the shortest
                best = (a, b + 1, total)
    if best is None:
        return []
    a, b, _ = best
    left, right = slow_segments(scores[:a]), slow_segments(scores[b:])
    return [*left, best, *[(x + b, y + b, s) for x, y, s in right]]


def test_segments_equal_definition():
    draw = random.Random(2)
    for _ in range(300):
        scores = [draw.choice([-1, -1, -1, 4, 7, -6]) for _ in range(draw.randint(0, 25))]
        hits = [(i, s) for i, s in enumerate(scores) if s != -1]
        got = toxicity.segments(hits, -1)
        assert [(s.start, s.end) for s in got] == [(a, b) for a, b, _ in slow_segments(scores)]


def test_scores_of_no_text_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (None, "", 1.0), (3, "x " * 3000, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    for module in (toxicity, neighbours):
        got = module.score(docs, module.fit(docs, labels)).collect()
        assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
        assert module.score(docs.limit(0), module.fit(docs, labels)).count() == 0


def test_quality_depends_on_words_of_equal_layout(spark):
    terms = neighbours.Terms()
    assert (terms.counts("buy cheap pills now") != terms.counts("the court held that")).any()
    assert (terms.counts("便宜药丸") != terms.counts("法院认为")).any()
    assert neighbours.shape("a-b-c-d-e-f") != neighbours.shape("a-b-c-d-g1-f")
    draw = random.Random(3)
    kinds = {0: "buy cheap pills now best price order today win cash".split(), 1: "the court held that law of the case was plain".split()}
    rows = [(i, " ".join(draw.choice(kinds[i % 2]) for _ in range(30))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in neighbours.score(docs, neighbours.fit(docs, labels)).collect()}
    assert all((got[i] > 0.5) == (i % 2 == 1) for i in range(300, 400))


def test_sample_has_one_row_for_each_chosen_id(spark):
    rows = [(1, f"text {n}") for n in range(50)] + [(1, None), (2, None), (2, None), (3, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 1, 2, 3)], "doc_id long, quality int")
    held = {i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5 == 0}
    found = sample.training_texts(docs, labels, "quality", 100).collect()
    got = {(r.text, r.label) for r in found}
    want = {1: ("text 0", 1), 2: (None, 0), 3: ("c", 1)}
    assert len(found) == 3 - len(held) and got == {want[i] for i in want if i not in held}


def test_harmless_words_are_shielded_whatever_their_spelling(spark):
    harmless = [f"grudge{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(f"grudge{n}x", 1) for n in range(300)] + [(f"plain text {harmless[n % 26]}" if n < 130 else "plain text", 0) for n in range(1300)]
    found = toxicity._lexicon(toxicity._counts(toxicity._folded(spark.createDataFrame(rows, "text string, label int"))))
    assert any(t.endswith("*") and v > 0 for t, v in found.items())
    assert all(found.get(w) == 0.0 for w in harmless)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize(("name", "label", "least"), [("op4_toxicity", "toxic", 0.93), ("op9_quality_classifier", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.registered()[name](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    tested = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(tested) > 50 and sum(a == b for a, b in tested) / len(tested) >= least


def auc(tested):
    yes, no = ([s for s, y in tested if y == v] for v in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in yes for b in no) / (len(yes) * len(no))


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize(("sf", "few"), [(SF, True), ("/root/testdata/sf0.1", False)])
@pytest.mark.parametrize(("name", "label", "least", "cut"), [("op4_toxicity", "toxic", 0.9, 0.5), ("op9_quality_classifier", "quality", 0.9, 0.3)])
def test_better_than_a_constant(spark, sf, few, name, label, least, cut):
    rows = queries.registered()[name](spark, sf).where("held_out").collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    tested = [(r.score, truth[r.doc_id]) for r in rows if r.doc_id in truth]
    right = sum((s >= cut) == y for s, y in tested)
    ones = sum(y for _, y in tested)
    assert right > max(ones, len(tested) - ones) and auc(tested) >= least - 0.1 * few  # six toxic documents held out at sf0.01


def test_texts_are_scored_by_lexicons_they_had_no_part_in(spark):
    """Each fold's lexicon is that of the other folds alone."""
    draw = random.Random(8)
    rows = [(" ".join([draw.choice(["vile", "nasty", "plain", "calm"]) if i % 2 else draw.choice(["plain", "calm", "kind"]) for _ in range(6)]) + f" x{i}", i % 2) for i in range(400)]
    sample = toxicity._folded(spark.createDataFrame(rows, "text string, label int"))
    counts = toxicity._counts(sample)
    assert {r.fold for r in sample.select("fold").distinct().collect()} == set(range(toxicity.FOLDS))
    for k in range(2):
        alone = toxicity._lexicon(toxicity._counts(sample.where(f"fold != {k}")))
        assert toxicity._lexicon(counts, k) == alone and alone["vile"] > 1


def test_evidence_and_curve_against_their_definition():
    """The law of the r best normalised scores by numeric integration, the curve by its gradient."""
    import math

    import numpy as np

    lam, log_k, m = 0.7, math.log(0.05), 400
    one = toxicity.evidence([toxicity.Segment(0, 3, 9.0)], m, lam, log_k)
    s = lam * 9.0 - math.log(m) - log_k
    assert one == pytest.approx(s - math.lgamma(2) - math.lgamma(1), abs=1.0) and one > 0
    assert toxicity.evidence([], m, lam, log_k) == 0 and toxicity.evidence([toxicity.Segment(0, 1, 0.1)], m, lam, log_k) == 0
    two = toxicity.evidence([toxicity.Segment(0, 3, 9.0), toxicity.Segment(5, 9, 9.0)], m, lam, log_k)
    assert two > one
    draw = np.random.default_rng(4)
    x = draw.normal(0, 2, 500)
    y = (draw.random(500) < 1 / (1 + np.exp(-(0.5 + 1.5 * x)))).astype(float)
    a, b = toxicity._logistic(x, y)
    p = 1 / (1 + np.exp(-(a + b * x)))
    assert abs((y - p).sum() - 1e-3 * a) < 1e-6 and abs(((y - p) * x).sum() - 1e-3 * b) < 1e-6 and b == pytest.approx(1.5, abs=0.4)
    rate = toxicity._rate(np.array([2.0] * 30 + [3.0] * 5), 5000, -0.1)
    n = 5000
    over = 30 * math.exp(2 * rate) + 5 * math.exp(3 * rate) + (n - 35) * math.exp(-0.1 * rate) - n
    assert abs(over) / n < 0.02


def test_votes_equal_plain_cosine_products():
    """Each text against each labelled one, one pair at a time; the axes against a full decomposition."""
    import math

    import numpy as np

    draw = np.random.default_rng(9)
    terms, words = neighbours.Terms(), [f"w{k}" for k in range(60)] + ["Big!!", "12%", "x-y"]
    shares = np.stack([terms.counts(" ".join(draw.choice(words, draw.integers(5, 60)))) for _ in range(130)])
    rarity = (np.log(101 / (1 + (shares[:100] > 0).sum(axis=0))) + 0.3).astype(np.float32)
    weighted = neighbours._weights(shares[:100], rarity)
    axes = neighbours._leading(weighted)
    exact = np.linalg.svd(weighted.astype(np.float64), compute_uv=True, full_matrices=False)
    held = np.linalg.norm(weighted @ axes, axis=0)
    assert np.allclose(held[:10], exact[1][:10], rtol=1e-3) and np.allclose(axes.T @ axes, np.eye(axes.shape[1]), atol=1e-3)
    vectors = neighbours._unit(weighted @ axes)
    labels = draw.integers(0, 2, 100).astype(float)
    model = neighbours.Model(rarity, axes, vectors, labels, float(labels.mean()))
    asked = np.concatenate([shares[100:], np.zeros((1, neighbours.TERMS), np.float32)])
    got = neighbours.vote(model, asked)
    for row, mine in zip(neighbours._weights(asked[:-1], rarity), got, strict=False):
        v = [float(sum(a * b for a, b in zip(row, axis, strict=True) if a)) for axis in axes.T]
        size = math.sqrt(sum(x * x for x in v))
        near = sorted(((sum(a * b for a, b in zip(v, u, strict=True)) / size, y) for u, y in zip(vectors.tolist(), labels, strict=True)), reverse=True)
        votes = [(max(c, 0.0) ** 8 + 1e-12, y) for c, y in near[: neighbours.NEAREST]]
        assert mine == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=2e-3)
    assert got[-1] == model.share
    same = model._replace(vectors=np.repeat(vectors[:1], 100, axis=0), labels=np.ones(100))
    assert np.allclose(neighbours.vote(same, asked[:-1]), 1.0)  # ties among equal neighbours
