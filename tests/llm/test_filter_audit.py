"""The audit against filters applied one after the other."""

import itertools
import random
import re

import pytest

from dockcast.llm import filter_audit as fa


def brute(rows, labels):
    fails = []
    for i, text, _ in rows:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({
            "A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        })
    good, toxic = ({i for i, *l in labels if i is not None and l[k] == 1} for k in (0, 1))
    out, lost = [], {}
    for part in {r[2] or "" for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [k for k, r in enumerate(rows) if (r[2] or "") == part]
            gone = []
            for step, f in enumerate(order, 1):
                out_now = [k for k in left if fails[k][f]]
                redundant = sum(fails[k][f] for k in gone)
                left = [k for k in left if not fails[k][f]]
                gone += out_now
                lost[part, f] = lost.get((part, f), 0) + len(out_now)
                unique = sum(fails[k][f] and sum(fails[k].values()) == 1 for k, r in enumerate(rows) if (r[2] or "") == part)
                ids = [rows[k][0] for k in out_now]
                out.append([part, "".join(order), step, len(left), len(out_now), redundant, unique, sum(i in good for i in ids), sum(i in toxic for i in ids)])
    return sorted((*r, lost[r[0], r[1][r[2] - 1]]) for r in out)


def table(n):
    draw = random.Random(5)
    rows = []
    for i in range(n):
        words = [draw.choice(["w%d" % draw.randint(0, 400), "UP", "low", "x#y"] if draw.random() < 0.1 else ["w%d" % draw.randint(0, 400)]) for _ in range(draw.choice([5, 99, 100, 160]))]
        rows.append((i, " ".join(words), draw.choice(["en", "de", None, ""])))
        if draw.random() < 0.4:
            rows.append((draw.choice([n + i, max(0, i - 3)]), rows[draw.randrange(len(rows))][1], draw.choice(["en", "fr"])))
    rows += [(4, "same", "en")] * 30 + [(5000 + k, "same", "en") for k in range(40)] + [(None, "same", "en"), (None, None, "en")]
    return rows + [(6000, None, "de"), (6001, "", "de"), (6002, "  \n", None), (6003, "Long " * 5000, "en")]


@pytest.mark.parametrize("most", [fa.MAX_BLOCKS, 1])
def test_audit_equals_filters_in_turn(spark, monkeypatch, most):
    monkeypatch.setattr(fa, "MAX_BLOCKS", most)
    rows = table(120)
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 130, 2)] + [(2, 0, None), (None, 1, 1), (5001, None, 1), (99999, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, lang string, mask int, part string").repartition(6)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.audit(docs, known)
    assert sorted(map(tuple, got.collect())) == brute(rows, labels)
    assert fa.audit(docs.limit(0), known).count() == 0


def test_sketch_clears_only_unique_texts(spark):
    """No false clearance however full the sketch is, and few false alarms where it has room."""
    docs = spark.createDataFrame([(i, f"text {i if i % 10 else i // 100}") for i in range(20_000)], "doc_id long, text string").repartition(7)
    hashed = docs.selectExpr("*", "xxhash64(text) AS h")
    again = {r.text for r in hashed.groupBy("text").count().where("count > 1").collect()}
    for rows, alarms in ((20_000, 0.06), (10, 1.0)):
        marks, blocks = fa.repeat_marks(hashed, rows)
        found = hashed.withColumn("block", fa._block(blocks)).join(marks, "block").where(fa._may_repeat(blocks))
        texts = {r.text for r in found.collect()}
        assert again <= texts and len(texts - again) <= alarms * 20_000
