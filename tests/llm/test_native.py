"""Quality ledger, mixing and personal data on small hand-made tables."""

import hashlib
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from dockcast.llm import mixing, pii, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, ledger string, size long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 7) for i, t, s in rows], DOCS)


TEXTS = [
    None,
    "",
    " \n\t ",
    "a b c d",
    "a b c d e f",
    "a b c d e f a b c d e f",
    "a b c d e " * 30,
    "a a a a a a a a a a a a",
    "one two three four five six seven eight nine ten",
    "one# two* three$ four five six seven eight nine ten",
    "x\nx\nx\ny z\n\n  \n" + "w v u t s r q p o n",
    "Straße über é 日本 語 " * 4,
    " ".join(f"w{i}" for i in range(20_000)) + " w1 w2 w3 w4 w5",
    "SHOUT " + " ".join(f"LOUD{i}X" for i in range(20)),
]


def slow_measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = {}
    for g in grams:
        times[g] = times.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    rows = docs(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality.with_ledger(rows, into="judged").select("doc_id", *[f"judged.{n}" for n in names]).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == {i: slow_measures(t) for i, t in enumerate(TEXTS)}


def test_policy_keeps_columns_and_rejects_by_bits(spark):
    rows = docs(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    kept = quality.apply_policy(rows, "base-1")
    assert kept.columns == rows.columns
    want = {i for i, t in enumerate(TEXTS) if (m := slow_measures(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]}
    assert {r.doc_id for r in kept.collect()} == want
    assert quality.apply_policy(rows.limit(0)).count() == 0


def test_ablations_equal_counting(spark):
    rows = quality.with_ledger(docs(spark, [(i, t, "s") for i, t in enumerate(TEXTS * 2)]), into="judged")
    bits = [r[0] for r in rows.select("judged.failed_bits").collect()]
    got = {(r.policy, r.rule): (r.kept, r.only_this_rule, r.fails) for r in quality.ablations(rows.select("judged.failed_bits")).collect()}
    for policy, names in quality.POLICIES.items():
        m = quality.mask(policy)
        for name in names:
            b = quality.BITS[name]
            assert got[policy, name] == (sum(x & m == 0 for x in bits), sum(x & m == b for x in bits), sum(x & b > 0 for x in bits))


def slow_mix(rows, weights=(5, 2, 1)):
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    budget, capped, target = 1.5 * sum(size.values()), set(), {}
    while True:
        free = [s for s in size if s not in capped]
        left = budget - sum(2 * size[s] for s in capped)
        target = {s: 2.0 * size[s] for s in capped} | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 2 * size[s]}
        if not over:
            return size, target
        capped |= over


@pytest.mark.parametrize("bins", [4, mixing.BINS])
def test_mix_meets_targets(spark, bins):
    rows = [(i, "w " * (i % 17), None if i % 11 == 0 else f"s{i % 7 if i % 3 else 0}") for i in range(600)]
    size, target = slow_mix(rows)
    got = mixing.mix(docs(spark, rows), bins=bins).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size) and r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 2 * 17 for s in size)
    assert sum(taken.values()) <= 1.5 * sum(size.values())
    again = mixing.mix(docs(spark, rows), bins=16).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_without_words_and_with_repeated_rows(spark):
    assert mixing.mix(docs(spark, []).limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs(spark, [(1, None, "a"), (None, " ", None)])).collect()] == [0, 0]
    rows = [(1, "a b c", "s")] * 5 + [(None, "d e f g", None)]
    table = docs(spark, rows)
    assert sum(r.taken for r in mixing.mix(table).collect()) == mixing.repeated(table).agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert mixing.repeated(table).columns == table.columns


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        total = sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d)))
        return 13 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def slow_spans(text):
    return [(k, m.start(), m.end()) for k in pii.BASE for m in re.finditer(PLAIN[k], text or "") if holds(k, m.group())]


PRIVATE = [
    None,
    "",
    "mail a.b@c.de, x@y and a@b.com_c@d.org é日 last@one.example",
    "1.2.3.4.5 256.1.1.1 001.002.003.004 9.9.9 10.0.0.255",
    "4111 1111 1111 1111 and 4111111111111112 5500-0000-0000-0004 41111111111111111111111",
    "+1 (523) 555-1055 +49 30 1234 +1 +12345678901234567 ++1 234 567 8901",
    "1 2 3 4 5 6 7 8 " * 3000,
    "a" * 30_000 + "@" + "b" * 1000,
    "7" * 30_000 + ".1.1.1",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end',
    'api key: "11acdfb36bb72224148e6160f674b4be45601bff"',
    "page 123456789 donaudampfschifffahrtsgesellschaft",
    *[f'token = "{hashlib.sha1(str(n).encode()).hexdigest()}" end' for n in range(20)],
    *[f"page {n}1234567 or dampfschifffahrtsgesellschaft{'x' * n}" for n in range(20)],
]


def test_base_spans_equal_plain_patterns(spark):
    got = {r.doc_id: r for r in pii.spans(docs(spark, [(i, t, "s") for i, t in enumerate(PRIVATE)])).collect()}
    for i, text in enumerate(PRIVATE):
        want = slow_spans(text)
        assert [tuple(s) for s in got[i].base] == want
        added = [tuple(s) for s in got[i].added]
        assert all(k in pii.ADDED and not any(a < e and s < b for _, a, b in want) for k, s, e in added)
    assert [PRIVATE[9][s:e] for _, s, e in got[9].added] == ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff"]
    assert got[11].added == [] and got[0].base == []
    assert pii.spans(docs(spark, []).limit(0)).count() == 0


LOOSE = {
    "SSN: 123-45-6789": "123-45-6789",
    "call 312-555-0142": "312-555-0142",
    "call 312 555 0142 now": "312 555 0142",
    "phone 555-0142": "555-0142",
    "IBAN DE89 3704 0044 0532 0130 00": "DE89 3704 0044 0532 0130 00",
    "BE68 5390 0754 7034 THE": "BE68 5390 0754 7034",
    "passport A1234567": "A1234567",
    "password: hunter2pass": "hunter2pass",
    "password = swordfish.": "swordfish",
    "mail bob@corp.": "bob@corp",
    "mail: bob@corp": "bob@corp",
    "contact us on the page": None,
    "mail a.b@c.de": None,
    "12 34 x 5-6": None,
}


def test_spans_after_words_and_in_groups_are_candidates(spark):
    texts = list(LOOSE)
    found = {r.doc_id: r.judged for r in pii.candidates(docs(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    got = {t: [t[c.start:c.end] for c in found[i]] for i, t in enumerate(texts)}
    assert got == {t: [hit] if hit else [] for t, hit in LOOSE.items()}


CLASHING = [
    "password: hunter20pass then mail: bob20@corp. and key=12345678901234567890123 and key=0x12ab34cd56ef78ab90cd12",
    "tel 312-555-0142, 312-555-0143; iban DE89 3704 0044 0532 0130 00 card 4111 1111 1111 1111 token: 4111-1111",
    "mail a.b@c.de pass=a.b@c.de secret = xyz@corp contact: +49 30 1234567 é日 phone é 5550142",
    "api " + " ".join(f"{n:02d}-{n * 7 % 90 + 10}-{n * 3 % 900 + 100}" for n in range(700)),
    " ".join(f"token={hashlib.sha1(str(n).encode()).hexdigest()[:n % 9 + 18]} x{n}@y" for n in range(600)),
]


def slow_candidates(text):
    """Matches of each kind in turn, without those that touch a span already taken."""
    taken = slow_spans(text)
    for kind in [*pii.ADDED, "after"]:
        own = [(m.start(), m.end()) for m in regex.finditer(pii.PATTERNS[kind], text)] if regex.search(pii.HINTS[kind], text) else []
        free = [(s, e) for s, e in own if not any(a < e and s < b for _, a, b in taken)]
        name = lambda s, e: kind if kind != "after" else "secret" if re.search("[A-Za-z]", text[s:e]) else "number"  # noqa: E731, B023
        taken = [*taken, *[(name(s, e), s, e) for s, e in free]]
    return sorted(taken[len(slow_spans(text)) :], key=lambda c: (pii.ADDED.index(c[0]), c[1]))


def test_candidates_equal_brute_force_in_order_and_once(spark):
    texts = [t for t in (*PRIVATE[2:7], *PRIVATE[9:12], *LOOSE, *CLASHING)]
    got = {r.doc_id: r.judged for r in pii.candidates(docs(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        assert [(c.kind, c.start, c.end) for c in got[i]] == slow_candidates(text), text[:80]
        assert len({(c.start, c.end) for c in got[i]}) == len(got[i])


def test_listed_spans_are_ordered_by_kind_and_start(spark):
    rows = [f"password: hunter{n}pass then mail: bob{n}@corp. and key={n}2345678901234567890 secret: swordfish{n}" for n in range(10, 40)]
    kinds = [*pii.BASE, *pii.ADDED]
    found = 0
    for r in pii.spans(docs(spark, [(i, t, "s") for i, t in enumerate(rows)])).collect():
        listed = [(kinds.index(s.kind), s.start, s.end) for s in (*r.base, *r.added)]
        assert listed == sorted(listed) and len({s[1:] for s in listed}) == len(listed)
        found += len({s[0] for s in listed}) > 1
    assert found == len(rows)


def test_places_in_a_text_of_many_groups_take_linear_time(spark):
    took = []
    for n in (8_000, 64_000):
        table = docs(spark, [(1, "12 345 " * (n // 2), "s")])
        start = time.perf_counter()
        assert len(pii.candidates(table).first().judged) <= 1  # groups of eight at most are a number
        took.append(time.perf_counter() - start)
    assert took[1] < 12  # the square of 8 would be 64 times the first


def test_short_tokens_after_words_are_added(spark):
    rows = [f"password: hunter{n}pass" for n in range(20)] + [f"SSN: 123-45-67{n}" for n in range(10, 30)]
    rows += [f"page {n}1234567 or dampfschifffahrtsgesellschaft{'x' * n}" for n in range(40)]
    got = {r.doc_id: r.added for r in pii.spans(docs(spark, [(i, t, "s") for i, t in enumerate(rows)])).collect()}
    assert all([rows[i][s:e] for _, s, e in got[i]] == [rows[i].split(": ")[1]] for i in range(40))
    assert all(got[i] == [] for i in range(40, 80))


def test_reliabilities_separate_agreeing_votes():
    code = lambda *votes: sum((v + 1) * 3**k for k, v in enumerate(votes))
    share, rates, real = pii.reliabilities({code(1, 1, 1, 0, 1): 40, code(0, 1, 1, 0, 1): 10, code(0, -1, 0, -1, 0): 50, code(0, 0, 0, 0, 0): 100})
    assert real[code(1, 1, 1, 0, 1)] > 0.99 > 0.5 > real[code(0, 0, 0, 0, 0)] and 0.2 < share < 0.3
    assert rates[1][1][0] > rates[1][1][1]


def test_joined_spans(spark):
    row = pii.spans(docs(spark, [(1, "a@b.co 10.0.0.1", "s")])).select(F.sha2(pii.joined(F.col("base")), 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"email:0:6,ip:7:15").hexdigest()
