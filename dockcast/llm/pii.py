"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, and a
classifier trained on the result decides about the spans no fixed rule covers.

Base spans come from one pattern and one check per kind and always stay. Candidates are looser
spans that touch no base span: long tokens, runs and groups of digits, account numbers in groups,
addresses without a dot, and what stands right after a word of the first gazetteer: groups of
digits, tokens with a digit, and any token after an assignment sign. A stretch has one kind: of
candidates that touch, that of the kind named first stays, and one after a word is left to
the others. What counts as a number is part of the method: 2 to 8 groups of digits joined by one
sign (2 to 10 after a word of the gazetteer), 3 to 9 groups of an account number. Five
labelers vote yes, no or nothing on each: strict forms, what the span consists of, a gazetteer
of words that stand before personal data, a gazetteer of words that stand before harmless
numbers, and the signs between that word and the span (assignment, colon). Votes are counted
per pattern of votes (at most 3 ** 5). Expectation-maximisation on those counts estimates how
often each labeler votes what for real and for other candidates. The span classifier is a
naive Bayes over hashed features (the word before, what the span consists of, its length)
whose counts are weighted by the candidates' probabilities. A candidate of which it is sure, and
of which the votes think likewise, is added under its kind's name, ``secret``, ``number`` or
``address``.

All of it is column expressions, linear in a text: places come from running sums that are kept in lists
of short arrays, and overlaps from one pass over sorted spans in either direction. A text is searched inside its own row; what is shuffled are
counts with a partial step before. Repetitions in the patterns are possessive, and a match may
only begin where a run begins (or where the last match ended); both leave the matches as they
are and keep the search linear in long runs.

Null text is empty. Repeated rows have equal results. Other input columns don't matter; an
empty table gives an empty result. Without candidates nothing is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import bind
from dockcast.session import materialise

BASE = ["email", "ip", "card", "phone"]
ADDED = ["secret", "number", "address"]
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{20,}+",
    "number": r"(?<![A-Za-z0-9.+])[0-9]{6,}+(?![A-Za-z0-9])|\([0-9]{2,4}\) ?[0-9]{3,4}[\x20.-][0-9]{4}"
    r"|(?<![A-Za-z0-9.+-])[0-9]{2,4}([\x20.-])[0-9]{2,4}(?:\1[0-9]{2,4}){1,6}(?!\1[0-9]|[A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}){1,7}\x20(?=[A-Z]*[0-9])[A-Z0-9]{1,4}(?![A-Za-z0-9])",
    "address": rf"(?<!{_LOCAL}){_LOCAL}++@[A-Za-z0-9-]++(?!\.[A-Za-z0-9-])",
}
# A text without this has no match of the kind.
HINTS = {"email": "@", "ip": r"\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "secret": "[A-Za-z0-9_+/-]{20}", "number": "[0-9]{2}", "address": "@"}
GAZETTEER = "token key secret password passwd pwd pass api auth bearer account iban ssn passport phone tel telephone mobile fax card visa mail email contact".split()
HARMLESS = "page order item number no figure fig table section chapter isbn doi issn version year id line total sum row".split()
FORMS = (
    r"^([0-9a-f]{32,}|[0-9A-F]{32,}|(AKIA|ASIA)[0-9A-Z]{16}|(sk|pk|ghp|xox[bp])[_-].{16,}|\([0-9]{3}\) ?[0-9]{3}[\x20.-][0-9]{4}"
    r"|[0-9]{3}([\x20.-])[0-9]{3}\5[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(\x20[A-Z0-9]{4}){2,7}(\x20[A-Z0-9]{1,4})?)$"
)
# What stands after a word of the gazetteer, on the same line, with signs between at most.
_WORD = rf"(?<=(?<!\p{{L}})(?i:{'|'.join(GAZETTEER)})"
_TOKEN = r"[^\s\x22'`<>(){}\[\],;]*[A-Za-z0-9]"
PATTERNS["after"] = (
    r"(?<![A-Za-z0-9_+/-])(?:"
    rf"{_WORD}[^\p{{L}}\p{{N}}\n]{{1,6}})(?:[0-9]++(?:[\x20.-][0-9]++){{1,9}}(?![A-Za-z0-9])|(?=[^\s0-9]{{0,64}}[0-9])(?=\S{{4}}){_TOKEN})"
    rf"|{_WORD}[^\p{{L}}\p{{N}}\n]{{0,5}}[=:][^\p{{L}}\p{{N}}\n]{{0,5}})(?=\S{{4}}){_TOKEN})"
)
HINTS["after"] = rf"(?i)(?<!\p{{L}})(?:{'|'.join(GAZETTEER)})(?!\p{{L}})"
LABELERS = ["form", "make", "before", "harmless", "signs"]
CONTEXT = 64  # characters before a span that are looked at
GROWTH = 256  # entries of an array that is still appended to
SLOTS = 256
ROUNDS = 50
SURE = 0.9


class Trained(NamedTuple):
    prior: float  # log-odds that a candidate is real
    real: dict[int, float]  # per pattern of votes, the probability of being real
    weights: dict[str, list[float]]  # per feature, log-odds of each slot


PLACE = "struct<start:int,end:int,hit:string,before:string>"
SPAN = "struct<kind:string,start:int,end:int,hit:string,before:string>"
MARKED = f"struct<start:int,end:int,own:int,span:{SPAN}>"


def _scan(items: Column, kind: str, first: dict[str, Column], step: Callable[[Column, Column], tuple[dict[str, Column], Column, Column]]) -> Column:
    """What ``step`` gives for each item and the state before it, left to right, as one array.

    ``step`` returns the next state, the element, and whether the element is given. Appending copies
    an array, so a full one of ``GROWTH`` entries is put away and a new one begun.
    """
    none = F.array().cast(f"array<{kind}>")
    zero = F.struct(*[v.alias(k) for k, v in first.items()], none.alias("block"), F.array().cast(f"array<array<{kind}>>").alias("done"))

    def add(state: Column, item: Column) -> Column:
        after, element, given = step(state, item)
        full = given & (F.size(state["block"]) >= GROWTH)
        block = F.when(full, F.array(element)).when(given, F.array_append(state["block"], element)).otherwise(state["block"])
        done = F.when(full, F.array_append(state["done"], state["block"])).otherwise(state["done"])
        return F.struct(*[v.alias(k) for k, v in after.items()], block.alias("block"), done.alias("done"))

    return F.aggregate(items, zero, add, lambda state: F.flatten(F.array_append(state["done"], state["block"])))


def _places(text: Column, pattern: str) -> Column:
    """All matches, left to right, as structs of start, end (code points, exclusive), text, and what stands before."""
    between, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tail = lambda t: F.right(t, F.lit(CONTEXT))

    def step(state: Column, pair: Column) -> tuple[dict[str, Column], Column, Column]:
        start = state["at"] + F.length(pair["b"])
        end = start + F.length(pair["h"])
        before = tail(F.concat(state["tail"], pair["b"]))
        element = F.struct(start.alias("start"), end.alias("end"), pair["h"].alias("hit"), before.alias("before"))
        return {"at": end, "tail": tail(F.concat(before, pair["h"]))}, element, F.lit(True)

    def put(found: Column) -> Column:
        pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, h: F.struct(b.alias("b"), h.alias("h")))
        return _scan(pairs, PLACE, {"at": F.lit(0), "tail": F.lit("")}, step)

    return bind(hits, put)


def _clear(spans: Column, others: Column) -> Column:
    """The spans that touch none of the others, in order of start: one pass to the right, one to the left."""
    mark = lambda own: lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(own).alias("own"), s.alias("span"))
    both = F.sort_array(F.concat(F.transform(spans, mark(1)), F.transform(others, mark(0))))
    other = lambda m: m["own"] == 0

    def right(state: Column, m: Column) -> tuple[dict[str, Column], Column, Column]:
        reach = F.when(other(m), F.greatest(state["reach"], m["end"])).otherwise(state["reach"])
        return {"reach": reach}, m, other(m) | (m["start"] >= state["reach"])

    def left(state: Column, m: Column) -> tuple[dict[str, Column], Column, Column]:
        low = F.when(other(m), F.least(state["low"], m["start"])).otherwise(state["low"])
        return {"low": low}, m, ~other(m) & (m["end"] <= state["low"])

    there = _scan(both, MARKED, {"reach": F.lit(-1)}, right)
    back = _scan(F.reverse(there), MARKED, {"low": F.lit((1 << 31) - 1)}, left)
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), F.transform(F.reverse(back), lambda m: m["span"])).otherwise(spans)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.split(F.reverse(digits), "")
    value = F.transform(
        turned,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)),
    )
    return F.aggregate(value, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return hit.rlike(rf"^{part}(\.{part}){{3}}$")
    if kind == "card":
        return bind(_digits(hit), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _found(text: Column, kind: str) -> Column:
    """Spans of a kind that pass its check."""
    hits = F.filter(_places(text, PATTERNS[kind]), lambda s: _passes(kind, s["hit"]))
    spans = F.transform(hits, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["hit"], s["before"]))
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(none)


def _slot(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SLOTS)).cast("int")


def _judged(span: Column) -> Column:
    """A candidate with its votes and feature slots."""

    def judge(before: Column) -> Column:
        word = F.lower(F.regexp_extract(before, r"([\p{L}]+)[^\p{L}]*$", 1))
        signs = F.regexp_extract(before, r"([^\p{L}]*)$", 1)
        make = F.regexp_replace(F.regexp_replace(F.regexp_replace(span["hit"], "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
        least = F.when(F.length(span["hit"]) >= 20, 4).otherwise(1)
        mixed = (F.length(_digits(span["hit"])) >= least) & span["hit"].rlike("[A-Za-z]")
        vote = lambda yes, no=None: F.when(yes, 1).when(F.lit(False) if no is None else no, -1).otherwise(0)
        votes = [
            vote(span["hit"].rlike(FORMS), (span["kind"] == "number") & (F.length(span["hit"]) < 9)),
            vote((span["kind"] == "secret") & mixed, (span["kind"] == "secret") & ~mixed),
            vote(word.isin(GAZETTEER)),
            vote(F.lit(False), word.isin(HARMLESS)),
            vote(signs.rlike("[=:]")),
        ]
        return F.struct(
            span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
            sum(((v + 1) * 3**k for k, v in enumerate(votes)), F.lit(0)).alias("votes"),
            _slot(F.concat(word, F.regexp_replace(signs, r"\s", ""))).alias("word"),
            _slot(make).alias("make"),
            F.least(F.length(span["hit"]), F.lit(SLOTS - 1)).alias("length"),
        )

    return bind(span["before"], judge)


FEATURES = ["word", "make", "length"]


def candidates(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``base`` spans in order, and ``judged`` candidates. Written once."""
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    kind = lambda hit: F.when(hit.rlike("[A-Za-z]"), "secret").otherwise("number")
    after = F.transform(_found(text, "after"), lambda s: F.struct(kind(s["hit"]).alias("kind"), s["start"], s["end"], s["hit"], s["before"]))
    found = source.select(
        "doc_id", F.concat(*[_found(text, k) for k in BASE]).alias("base"), *[_found(text, k).alias(k) for k in ADDED], after.alias("after")
    )
    found = found.withColumn("taken", F.col("base"))
    for k in [*ADDED, "after"]:  # each leaves out what touches a span before it
        found = found.withColumn(k, _clear(F.col(k), F.col("taken"))).withColumn("taken", F.concat("taken", k))
    order = F.create_map(*[F.lit(v) for n, k in enumerate(ADDED) for v in (k, n)])
    keyed = F.transform(F.concat(*ADDED, "after"), lambda s: F.struct(order[s["kind"]].alias("order"), s["start"].alias("start"), s.alias("span")))
    return materialise(
        found.select(
            "doc_id",
            F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("base"),
            F.transform(F.sort_array(keyed), lambda s: _judged(s["span"])).alias("judged"),
        ), "pii-candidates",
    )


def reliabilities(counts: dict[int, int]) -> tuple[float, list[dict[int, tuple[float, float]]], dict[int, float]]:
    """Expectation-maximisation over counts of vote patterns.

    Gives the share of real candidates, per labeler and vote the probabilities of the vote for
    real and for other candidates, and each pattern's probability of being real. The start is
    the majority of the votes.
    """
    patterns = {p: [(p // 3**k) % 3 - 1 for k in range(len(LABELERS))] for p in counts}
    real = {p: 0.9 if sum(v) > 1 else 0.5 if sum(v) == 1 else 0.05 for p, v in patterns.items()}
    share, rates = 0.5, []
    for _ in range(ROUNDS):
        yes = sum(n * real[p] for p, n in sorted(counts.items()))
        no = sum(n * (1 - real[p]) for p, n in sorted(counts.items()))
        share = (yes + 1) / (yes + no + 2)
        rates = []
        for k in range(len(LABELERS)):
            seen = {v: [1.0, 1.0] for v in (-1, 0, 1)}
            for p, n in sorted(counts.items()):
                seen[patterns[p][k]][0] += n * real[p]
                seen[patterns[p][k]][1] += n * (1 - real[p])
            rates.append({v: (a / (yes + 3), b / (no + 3)) for v, (a, b) in seen.items()})
        for p, votes in patterns.items():
            odds = math.log(share / (1 - share)) + sum(math.log(r[v][0] / r[v][1]) for r, v in zip(rates, votes, strict=True))
            real[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return share, rates, real


def _of_votes(real: dict[int, float], votes: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for p in sorted(real) for x in (p, real[p])]), votes)


def train(found: DataFrame) -> Trained:
    """The span classifier, from counts per vote pattern and per feature slot (both bounded)."""
    each = found.select(F.explode("judged").alias("c")).select("c.*")
    counts = {r["votes"]: r["n"] for r in each.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Trained(-30.0, {0: 0.0}, {f: [0.0] * SLOTS for f in FEATURES})
    share, _, real = reliabilities(counts)
    entry = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("slot")) for f in FEATURES]))
    per_slot = each.select("votes", entry).groupBy("feature", "slot", "votes").agg(F.count(F.lit(1)).alias("n"))
    chance = _of_votes(real, F.col("votes"))
    sums = per_slot.groupBy("feature", "slot").agg(F.sum(F.col("n") * chance).alias("yes"), F.sum("n").alias("n"))
    total = sum(counts.values())
    yes = sum(n * real[p] for p, n in sorted(counts.items()))
    weights = {f: [0.0] * SLOTS for f in FEATURES}
    for row in sums.collect():  # at most SLOTS for each feature
        a, b = row["yes"] + 1, row["n"] - row["yes"] + 1
        weights[row["feature"]][row["slot"]] = round(math.log(a / (yes + SLOTS)) - math.log(b / (total - yes + SLOTS)), 6)
    return Trained(round(math.log(share / (1 - share)), 6), real, weights)


def spans(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``base`` spans and ``added`` ones, both in order of kind and start."""
    found = candidates(docs)
    model = train(found)

    def odds(c: Column) -> Column:
        parts = (F.element_at(F.array(*[F.lit(w) for w in model.weights[f]]), c[f] + 1) for f in FEATURES)
        return sum(parts, F.lit(model.prior))

    sure = lambda c: (odds(c) > math.log(SURE / (1 - SURE))) & (_of_votes(model.real, c["votes"]) > 0.5)
    added = F.transform(F.filter("judged", sure), lambda c: F.struct(c["kind"], c["start"], c["end"]))
    return found.select("doc_id", "base", added.alias("added"))


def joined(spans_column: Column) -> Column:
    """Spans as text, ``kind:start:end`` and commas."""
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
