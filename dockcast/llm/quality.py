"""Quality rules as a ledger: every rule is evaluated once and leaves a bit and a measurement.

The ledger of a document holds its measurements and one long, ``failed_bits``, in which bit k
is set when rule k fails. A policy is a named, versioned set of rules, that is a mask; whether
it keeps a document is one bitwise AND. Ablations (what a policy would keep without one of its
rules) come from the counts of the bit patterns, of which there are at most 2 ** rules.

All of it is column expressions; a document is measured inside its own row, so nothing is
shuffled. Repeated windows are looked for by hash first. Only a text in which two windows
have the same hash is measured exactly, by sorting its windows as text.

A null text is an empty one: no words, so the word-count rule fails it. Repeated rows are
judged each for itself. Input columns other than the text are passed on untouched, except
that ``with_ledger`` replaces a column that has the name of its result.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import bind, without_blanks, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"


class Rule(NamedTuple):
    name: str
    fails: Callable[[Column], Column]  # of the struct of measurements


# The place in this list is the bit; rules are only ever added at the end.
RULES = [
    Rule("too_few_words", lambda m: m["n_words"] < 10),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    Rule("symbols", lambda m: 100 * m["n_symbols"] > 20 * m["n_words"]),
    Rule("duplicate_lines", lambda m: 100 * m["n_dup_lines"] > 30 * m["n_lines"]),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 40 * m["n_words"])),
    Rule("stuttered_words", lambda m: 100 * m["n_stutter"] > 30 * m["n_words"]),
    Rule("shouting", lambda m: (100 * m["n_upper"] > 70 * m["word_chars"]) & (m["word_chars"] > 0)),
]
BITS = {rule.name: 1 << k for k, rule in enumerate(RULES)}

POLICIES = {
    "base-1": ["too_few_words", "repeated_windows"],
    "web-1": ["too_few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length"],
    "web-2": [rule.name for rule in RULES],
}
PRODUCTION = "web-2"
BASE = "base-1"


def mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def _repeat_words(w: Column) -> Column:
    """Words inside windows that the text has at least twice."""
    n = F.size(w)
    starts = F.sequence(F.lit(0), n - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(places: Column) -> Column:
        step = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0), lambda a, b: a + b)

    def twice(runs: Column) -> Column:
        same = F.filter(runs, lambda r, j: (r["g"] == F.get(runs, j - 1)["g"]) | (r["g"] == F.get(runs, j + 1)["g"]))
        return F.sort_array(F.transform(same, lambda r: r["p"]))

    grams = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("g"), i.alias("p")))
    exact = bind(bind(F.sort_array(grams), twice), covered)
    clash = bind(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n <= WINDOW, 0).when(clash, exact).otherwise(0).cast("long")


def _measured(w: Column, lines: Column, dense: Column) -> dict[str, Column]:
    without = lambda chars: F.length(dense) - F.length(F.translate(dense, chars, ""))
    return {
        "n_words": F.size(w),
        "word_chars": F.length(dense),
        "n_symbols": without(SYMBOLS),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(w),
        "n_stutter": F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))),
        "n_upper": F.length(dense) - F.length(F.regexp_replace(dense, r"\p{Lu}", "")),
    }


def ledger(text: Column) -> Column:
    """All measurements of a text and ``failed_bits``, as one expression.

    Words, lines and measurements are bound, not repeated: a filter on the ledger that moves
    down the plan takes a single copy with it.
    """
    kept = F.coalesce(text, F.lit(""))
    split = F.filter(F.split(kept, "\n", -1), lambda line: without_blanks(line) != "")

    def judged(m: Column, names: list[str]) -> Column:
        bits = sum((F.when(rule.fails(m), BITS[rule.name]).otherwise(0) for rule in RULES), F.lit(0)).cast("long")
        return F.struct(*[m[n].alias(n) for n in names], bits.alias("failed_bits"))

    def measured(w: Column, lines: Column, dense: Column) -> Column:
        values = _measured(w, lines, dense)
        return bind(F.struct(*[v.cast("long").alias(k) for k, v in values.items()]), lambda m: judged(m, list(values)))

    return bind(words(text), lambda w: bind(split, lambda ls: bind(without_blanks(text), lambda d: measured(w, ls, d))))


def with_ledger(docs: DataFrame, text: str = "text", into: str = "ledger") -> DataFrame:
    """``docs`` with the ledger of each text."""
    return docs.withColumn(into, ledger(F.col(text)))


def keeps(policy: str, bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The rows a policy keeps, with the columns they came with."""
    return docs.where(keeps(policy, ledger(F.col("text"))["failed_bits"]))


def ablations(bits: DataFrame, policies: list[str] | None = None) -> DataFrame:
    """Per policy and rule: documents kept, documents only this rule rejects, bit failures.

    ``bits`` has a column ``failed_bits``. It is first counted per pattern, and everything
    else is a bitwise aggregation over those few counts. An empty table gives no rows.
    """
    patterns = bits.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    entries = [
        F.struct(F.lit(p).alias("policy"), F.lit(name).alias("rule"), F.lit(mask(p)).alias("m"), F.lit(BITS[name]).alias("bit"))
        for p in policies or POLICIES
        for name in POLICIES[p]
    ]
    each = patterns.select("failed_bits", "n", F.inline(F.array(*entries)))
    hit = F.col("failed_bits").bitwiseAND(F.col("m"))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return each.groupBy("policy", "rule").agg(
        total(hit == 0).alias("kept"),
        total(hit == F.col("bit")).alias("only_this_rule"),
        total(F.col("failed_bits").bitwiseAND(F.col("bit")) != 0).alias("fails"),
    )
