"""Stages pass rows on as they came, whatever the names of their columns."""

import pytest

from dockcast.llm import exact_dedup, mixing, near_dedup, quality

NAMES = [
    "__ledger", "__d", "__c", "__i", "__k", "__key", "ROW", "i", "K", "keep", "of", "d", "c", "digest", "chars", "key", "times", "Rows",
    "place", "own", "size", "target", "node", "comp", "failed_bits", "bucket", "queue", "slot", "text_key", "ledger", "taken",
]
STAGES = {
    "quality": quality.apply_policy, "exact": exact_dedup.deduplicate, "near": near_dedup.deduplicate, "mixing": mixing.repeated,
}


@pytest.mark.parametrize("stage", sorted(STAGES))
def test_columns_of_any_name_come_through(spark, stage):
    words = "some words of a text that is long enough to be kept by every rule of quality here"
    rows = [(n, f"{words} {n} {n * 7} {n * 13} {chr(97 + n) * 9}", f"s{n % 2}", *[f"{c}{n}" for c in NAMES]) for n in range(12)]
    schema = ", ".join(["doc_id long", "text string", "source string", *[f"`{c}` string" for c in NAMES]])
    docs = spark.createDataFrame(rows, schema)
    got = STAGES[stage](docs)
    assert got.columns == docs.columns
    found = {tuple(r) for r in got.collect()}
    assert found and found <= set(rows) and (stage == "mixing" or found == set(rows))


def test_rows_of_one_id_and_other_texts_are_dealt_alike_on_every_run(spark):
    rows = [(7, f"text number {n} with words", "s", n) for n in range(60)] + [(None, "same text", "s", n) for n in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    runs = [sorted(map(repr, mixing.repeated(d).collect())) for d in (docs, docs.repartition(7))]
    assert runs[0] == runs[1] and len(set(runs[0])) < len(runs[0])
