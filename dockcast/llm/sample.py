"""A bounded sample of labelled rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import held_out

PARTS = 1_000_000


def training_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """About ``rows`` rows ``text, label`` at most, chosen by a hash of the id.

    Ids whose crc32 is divisible by five, and rows without id or label, never take part. An id
    with several labels has the largest, one with several texts the smallest text that isn't null,
    so that repeated ids don't add rows. The labels are sampled before they meet the texts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(PARTS)) < share * PARTS)
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")).select("text", "label")
