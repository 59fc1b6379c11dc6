"""Joins of big fact tables with dimension tables whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension of at most this many rows is sent to every executor (tens of MB for ten
# numeric columns); a larger one is joined by shuffle.
MAX_BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``max_rows`` rows: a plain count, a number from each task.

    No column is needed for it, so a scan reads footers only.
    """
    return df.select(F.lit(1)).count() <= max_rows


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "inner",
    small: bool | None = None,
) -> DataFrame:
    """Join facts to a dimension on one key.

    A small dimension is broadcast and the facts do not move. A large one is joined by
    shuffle; a key that holds a large share of the facts is split at run time by adaptive
    execution (``spark.sql.adaptive.skewJoin.enabled``, set by the session). A caller that knows
    the size of the dimension says so.
    """
    if small is None:
        small = is_small(dim)
    return facts.join(F.broadcast(dim) if small else dim, facts[fact_key] == dim[dim_key], how)


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """The same table in a role: every column name gets the prefix."""
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def cluster_members(
    data: DataFrame, labels: DataFrame, cluster: int, keep_station: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows of the stations of one cluster, the station ids of the cluster)."""
    ids = labels.filter(F.col("cluster") == cluster).select("sta_id").distinct()
    rows = lookup_join(data, ids, "s_sta_id", "sta_id", "left_semi")
    return (rows if keep_station else rows.drop("s_sta_id")), ids


def with_cluster(data: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of all labelled stations at once, with their cluster."""
    keys = labels.select(F.col("sta_id").alias("_sta_id"), "cluster")
    return lookup_join(data, keys, "s_sta_id", "_sta_id").drop("_sta_id")
