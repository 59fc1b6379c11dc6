"""Shards against the definition, repeated rows, kept columns and files."""

import hashlib
import zlib
from collections import Counter

import pytest

from dockcast.llm import sharding


def defined(rows, n_shards, seed=0):
    """Rank in each source by the seeded hash, order by fractional rank, cut."""
    place = lambda r: hashlib.md5(f"{seed}:{'null' if r[0] is None else r[0]}:{hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest()
    queues = {}
    for r in rows:
        queues.setdefault((r[2] is None, r[2] or ""), []).append(r)
    order = []
    for queue, own in queues.items():
        offset = int(hashlib.md5(f"{seed}:{int(queue[0])}{queue[1]}".encode()).hexdigest()[:8], 16) / 2**32
        for k, r in enumerate(sorted(own, key=place)):
            order.append(((k + 1 - offset) / len(own), queue, k, r))
    order.sort(key=lambda x: x[:3])
    out, total = [], len(order)
    for at, (_, _, _, r) in enumerate(order):
        shard = at * n_shards // total
        raw = (r[1] or "").encode()
        out.append((r[0], r[2], len(raw) + 1, zlib.crc32(raw), shard, at - -(-shard * total // n_shards)))
    return out


def rows_of(n):
    out = [(i, f"text {i % 50}", "hot" if i % 3 else f"s{i % 5}") for i in range(n)]
    return out + [(None, "no id", "hot"), (7, None, None), (8, "", None), (9, "long " * 20_000, ""), (10, "é🙂", "s1")]


@pytest.mark.parametrize(("n", "shards"), [(400, 16), (3, 16), (90, 1), (333, 7)])
def test_shards_equal_definition(spark, n, shards):
    rows = rows_of(n) + [(7, "same", "hot")] * 90
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = sharding.shards(docs, shards, copies=13)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, defined(rows, shards)))
    sizes = Counter(r.shard for r in got.collect())
    assert max(sizes.values()) - min(sizes[k] for k in range(shards)) <= 1


def test_every_shard_matches_the_mixture(spark):
    rows = rows_of(3000)
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    mix = Counter(r[2] for r in rows)
    for shard in range(16):
        own = Counter(r.source for r in got if r.shard == shard)
        assert all(abs(own[s] - n / 16) <= 1 + len(mix) * n / len(rows) for s, n in mix.items())


def test_rows_of_many_small_sources_are_spread(spark):
    rows = [(i, f"t{i}", f"host{i // 2}") for i in range(1600)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    early = Counter(r.shard for r in got if r.source < "host5")
    assert len(early) == 16 and min(early.values()) > sum(early.values()) / 32


def test_seed_files_and_kept_columns(spark, tmp_path):
    rows = [(i % 40, f"t{i % 20}", f"s{i % 2}", i // 60, i % 7) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int, ROW int")
    one, other = ({(r.doc_id, r.slot, r.shard) for r in sharding.shards(docs, 4, seed=s).collect()} for s in (1, 2))
    assert one != other and one == {(r.doc_id, r.slot, r.shard) for r in sharding.shards(docs.repartition(9), 4, seed=1).collect()}
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(tuple(r.row) for r in back.collect()) == sorted(rows)
    for shard in range(4):
        assert sorted(r.slot for r in back.where(f"shard = {shard}").collect()) == list(range(30))
    assert sharding.shards(docs.limit(0)).count() == 0
