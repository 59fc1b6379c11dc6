"""Exact and near dedup against brute force, and the cuckoo index on its own."""

import hashlib
import random
import re

import numpy as np
import pytest

from dockcast.llm import exact_dedup as exact
from dockcast.llm import near_dedup as near

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, digest string, node long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)


def digest(n):
    return hashlib.sha256(str(n).encode()).digest()


def test_cuckoo_index_grows_and_forgets():
    index = exact.CuckooIndex(buckets=2)
    numbers = {n: index.insert(digest(n)) for n in range(3000)}
    assert all(index.find(digest(n)) == k for n, k in numbers.items()) and len(index) == 3000
    assert all(index.find(digest(n)) < 0 for n in range(3000, 6000))
    assert all(index.delete(digest(n)) for n in range(0, 3000, 2)) and not index.delete(digest(0))
    assert [index.find(digest(n)) >= 0 for n in range(3000)] == [n % 2 == 1 for n in range(3000)]
    again = index.insert(digest(0))
    assert index.keys[again] == digest(0) and len(index) == 1501


def slow_groups(rows):
    best, size = {}, {}
    dense = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in rows:
        d = dense(t)
        size[d] = size.get(d, 0) + 1
        rank = (-len(t or ""), i is None, i or 0)
        best[d] = min(best.get(d, rank), rank)
    return {d: (None if r[1] else r[2], size[d]) for d, r in best.items()}, dense


def test_groups_equal_brute_force(spark):
    draw = random.Random(3)
    rows = [(n if n % 9 else None, draw.choice(["a b", "ab", " a\tb ", "é", None, "", "  ", f"u{n}"])) for n in range(300)] + [(5, "a b")] * 3
    want, dense = slow_groups(rows)
    got = exact.groups(table(spark, rows)).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(d.encode()).digest(): v for d, v in want.items()}
    kept = {}
    for r in got:
        assert (r.keep_id, r.group_size) == by_digest[bytes(r.digest)]
        kept[bytes(r.digest)] = kept.get(bytes(r.digest), 0) + r.kept
    assert set(kept.values()) == {1} and len(kept) == len(want)
    stays = exact.deduplicate(table(spark, rows))
    assert stays.columns == ["doc_id", "text", "digest", "node"] and len(stays.collect()) == len(want)
    assert {dense(r.text) for r in stays.collect()} == set(want)
    assert exact.groups(table(spark, []).limit(0)).count() == 0


def test_index_takes_documents_in_and_out(spark):
    first = exact.fingerprints(table(spark, [(1, "a"), (2, "a"), (3, "b")]))
    more = exact.fingerprints(table(spark, [(4, "b"), (5, "c")]))
    gone = exact.fingerprints(table(spark, [(3, "b"), (4, "b"), (1, "a"), (9, "zzz")]))
    live = {bytes(r.digest): r.live for r in exact.update_index(exact.build_index(first), more, gone).collect()}
    assert live == {hashlib.sha256(b"a").digest(): 1, hashlib.sha256(b"c").digest(): 1}


def test_deletion_chooses_anew_among_members(spark):
    """The index after a change equals one that is built of the documents that are left."""
    held = [(1, "a b"), (2, "ab"), (2, "ab"), (3, "ab"), (None, "a  b"), (5, "c"), (6, "d"), (7, None), (8, "")]
    more = [(9, "a   b"), (10, "e"), (10, "e")]
    gone = [(None, "a  b"), (9, "a   b"), (2, "ab"), (5, "c"), (10, "e"), (77, "d"), (6, "zz"), (7, "")]
    left = [(1, "a b"), (2, "ab"), (3, "ab"), (6, "d"), (8, ""), (10, "e")]
    prints = [exact.fingerprints(table(spark, rows)) for rows in (held, more, gone, left)]
    index = exact.update_index(exact.build_index(prints[0]), *prints[1:3], members=prints[0])
    plain = lambda d: sorted((bytes(r.digest), r.live, r.chars, r.keep_id) for r in d.collect())
    assert plain(index) == plain(exact.build_index(prints[3]))
    again = exact.update_index(index, removed=exact.fingerprints(table(spark, [(1, "a b")])), members=prints[3])
    assert next(r.keep_id for r in again.collect() if r.digest == hashlib.sha256(b"ab").digest()) == 2
    emptied = exact.update_index(index, removed=prints[3], members=prints[3])
    assert emptied.count() == 0 and exact.update_index(emptied, prints[1], members=prints[0].limit(0)).count() == 2


def test_shards_grow_with_the_rows(spark, monkeypatch):
    rows = [(k, f"t{k // 2}") for k in range(600)]
    prints = exact.fingerprints(table(spark, rows))
    whole = sorted((bytes(r.digest), r.live, r.keep_id) for r in exact.build_index(prints).collect())
    monkeypatch.setattr(exact, "SHARD_ROWS", 20)
    index = exact.build_index(prints)
    assert index.rdd.getNumPartitions() == 30
    assert sorted((bytes(r.digest), r.live, r.keep_id) for r in index.collect()) == whole and len(whole) == 300


def slow_classes(rows):
    """Component and set size per row number."""
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    name = list(range(len(rows)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                name[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    ids = {r: min((i for i in v if i is not None), default=None) for r, v in least.items()}
    return [(i, len(s), ids[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = [(0, None), (1, ""), (2, "a b"), (3, "A  b"), (4, "a b c"), (5, " \n"), (None, "lonely words of a null id"), (None, "lonely words of a null id")]
    for n in range(12):
        base = [word() for _ in range(draw.choice([8, 40, 120, 400]))]
        if n % 3 == 0:
            base = passage + base[:20]
        for _ in range(12):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2, 5, 12])):
                copy[draw.randrange(len(copy))] = word()
            rows.append((len(rows) * 7 % 1009, " ".join(copy).upper() if draw.random() < 0.2 else " ".join(copy)))
    return [*rows, rows[20], rows[21]]


@pytest.mark.parametrize(("block", "hot", "most"), [(4, 3, 100), (4, 3, 1), (near.BLOCK, near.HOT, 100)])
def test_classes_equal_brute_force(spark, monkeypatch, block, hot, most):
    for name, value in (("BLOCK", block), ("HOT", hot), ("HOT_BUCKETS", most)):
        monkeypatch.setattr(near, name, value)
    rows = corpus()
    got = near.classes(table(spark, rows)).collect()
    plain = lambda x: sorted(x, key=repr)
    assert plain([(r.doc_id, r.n_shingles, r.component_id) for r in got]) == plain(slow_classes(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_class_stays(spark):
    rows = corpus()
    stays = near.deduplicate(table(spark, rows))
    assert stays.columns == ["doc_id", "text", "digest", "node"]
    got = [r.doc_id for r in stays.collect()]
    want = {c for _, n, c in slow_classes(rows) if n} | {i for i, n, _ in slow_classes(rows) if not n}
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert near.classes(table(spark, []).limit(0)).count() == 0


def test_estimate_corrects_for_chance():
    draw = np.random.default_rng(1)
    for size, shared in ((50, 0), (200, 150), (3000, 1500)):
        guesses = []
        for _ in range(30):
            all_hashes = draw.integers(0, 1 << 64, 2 * size - shared, dtype=np.uint64)
            a, b = near.sketch(all_hashes[:size]), near.sketch(all_hashes[size - shared :])
            guesses.append(near.estimate((a == b).mean(), size, size))
        assert abs(np.mean(guesses) - shared / (2 * size - shared)) < 0.03
