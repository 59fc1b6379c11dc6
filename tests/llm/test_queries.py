"""Registered operators against their SQL, and the pipeline against brute force."""

import random
import re
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from dockcast.llm import bpe, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = queries.registered()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted(got.columns) == sorted(columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=repr)


def test_pipeline_equals_brute_force(spark, tmp_path):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    base = [" ".join(word() for _ in range(60)) for _ in range(30)]
    rows = []
    for n in range(150):
        text = base[n % 30]
        if n % 5 == 1:
            text = text.replace(" ", "\n", 3)
        if n % 5 == 2:
            text += " " + word()
        if n % 5 == 3:
            text = "too short" if n % 2 else None
        rows.append((n, text, "en", f"src{n % 4}" if n % 13 else None, len(text or "")))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = {r[0]: r for r in rows if len(WORD.findall(r[1] or "")) >= 10}
    best = {}
    for i, r in left.items():  # equal without blanks: the longest, then the smallest id
        key = re.sub(r"[\x20\x09-\x0D]", "", r[1])
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(r[1]), i))
    left = {i: left[i] for _, i in best.values()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, r in left.items() for w in [WORD.findall(r[1])]}
    stays = []
    for i in sorted(left):  # the groups here are cliques, so the first of each stays
        if all(100 * len(sets[i] & sets[j]) < 75 * len(sets[i] | sets[j]) for j in stays):
            stays.append(i)
    size = {}
    for i in stays:
        size[left[i][3]] = size.get(left[i][3], 0) + len(WORD.findall(left[i][1]))
    times = {}
    for r in got:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) <= set(stays) and max(times.values()) <= 2
    words = sum(n * len(WORD.findall(left[i][1])) for i, n in times.items())
    assert 1.5 * sum(size.values()) - 70 <= words <= 1.5 * sum(size.values())
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        assert r.round_trip and bytes(r.token_ids) == b"".join(t.to_bytes(4, "little") for t in plain.encode_ordinary(left[r.doc_id][1]))
        assert r.n_tokens * 4 == len(r.token_ids) and r.source == left[r.doc_id][3]
