"""Token alignment against its definition, token by token."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dockcast.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox jumps over the lazy dog", "The quick brown fox", "", None, "x", " leading  double spaces ", "tabs\tand\nlines\n\nof text",
    "naïve café 便宜药丸 法院认为 🙂🙂 done", "special <|endoftext|> and <s> strings </s>", "a ▁ sign that isn't a space", "nul \x00 byte",
    "3.14159 + 2.71828 = 5.85987", "https://example.org/a/b?c=d&e=f", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 60, "the " * 3000, "The quick brown fox",
]


@pytest.fixture(scope="module")
def wanted():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    code = {chr(v): v for v in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    code |= {chr(256 + k): v for k, v in enumerate(v for v in range(256) if v not in code.values())}
    rows = []
    for text in TEXTS:
        raw = b" " + (text or "").encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        spelled_a = [bytes(code[c] for c in a.id_to_token(n)) for n in ids_a]
        names = [b.id_to_piece(n) for n in ids_b]
        spelled_b = [bytes([int(t[3:5], 16)]) if b.is_byte(n) else t.replace("▁", " ").encode() for n, t in zip(ids_b, names, strict=True)]
        if not text or b"".join(spelled_a) != raw or b"".join(spelled_b) != raw:
            rows.append((0, 0, [], []))
            continue
        spans = []
        for ids, spelled in ((ids_a, spelled_a), (ids_b, spelled_b)):
            at, own = 0, []
            for n, s in zip(ids, spelled, strict=True):
                own.append((n, at, at + len(s)))
                at += len(s)
            spans.append(own)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(n) for n, s, e in own if low <= s and e <= end) for own in spans))
            low = end
        links = [(x, y) for x, s, e in spans[0] for y, t, f in spans[1] if s < f and t < e]
        rows.append((len(ids_a), len(ids_b), groups, links))
    count = Counter(pair for r in rows for pair in set(r[3]))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(n, m, len(g), len(ls), ";".join(g), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls)) for n, m, g, ls in rows]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, rid long, pairs string").repartition(3)


@pytest.mark.parametrize("most", [alignment.MAX_PAIRS, 20, 0])
def test_alignment_equals_definition(docs, wanted, most):
    """All pairs broadcast, only the most common ones, none."""
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs, A, B, pattern=public_tokenizers.PATTERN, max_pairs=most).collect()}
    assert [got[i] for i in range(len(TEXTS))] == wanted
    assert sum(w[0] > 0 for w in wanted) >= 12


def test_digests_are_of_the_groups(docs, wanted):
    got = {r.doc_id: r.groups for r in alignment.align(docs, A, B, digest=True).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [hashlib.sha256(w[4].encode()).hexdigest() if w[4] else "" for w in wanted]


def test_windows_are_looked_up_and_forgotten(monkeypatch, wanted):
    own = alignment.Aligner(alignment.byte_level(A), alignment.pieces(B))
    asked = []
    align = own.align
    monkeypatch.setattr(own, "align", lambda keys: asked.append(len(keys)) or align(keys))
    plain = lambda rows: [r[:4] for r in rows]
    first = plain(own.rows(TEXTS))
    assert first == [(n, m, g, t) for n, m, g, _, t, _, _ in wanted]
    assert len(own.kept) > 20 and all(len(k) <= 4 * alignment.LONG for k in own.kept)
    assert plain(own.rows(TEXTS[:2])) == first[:2] and len(asked) == 1  # nothing new
    assert plain(own.rows(TEXTS)) == first and asked[1] < 4  # only the long ones
    monkeypatch.setattr(alignment, "MAX_KEPT", 3)
    assert plain(own.rows(TEXTS[:1])) == first[:1] and len(own.kept) < 12


def test_both_ways_of_encoding_give_the_ids_of_the_file(spark):
    folder = Path("/root/testdata/sf0.001/documents.parquet")
    rows = spark.read.parquet(str(folder)).select("text").collect() if folder.exists() else []
    draw = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABC  '.,-\n0123456789\u00e9\u00df\u4e2d\u6587\U0001f642\u0301"
    texts = [t for t in TEXTS if t] + [r.text for r in rows if r.text] + ["  two", "end ", " ", "   ", "a\u00a0b", "e\u0301 \u0301x", "I'm 'S we'll  'tis"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 300))) for _ in range(400)]
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    want = [a.encode(" " + t, add_special_tokens=False).ids for t in texts]
    for way in (alignment.byte_level(A, public_tokenizers.PATTERN), alignment.byte_level(A)):
        assert [x.tolist() for x in way.encode(texts)] == want


def test_empty_table(docs):
    assert alignment.align(docs.limit(0), A, B).count() == 0
