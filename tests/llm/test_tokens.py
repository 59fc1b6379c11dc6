"""Encoding and counting against the libraries."""

import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from dockcast.llm import bpe, token_count

PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'", "'ll", "1", "23", "é", "日本", "!", "?!", " ", "　", "\x1c", "\x85",
          "😀", "ing", "###", "<|endoftext|>", "\r\n", "ab" * 20, "​", "ǅ", "٣", "Ⅷ", "½", "<|endof", "=", "==="]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(1)
    made = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 120))) for _ in range(400)]
    return [*made, "a" * 5000, " " * 3000, "ab " * 3000, "日" * 4000, "x" + " " * 999 + "y", "'" * 500, "\n" * 100 + "a"]


@pytest.fixture(scope="module")
def plain():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("leaf", [2, 7, 64, 4096])
def test_tree_equals_library(texts, plain, leaf):
    ranks, library = plain
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN, leaf)
    for text in texts:
        ids = codec.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("chunk", [1, 5, 40, 8192])
def test_transducer_equals_library(texts, chunk):
    counter = token_count.counter(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts:
        assert counter.count(text, chunk) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return token_count.Counter.from_json(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def test_every_cut_is_a_border(texts):
    """Pieces of the parts are the pieces of the whole, at all cuts together and at each alone."""
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in texts:
        whole = pattern.findall(text)
        cuts = [0, *(m.start() for m in token_count._CUT.finditer(text)), len(text)]
        assert [p for a, b in zip(cuts, cuts[1:], strict=False) for p in pattern.findall(text[a:b])] == whole
        for cut in cuts[1:-1:29]:
            assert pattern.findall(text[:cut]) + pattern.findall(text[cut:]) == whole


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_chunks_cover_the_text(texts, chunk):
    for text in texts:
        spans = list(token_count.chunks(text, chunk))
        assert "".join(text[a:b] for a, b in spans) == text and all(a < b for a, b in spans)


def test_composition_is_associative_and_holds_no_text(counter):
    piece = "abcdefgh" * 40 + "zzzz" * 50 + "日本" * 30
    a, b, c = (counter.inner_map(piece, k, k + 150) for k in (0, 150, 300))
    compose, start = token_count.compose, token_count.START
    left, right = compose(compose(a, b), c), compose(a, compose(b, c))
    want = counter.pieces.transducer.run(start, piece[:450].encode())
    assert left(start) == right(start) == want
    longest = max(len(t) for t in counter.pieces.transducer.tokens)
    for one in (a, b, c, left, right):
        for before, (after, n) in one.known.items():
            assert isinstance(n, int) and all(len(begun) < longest for begun, _, _ in (*before, *after))


@pytest.mark.parametrize("unit", ["a", "ab", "é", "日", "=", "-", " ", "\n", "9", "zq", "?!"])
def test_runs_without_a_cut_are_composed(counter, monkeypatch, unit):
    """Whatever state is foretold, right or wrong, the composition gives the library's count."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for look in (0, 3, 128):
        monkeypatch.setattr(token_count, "LOOK_CHARS", look)
        for n in (1, 63, 64, 65, 1000, 3001):
            for text in (unit * n, "'s" + unit * n, " " + unit * n + "x"):
                assert counter.count(text, 64) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("made", ["x9/Qr", "日本語文", "aB3"])
def test_text_without_cuts_takes_memory_in_proportion(made):
    counter = token_count.counter(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    text = made * (150_000 // len(made))
    want = len(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids)
    counter.count(text[:1000], 64)
    tracemalloc.start()
    try:
        assert counter.count(text, 64) == want
        assert tracemalloc.get_traced_memory()[1] < 60 * len(text)
    finally:
        tracemalloc.stop()


def test_tables_are_bounded_inside_a_piece(monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 300)
    monkeypatch.setattr(token_count, "BLOCK", 64)
    counter = token_count.Counter.from_json(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    draw = random.Random(5)
    text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyzé日本語") for _ in range(20_000))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(counter.pieces.transducer.states) <= 300 + 64 + 1 and text not in counter.pieces


def test_rows_without_text_and_repeated(spark, plain):
    rows = [(1, None, 0), (1, None, 0), (None, "a b", 1), (3, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    got = bpe.token_digests(docs, path, pattern).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == [(-1, 2), (1, 0), (1, 0), (3, 0)]
    row = next(r for r in got if r.doc_id is None)
    ids = plain[1].encode_ordinary("a b")
    assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(b"a b").hexdigest()
    assert bpe.token_digests(docs.limit(0), path, pattern).count() == 0
    counts = token_count.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), pattern).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in counts) == [(-1, 3, 2), (1, 0, 0), (1, 0, 0), (3, 0, 0)]
