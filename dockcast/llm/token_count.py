"""Token counts by a tokenizer compiled into a finite-state transducer.

The rules of a byte-level BPE file are compiled into a deterministic transducer over bytes.
A state stands for what may still matter of a piece read so far: each of its ends that begins a
longer token, with the token that the encoding up to there ends with and how many tokens that
encoding has, relative to here. That is enough to find the token that the encoding ends with
after one more byte: the one token that can follow the token before it.
Two tokens can follow each other if the encoding of their bytes together is these two; and
tokens that each can follow the one before are the encoding. Each transition is annotated with
the change in the number of tokens. States and transitions are made when first met, in tables
of bounded size; whole pieces that were run lately are kept as one transition.

A text is cut into chunks, and a chunk's map says for each live state at its start which state
its end has and how many tokens it adds. Maps hold states and counts, no text. They compose
in pairs, round by round. A chunk ends at a safe cut where it can: a place at which pieces meet
whatever is around (between two classes of characters, and before the last of some white space).
The state there is the start state, so the map has one entry. Only inside a run of one class
that is longer than a chunk there is no such place. There the live state is foretold by reading
the last characters of the chunk before, as the states of most texts meet after a few tokens.
Where it was another one, the map gets an entry for it from the chunk itself.

The cuts hold for the pattern of this vocabulary: optional blank and letters, digits or other
signs, contractions after an apostrophe, white space without its last character.

Special strings in the text count one each, as the file's library has it by default. Null
text is an empty one and has no tokens. Repeated rows get equal results; other columns of the
input don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from dockcast.llm.common import slices, texts_of

CHUNK_CHARS = 8192
LOOK_CHARS = 128
MAX_STATES = 200_000
BLOCK = 4096
FEW = 16
NONE: frozenset[int] = frozenset()
MAX_PIECES = 300_000
MAX_KEPT = 256  # characters of a piece that is kept
_SIGN = r"[^\s\p{L}\p{N}]"
_CUT = regex.compile(
    r"(?<=\S)(?=\s)|(?<=.)(?=\s\S)"
    rf"|(?<=\p{{L}})(?=\p{{N}}|{_SIGN})|(?<=\p{{N}})(?=\p{{L}}|{_SIGN})|(?<={_SIGN})(?=\p{{N}})|(?<=(?!'){_SIGN})(?=\p{{L}})",
    regex.DOTALL,
)


START = ((b"", -1, 0),)  # the state at a border of pieces


class State:
    __slots__ = ("open", "step")

    def __init__(self, places: tuple[tuple[bytes, int, int], ...]):
        self.open = places
        self.step: dict[int, tuple[State, int]] = {}


class Transducer:
    """Reads the bytes of one piece; the sum of the annotations is its number of tokens."""

    def __init__(self, tokens: dict[bytes, int], merges: dict[tuple[bytes, bytes], int]):
        self.tokens = tokens
        self.begins: dict[bytes, list[int]] = {}
        for text, n in tokens.items():
            for k in range(1, len(text)):
                self.begins.setdefault(text[:k], []).append(n)
        made = {tokens[a + b]: rank for (a, b), rank in merges.items()}
        if len(made) != len(merges) or any(n not in made for t, n in tokens.items() if len(t) > 1):
            raise ValueError("each token must be made by one merge")
        pairs = {rank: (tokens[a], tokens[b]) for (a, b), rank in merges.items()}
        self.names = {n: t for t, n in tokens.items()}
        self.rank = {n: made.get(n, -1) for n in tokens.values()}
        self.parts = {n: pairs[rank] for n, rank in made.items()}
        self.pairs = {pair: rank for rank, pair in pairs.items()}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.after: dict[tuple[bytes, int], object] = {}

    def _state(self, places: tuple) -> State:
        found = self.states.get(places)
        if found is None:
            found = self.states[places] = State(places)
        return found

    def _can_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is these two tokens.

        Undoes the merges at the seam, the latest first. A pair that stands at the seam must not
        merge before the next change there. Of two equal merges the one on the left comes first.
        """
        if left < 0:
            return True
        limit = len(self.pairs)
        while True:
            merged = self.pairs.get((left, right))
            if merged is not None and merged < limit:
                return False
            a, b = self.rank[left], self.rank[right]
            if a > b:
                limit, left = a, self.parts[left][1]
            elif b >= 0:
                limit, right = b + 1, self.parts[right][0]
            else:
                return True

    def _after(self, begun: bytes, last: int) -> int | frozenset[int]:
        """What is left to know of ``last``: itself, or the few tokens with this begin that can follow it."""
        longer = self.begins[begun]
        if len(longer) > FEW:
            return last
        known = self.after.get((begun, last))
        if known is None:
            known = self.after[begun, last] = frozenset(t for t in longer if self._can_follow(last, t))
        return known

    def _compile(self, state: State, byte: int) -> tuple[State, int]:
        end = bytes([byte])
        read = [(begun + end, last, ahead) for begun, last, ahead in state.open]
        for begun, last, ahead in read:  # longest first
            token = self.tokens.get(begun)
            if token is not None and (token in last if type(last) is frozenset else self._can_follow(last, token)):
                break
        else:
            raise ValueError("the tokenizer has no token for some byte")
        change = ahead + 1
        still = []
        for begun, last, ahead in read:
            if begun in self.begins:
                if type(last) is frozenset:
                    last = frozenset(t for t in last if self.names[t].startswith(begun) and self.names[t] != begun)
                else:
                    last = self._after(begun, last)
                if last != NONE:
                    still.append((begun, last, ahead - change))
        step = state.step[byte] = self._state((*still, (b"", token, 0))), change
        return step

    def run(self, places: tuple, text: bytes) -> tuple[tuple, int]:
        """The state after ``text`` and the tokens added, from the state of these places."""
        state, n = None, 0
        for k in range(0, len(text), BLOCK):
            if len(self.states) > MAX_STATES:
                self._reset()
                state = None if state is None else self._state(state.open)
            state = state or self._state(places)
            for byte in text[k : k + BLOCK]:
                state, change = state.step.get(byte) or self._compile(state, byte)
                n += change
        return places if state is None else state.open, n

    def count(self, piece: bytes) -> int:
        return self.run(START, piece)[1]


class Pieces(dict):
    """Piece to number of tokens, kept for pieces met lately."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> int:
        n = self.transducer.count(piece.encode())
        if len(piece) <= MAX_KEPT:
            if len(self) > MAX_PIECES:
                self.clear()
            self[piece] = n
        return n


class StateMap:
    """From the state at a chunk's start to the state at its end and the tokens between.

    ``known`` holds the states met so far; ``extend`` finds the entry of another one.
    """

    __slots__ = ("known", "extend")

    def __init__(self, known: dict[tuple, tuple[tuple, int]], extend: Callable[[tuple], tuple[tuple, int]]):
        self.known = known
        self.extend = extend

    def __call__(self, places: tuple) -> tuple[tuple, int]:
        found = self.known.get(places)
        if found is None:
            found = self.known[places] = self.extend(places)
        return found


def compose(left: StateMap, right: StateMap) -> StateMap:
    """First ``left``, then ``right``; its entries are those that both maps have."""

    def extend(places: tuple) -> tuple[tuple, int]:
        middle, n = left(places)
        end, more = right(middle)
        return end, n + more

    known = {}
    for places, (middle, n) in left.known.items():
        then = right.known.get(middle)
        if then is not None:
            known[places] = then[0], n + then[1]
    return StateMap(known, extend)


def reduce(maps: list[StateMap]) -> StateMap:
    """The composition of all, in a logarithmic number of rounds."""
    while len(maps) > 1:
        pairs = [compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
        maps = pairs + maps[2 * len(pairs) :]
    return maps[0]


class Counter:
    def __init__(self, tokens: dict[bytes, int], merges: dict[tuple[bytes, bytes], int], pattern: str, special: list[str]):
        self.pieces = Pieces(Transducer(tokens, merges))
        self._pattern = regex.compile(pattern)
        self._special = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None

    @classmethod
    def from_json(cls, path: str, pattern: str) -> Counter:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, front = spec["model"], spec["pre_tokenizer"]
        plain = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or front["type"] != "ByteLevel" or front["add_prefix_space"] or any(model.get(k) for k in plain):
            raise ValueError("only plain byte-level BPE files are compiled")
        code = _byte_code()
        raw = lambda t: bytes(code[c] for c in t)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        special = [t["content"] for t in spec["added_tokens"]]
        tokens = {raw(t): n for t, n in model["vocab"].items() if t not in special}
        return cls(tokens, {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}, pattern, special)

    def inner_map(self, piece: str, a: int, b: int) -> StateMap:
        """The map of the characters from ``a`` to ``b`` of one piece, with the entry that is foretold."""
        transducer = self.pieces.transducer
        extend = lambda places: transducer.run(places, piece[a:b].encode())
        likely = transducer.run(START, piece[max(0, a - LOOK_CHARS) : a].encode())[0]
        return StateMap({likely: extend(likely)}, extend)

    def _long(self, piece: str, chunk: int) -> int:
        maps = [self.inner_map(piece, a, min(a + chunk, len(piece))) for a in range(0, len(piece), chunk)]
        return reduce(maps)(START)[1]

    def _pieces(self, text: str, chunk: int) -> int:
        if len(text) <= chunk:
            return sum(map(self.pieces.__getitem__, self._pattern.findall(text)))
        found = (m.group() for m in self._pattern.finditer(text))  # not all pieces at a time
        return sum(self._long(p, chunk) if len(p) > chunk else self.pieces[p] for p in found)

    def chunk_map(self, text: str, a: int, b: int, chunk: int) -> StateMap:
        """The map of a chunk between safe cuts (or ends of the text)."""

        def extend(places: tuple) -> tuple[tuple, int]:
            if places != START:
                raise ValueError("pieces begin at a safe cut")
            return START, self._pieces(text[a:b], chunk)

        return StateMap({START: extend(START)}, extend)

    def _count_plain(self, text: str, chunk: int) -> int:
        if len(text) <= chunk:
            return self._pieces(text, chunk)
        return reduce([self.chunk_map(text, a, b, chunk) for a, b in chunks(text, chunk)])(START)[1]

    def count(self, text: str, chunk: int = CHUNK_CHARS) -> int:
        if self._special is None:
            return self._count_plain(text, chunk)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(self._count_plain(p, chunk) for p in parts)


def chunks(text: str, chunk: int) -> Iterator[tuple[int, int]]:
    """Begin and end of chunks that end at the last safe cut they have, else at the next one."""
    a = 0
    while a < len(text):
        b = a + chunk
        if b < len(text):
            b = _last_cut(text, a, b) or _next_cut(text, b)
        yield a, min(b, len(text))
        a = b


def _last_cut(text: str, a: int, b: int) -> int:
    """The last safe cut behind ``a`` up to ``b``, 0 if there is none."""
    reach = 64
    while True:
        low = max(a + 1, b - reach)
        cuts = [m.start() for m in _CUT.finditer(text, low, min(b + 2, len(text))) if m.start() <= b]
        if cuts or low == a + 1:
            return cuts[-1] if cuts else 0
        reach *= 2


def _next_cut(text: str, b: int) -> int:
    found = _CUT.search(text, b)
    return found.start() if found else len(text)


def _byte_code() -> dict[str, int]:
    """The printable characters by which such files write bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter.from_json(path, pattern)


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path, pattern)
        for part in slices(batches):
            texts = texts_of(part)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([c.count(t) for t in texts], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
