"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges of a public tokenizer decide which tokens may stand side by side: a row of tokens is the encoding of its bytes
exactly if each neighbouring pair is the encoding of its own bytes. So the last token of the encoding of every prefix of a word
is fixed by the bytes so far, and it can be found byte by byte. The transducer's state is what later bytes can depend on:

* the longest end of the input that still begins some token (the only places where a later token can start), and
* for each of those places, the tokens up to it that are not yet common to all of them (the residual output).

A transition reads a byte, extends the places that still matter and emits the tokens all of them share; since a place is
dropped once no token reaches so far back, lookahead is bounded by the longest token. States and transitions are made when
first met and kept, as in any lazy determinisation; the store is emptied when it is full, which costs time and nothing else.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

#: Where the public vocabularies are; a parameter of every operator that uses one.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: how this family of tokenizers splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MAX_STATES = 150_000
MAX_POOL = 1_500_000


def _byte_of_char() -> dict[str, int]:
    """Vocabulary files spell bytes as printable characters: those of Latin-1 stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Transducer:
    def __init__(self, vocab: dict[bytes, int], merges: Iterable[tuple[bytes, bytes]]):
        self.ids = vocab
        self.bytes_of = {i: t for t, i in vocab.items()}
        self.rank = {pair: r for r, pair in enumerate(merges)}
        self.starts = {t[:n] for t in vocab for n in range(1, len(t) + 1)}
        self.longest = max(map(len, vocab))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._own: dict[int, bool] = {}
        self._clear()

    @classmethod
    def load(cls, path: str = TOKENIZER) -> Transducer:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = _byte_of_char()
        spell = lambda s: bytes(byte[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # Entries whose spelling isn't made of the byte characters are special tokens; they never come out of merges.
        vocab = {spell(t): i for t, i in model["vocab"].items() if all(c in byte for c in t)}
        return cls(vocab, [(spell(a), spell(b)) for a, b in pairs])

    # The merges, applied to a short string: only ever to one or two tokens, to learn whether they may stand together.

    def _merge(self, text: bytes) -> list[bytes]:
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            pair = (parts[best], parts[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _stands(self, token: int) -> bool:
        found = self._own.get(token)
        if found is None:
            found = self._own[token] = len(self._merge(self.bytes_of[token])) == 1
        return found

    def _fits(self, left: int, right: int) -> bool:
        found = self._pairs.get((left, right))
        if found is None:
            a, b = self.bytes_of[left], self.bytes_of[right]
            found = self._pairs[left, right] = self._merge(a + b) == [a, b]
        return found

    # States: (window, places). window: the end of the input that begins a token. places[i]: residual tokens of the encoding of
    # the input up to i bytes into the window, with the last token emitted before them (-1 for none) in front.

    def _clear(self) -> None:
        self._number: dict[tuple, int] = {}
        self._state: list[tuple] = []
        self._next: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self._at((b"", ((-1,),)))

    def _at(self, state: tuple) -> int:
        n = self._number.get(state)
        if n is None:
            n = self._number[state] = len(self._state)
            self._state.append(state)
            self._next.append({})
        return n

    def _step(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        window, places = self._state[number]
        window += bytes((byte,))
        last = None
        for i in range(len(window)):
            token = self.ids.get(window[i:])
            if token is not None and self._stands(token) and (places[i][-1] < 0 or self._fits(places[i][-1], token)):
                last = (*places[i], token)
                break
        if last is None:
            raise ValueError("the vocabulary lacks single bytes")
        places = (*places, last)
        drop = 0
        while drop < len(window) and window[drop:] not in self.starts:
            drop += 1
        window, places = window[drop:], places[drop:]
        # Emit what all places share, but for the last token of each, which later pairs are tested against.
        common = min(map(len, places)) - 1
        first = places[0]
        keep = 0
        while keep < common and all(p[keep + 1] == first[keep + 1] for p in places):
            keep += 1
        out = first[1 : keep + 1]
        found = (self._at((window, tuple(p[keep:] for p in places))), out)
        self._next[number][byte] = found
        return found

    def run(self, word: bytes) -> list[int]:
        """The tokens of one word."""
        if len(self._state) > MAX_STATES:
            self._clear()
        out: list[int] = []
        state, table = 0, self._next
        for byte in word:
            found = table[state].get(byte)
            if found is None:
                found = self._step(state, byte)
                if len(self._state) > 2 * MAX_STATES:  # within one very long word: go on from this state alone
                    here = self._state[found[0]]
                    self._clear()
                    table = self._next
                    found = (self._at(here), found[1])
            state, emitted = found
            if emitted:
                out += emitted
        out += self._state[state][1][-1][1:]
        return out


#: The same split for texts of which the standard library's classes agree with the pattern's: ASCII, and what has neither numerals
#: other than digits nor separator controls. It takes less than half the time.
_ASCII = re.compile(r" ?[A-Za-z]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII).findall
_PLAIN = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_APART = regex.compile(r"[\p{No}\p{Nl}\x1c-\x1f]").search


def splitter(pattern: str = PATTERN):
    """A function from a text to its words, the parts that the pattern cuts it into; together they are the whole text."""
    full = regex.compile(pattern).findall
    if pattern != PATTERN:
        return full

    def words(text: str) -> list[str]:
        if text.isascii():
            return _ASCII(text)
        return full(text) if _APART(text) else _PLAIN(text)

    return words


class Encoder:
    """Texts to ids: splits by the pattern and keeps the tokens of words already met in one pool."""

    def __init__(self, transducer: Transducer, pattern: str = PATTERN):
        self.transducer = transducer
        self.words = splitter(pattern)
        self._reset()

    def _reset(self) -> None:
        self.begin, self.size, self.pool = array("q"), array("q"), array("i")
        begin, size, pool, run = self.begin, self.size, self.pool, self.transducer.run

        class Known(dict):
            def __missing__(self, word: str) -> int:
                ids = run(word.encode("utf-8"))
                n = self[word] = len(begin)
                begin.append(len(pool))
                size.append(len(ids))
                pool.extend(ids)
                return n

        self.known = Known()

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[str]], np.ndarray, np.ndarray]:
        """Of the texts, null ones being empty: all ids in one array, the offsets of each text in it, the words of each text, and of all
        words the number of tokens and the first token's position in the array."""
        if len(self.pool) > MAX_POOL:
            self._reset()
        split = [self.words(t) if t else [] for t in texts]
        get = self.known.__getitem__
        at = np.fromiter(map(get, chain.from_iterable(split)), np.int64)
        begin, size, pool = (np.array(x, dtype=t) for x, t in ((self.begin, np.int64), (self.size, np.int64), (self.pool, np.int32)))
        sizes = size[at]
        firsts = np.cumsum(sizes) - sizes
        ids = pool[np.repeat(begin[at] - firsts, sizes) + np.arange(int(sizes.sum()))]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        offsets = ends[np.concatenate(([0], np.cumsum(counts)))]
        return ids, offsets, split, sizes, firsts


@lru_cache(maxsize=2)
def encoder(path: str = TOKENIZER) -> Encoder:
    """One per Python worker: it is kept between tasks."""
    return Encoder(Transducer.load(path))


class Utf8Decoder:
    """Incremental UTF-8: a state machine over bytes that gives whole characters as soon as they are complete. State: bytes still
    missing, the code so far, and the range the next byte must lie in. A byte that fits nowhere gives U+FFFD."""

    def __init__(self) -> None:
        self.need, self.code, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.code, self.need, self.low, self.high = self.code << 6 | b & 0x3F, self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.code))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.code = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.code = 2, b & 0x0F
                self.low, self.high = (0xA0, 0xBF) if b == 0xE0 else (0x80, 0x9F) if b == 0xED else (0x80, 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.need, self.code = 3, b & 0x07
                self.low, self.high = (0x90, 0xBF) if b == 0xF0 else (0x80, 0x8F) if b == 0xF4 else (0x80, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def close(self) -> str:
        return "�" if self.need else ""


def decode_stream(transducer: Transducer, ids: Iterable[int]) -> Iterable[str]:
    """Text of a stream of ids, piece by piece; a character split between tokens comes with its last one."""
    machine = Utf8Decoder()
    for i in ids:
        if text := machine.feed(transducer.bytes_of[i]):
            yield text
    if rest := machine.close():
        yield rest
