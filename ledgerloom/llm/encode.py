"""Corpus encoding and splitting of oversized items, both on the transducer of bpe.py."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import TOKENIZER, Encoder, encoder
from ledgerloom.session import spread

#: Characters encoded at a time: bounds a worker's memory whatever the size of the Arrow batches.
CHUNK_CHARS = 4_000_000


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= CHUNK_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def encode(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, ids: one row per row of documents (doc_id, text). Special tokens are not added, and their spelling in a text is ordinary
    text. An empty and a null text have an empty list. Rows with a null doc_id are kept. Nothing is shuffled: a text of any length
    is encoded in time linear in its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _chunks(texts):
                ids, offsets, *_ = own.encode_batch(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), lists], names=["doc_id", "ids"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return spread(documents.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, text of encoded (doc_id, ids): the streaming inverse. Null and empty lists have an empty text."""
    from ledgerloom.llm.bpe import decode_stream

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = encoder(path).transducer
        for batch in batches:
            texts = ["".join(decode_stream(transducer, ids or [])) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, same: whether the stream of a text's ids decodes to the text (a null one to an empty text)."""
    from ledgerloom.llm.bpe import decode_stream

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _chunks(texts):
                ids, offsets, *_ = own.encode_batch(texts[a:b])
                lists = (ids[s:e].tolist() for s, e in zip(offsets[:-1], offsets[1:], strict=True))
                same = ["".join(decode_stream(own.transducer, x)) == (t or "") for x, t in zip(lists, texts[a:b], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(offsets[1:] - offsets[:-1]), pa.array(same)], names=["doc_id", "n_tokens", "same"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return spread(documents.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, same boolean")


# Splitting. A piece ends at a boundary and the next one begins `overlap` tokens before that end. So the ends alone make the chain: from
# an end e the next may be as far as e - overlap + limit. Every token position gets its farthest legal successor; squaring that table gives
# the successors 2, 4, 8, ... pieces on, and with them all ends of all texts of a batch at once, in as many steps as the longest chain has bits.

#: Boundaries in falling strength, by the text before and after them.
_BOUNDARIES = [
    ("heading", re.compile(r"\n[ \t]*(?=#{1,6}[ \t]|\d+(?:\.\d+)*[.)]?[ \t]+\S[^\n]{0,80}\n)")),
    ("paragraph", re.compile(r"\n[ \t\r]*\n+")),
    ("line", re.compile(r"\n(?![ \t\r]*\n)")),  # not within the empty lines between paragraphs
    ("sentence", re.compile(r"[.!?…][\"'”’)\]]*\s+|[。！？؟۔]\s*")),
]
NAMES = ["end", "heading", "paragraph", "line", "sentence", "word", "token"]


def _strengths(text: str, starts: np.ndarray) -> np.ndarray:
    """For each word start in characters, the strongest boundary there: 1 heading ... 4 sentence, 5 none but the word's start. A boundary
    belongs to the first word that starts at the end of its text, or whose white space that text ends in."""
    found = np.full(len(starts), 5, np.int8)
    for level in range(len(_BOUNDARIES), 0, -1):
        ends = np.fromiter((m.end() for m in _BOUNDARIES[level - 1][1].finditer(text)), np.int64)
        if not len(ends):
            continue
        # The word holding the last character of the boundary may hold the following text too (" The" after ". "): cut before it.
        at = np.searchsorted(starts, ends, "right") - 1
        exact = starts[at] == ends
        spaced = np.fromiter((text[starts[i] : e].isspace() for i, e in zip(at, ends, strict=True)), bool, len(at))
        at = at[(exact | spaced) & (ends < len(text))]
        found[at] = level
    return found


def successors(natural: np.ndarray, word: np.ndarray, begin: np.ndarray, end: np.ndarray, limit: int, overlap: int) -> np.ndarray:
    """Farthest legal successor of every position of a batch. natural, word: whether a position is a natural boundary, or a word's start. begin and
    end: of each position, where its text begins and ends. A text's end is legal from wherever it is in reach and its own successor."""
    positions = np.arange(len(natural))
    reach = np.minimum(positions + limit - overlap, end)
    last = lambda flags: np.maximum.accumulate(np.where(flags, positions, -1))[reach]
    by_natural, by_word = last(natural), last(word)
    found = np.where(by_natural > positions, by_natural, np.where(by_word > positions, by_word, reach))
    return np.where(reach >= end, end, found)


def greedy_chain(succ: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions on the chains from first[i] to stop[i], by pointer doubling: (chain number, position), in order."""
    chains, at, table = np.arange(len(first)), first.copy(), succ
    while True:
        ahead = table[at]
        alive = (at != stop[chains]) & (ahead != at)
        if not alive.any():
            break
        chains, at = np.concatenate((chains, chains[alive])), np.concatenate((at, ahead[alive]))
        pairs = np.unique(np.stack((chains, at), 1), axis=0)  # chains that met their stop give it again
        chains, at = pairs[:, 0], pairs[:, 1]
        table = table[table]
        if (np.bincount(chains[at == stop[chains]], minlength=len(first)) > 0).all() and _complete(chains, at, succ, stop):
            break
    return chains, at


def _complete(chains: np.ndarray, at: np.ndarray, succ: np.ndarray, stop: np.ndarray) -> bool:
    """Whether each chain goes from position to position by single successors."""
    inner = at != stop[chains]
    following = succ[at[inner]]
    return bool((following == at[np.flatnonzero(inner) + 1]).all())


PIECES = "doc_id {}, piece_no int, token_from int, token_to int, n_tokens int, boundary string, char_from int, char_to int, text string, doc_tokens int"


def _split_texts(own: Encoder, texts: list[str], limit: int, overlap: int, with_text: bool):
    """Rows of the pieces of those texts that have more than limit tokens: (index, piece_no, from, to, boundary, chars, text, tokens)."""
    ids, offsets, split, sizes, firsts = own.encode_batch(texts)
    counts = np.diff(offsets)
    big = np.flatnonzero(counts > limit)
    if not len(big):
        return
    words_at = np.concatenate(([0], np.cumsum([len(w) for w in split])))
    total = int((counts[big] + 1).sum())  # each text has its positions 0..n
    natural, word = np.zeros(total, bool), np.zeros(total, bool)
    level = np.full(total, 6, np.int8)
    begin, end = np.empty(total, np.int64), np.empty(total, np.int64)
    base, char_starts = [], []
    here = 0
    for d in big:
        n = int(counts[d])
        lens = np.fromiter(map(len, split[d]), np.int64)
        starts = np.cumsum(lens) - lens
        tokens = firsts[words_at[d] : words_at[d + 1]] - offsets[d]
        strength = _strengths(texts[d], starts)
        level[here + tokens] = strength
        word[here + tokens] = True
        natural[here + tokens] = strength < 5
        natural[here] = False
        level[here + n] = 0
        begin[here : here + n + 1], end[here : here + n + 1] = here, here + n
        base.append(here)
        char_starts.append((tokens, starts))
        here += n + 1
    base = np.array(base)
    succ = successors(natural, word, begin, end, limit, overlap)
    # The first piece has no overlap to spend: it may reach `limit` from the start, as from a cut `overlap` tokens in.
    chains, ends = greedy_chain(succ, succ[base + overlap], base + counts[big])
    order = np.lexsort((ends, chains))
    chains, ends = chains[order], ends[order] - base[chains[order]]
    fresh = np.concatenate(([True], chains[1:] != chains[:-1]))
    number = np.arange(len(chains)) - np.maximum.accumulate(np.where(fresh, np.arange(len(chains)), 0))
    froms = np.where(fresh, 0, np.concatenate(([0], ends[:-1])) - overlap)
    for c, no, a, b in zip(chains.tolist(), number.tolist(), froms.tolist(), ends.tolist(), strict=True):
        d = big[c]
        tokens, starts = char_starts[c]
        char_at = lambda p, t=tokens, s=starts, d=d: len(texts[d]) if p >= counts[d] else int(s[np.searchsorted(t, p, "right") - 1])
        piece = None
        if with_text:
            piece = b"".join(own.transducer.bytes_of[i] for i in ids[offsets[d] + a : offsets[d] + b].tolist()).decode("utf-8", "replace")
        yield int(d), no, a, b, NAMES[level[base[c] + b]], char_at(a), char_at(b), piece, int(counts[d])


def split_oversized(documents: DataFrame, limit: int = 1024, overlap: int = 64, path: str = TOKENIZER, with_text: bool = True) -> DataFrame:
    """Pieces of the documents (doc_id, text) of more than `limit` tokens: doc_id, piece_no from 0, the range of the document's tokens,
    what the piece ends at (heading, paragraph, line, sentence, word, token, end), the characters of the words it begins and ends in, its text, and the
    document's tokens. A piece has at most `limit` tokens and shares `overlap` with the next. It ends at the farthest
    heading, paragraph, line or sentence in reach, else at the farthest word, else inside a word. Text of a piece that a token range cuts inside a
    character has U+FFFD there; its token range is exact.

    Documents of at most `limit` tokens, empty and null texts give no rows. Repeated rows are split each on its own. A text of
    at most `limit` bytes can't have more tokens, so such texts never reach Python.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = PIECES.format(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts, doc_ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for a, b in _chunks(texts):
                rows = list(_split_texts(own, texts[a:b], limit, overlap, with_text))
                if rows:
                    at, no, begin, end, boundary, char_a, char_b, text, tokens = zip(*rows, strict=True)
                    i32 = lambda x: pa.array(x, pa.int32())
                    n = [e - s for s, e in zip(begin, end, strict=True)]
                    columns = [doc_ids.take(pa.array([a + i for i in at])), i32(no), i32(begin), i32(end), i32(n), pa.array(boundary), i32(char_a), i32(char_b), pa.array(text, pa.string()), i32(tokens)]
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in PIECES.split(", ")])

    return spread(documents.select("doc_id", "text").where(F.octet_length("text") > limit)).mapInArrow(run, schema)
