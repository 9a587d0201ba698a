"""Evaluation texts inside training text: suffix arrays over the training words, binary search of every test suffix.

Each task makes suffix arrays of its own shards of the training text and searches all suffixes of the test items in them, so
the corpus is never moved; only (document, item, length, place) rows of real matches leave a task. A run of `least` words shared with a test item
consists of words of test items alone, so each shard keeps the runs of such words that are long enough, and what lies between
them can't matter.

The test set may have any size: its items come to the driver block by block, each block's suffixes are broadcast on their own, and a task has one block in memory at a time, which it
searches in a shard whose words were folded and ordered once. What the driver keeps of all blocks is the vocabulary of the test set.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spread

#: Consecutive words that make a leak.
LEAST = 12
#: Words of one shard: some 200 MB of arrays while its suffix array is made.
SHARD_WORDS = 1_000_000
#: Characters of test text searched at a time: some 300 MB of suffixes.
BLOCK_CHARS = 8_000_000
#: Pairs of a place in the corpus and a suffix looked at together: some 50 MB.
PAIRS = 500_000

_ASCII_WORDS = re.compile(r"[a-z0-9]+").findall
_WORDS = re.compile(r"[^\W_]+").findall
_MARKS = regex.compile(r"\p{M}+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits after NFKD without combining marks, without letter case."""
    if not text:
        return []
    if text.isascii():
        return _ASCII_WORDS(text.lower())
    return _WORDS(_MARKS.sub("", unicodedata.normalize("NFKD", text)).casefold())


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ids (from 0 up) ordered by the next `depth` of them at least; past the end counts as smaller than any. By rank doubling,
    the first rank holding as many ids as 62 bits do."""
    n = len(ids)
    bits = max(1, int(ids.max(initial=0) + 1).bit_length())
    held = min(depth, 62 // bits)
    padded = np.concatenate((ids.astype(np.int64) + 1, np.zeros(depth, np.int64)))
    rank = np.zeros(n, np.int64)
    for i in range(held):
        rank = rank << bits | padded[i : i + n]
    while held < depth:
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
        ahead = np.concatenate((rank[held:], np.zeros(min(held, n), np.int64)))[:n]
        rank = rank * (n + 2) + ahead
        held *= 2
    return np.argsort(rank, kind="stable")


def _bounds(ids: np.ndarray, order: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query (a row of word ids) the range of the suffix array whose suffixes begin with it, by two binary searches at once."""
    width = queries.shape[1]
    padded = np.concatenate((ids.astype(np.int64), np.full(width, -1, np.int64)))

    def search(after: bool) -> np.ndarray:
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
        while (open_ := low < high).any():
            rows = np.flatnonzero(open_)
            middle = (low[rows] + high[rows]) // 2
            text = padded[order[middle][:, None] + np.arange(width)]
            differ = text != queries[rows]
            at = differ.argmax(1)
            some = differ[np.arange(len(rows)), at]
            less = np.where(some, text[np.arange(len(rows)), at] < queries[rows, at], after)
            low[rows[less]], high[rows[~less]] = middle[less] + 1, middle[~less]
        return low

    return search(False), search(True)


class TestSuffixes:
    """Test items as word ids, with every suffix of at least `least` words as a query. The vocabulary is that of the whole test set, and grows."""

    __test__ = False

    def __init__(self, items: list[tuple[int, str | None]], least: int, vocabulary: dict[str, int]):
        self.least = least
        self.item_ids, runs = [], []
        for item_id, text in items:
            words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]  # 0 is no test word
            if len(words) >= least:
                self.item_ids.append(item_id)
                runs.append(np.array(words, np.int64))
        self.text = np.concatenate([np.concatenate((r, [-2])) for r in runs]) if runs else np.zeros(0, np.int64)
        lens = np.array([len(r) for r in runs], np.int64)
        begins = np.cumsum(lens + 1) - lens - 1
        self.item = np.repeat(np.arange(len(runs)), np.maximum(lens - least + 1, 0))
        inside = np.arange(len(self.item)) - np.repeat(np.cumsum(lens - least + 1) - (lens - least + 1), lens - least + 1) if runs else np.zeros(0, np.int64)
        self.begin = begins[self.item] + inside if runs else inside
        self.offset = inside
        queries = self.text[self.begin[:, None] + np.arange(least)] if runs else np.zeros((0, least), np.int64)
        self.queries, of_query = np.unique(queries, axis=0, return_inverse=True) if runs else (queries, inside)
        of_query = of_query.reshape(-1)
        self.same = np.argsort(of_query, kind="stable")
        self.same_begin = np.searchsorted(of_query[self.same], np.arange(len(self.queries)))
        self.same_end = np.searchsorted(of_query[self.same], np.arange(len(self.queries)), "right")


def _longest(pairs: list[np.ndarray]) -> list[np.ndarray]:
    """Of (document, item, words, place, offset) the longest of each document and item, the first place of equally long ones; ordered by document and item."""
    document, item, length, place, offset = pairs
    order = np.lexsort((offset, place, -length, item, document))
    d, i = document[order], item[order]
    best = order[np.concatenate(([True], (d[1:] != d[:-1]) | (i[1:] != i[:-1])))] if len(order) else order
    return [x[best] for x in pairs]


def search_shard(tests: TestSuffixes, ids: np.ndarray, order: np.ndarray, document: np.ndarray, place: np.ndarray, pairs: int = PAIRS) -> Iterator[list[np.ndarray]]:
    """Longest verbatim match of each (document, item): arrays document, item, words, place in the document, place in the item, in pieces. ids: word ids, 0
    where a run ends; order: their suffix array; document, place: of each word its document and its number in it. A place of the corpus begins at most one query, but a query may stand in many
    items; their pairs are made `pairs` at a time, and of the last document of a piece only its best matches are carried on."""
    low, high = _bounds(ids, order, tests.queries)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return
    n_text = (high - low)[hit]
    text_at = order[np.repeat(low[hit] - (np.cumsum(n_text) - n_text), n_text) + np.arange(int(n_text.sum()))]
    query = np.repeat(hit, n_text)
    by_place = np.argsort(text_at, kind="stable")  # documents follow one another
    text_at, query = text_at[by_place], query[by_place]
    n_same = (tests.same_end - tests.same_begin)[query]
    ends = np.cumsum(n_same)
    held: list[np.ndarray] | None = None
    start = 0
    while start < len(query):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + pairs, "right")))
        found = _matches(tests, ids, text_at[start:stop], query[start:stop], n_same[start:stop])
        rows = [document[found[0]], tests.item[found[1]], found[2], place[found[0]], tests.offset[found[1]]]
        if held is not None:
            rows = [np.concatenate((h, r)) for h, r in zip(held, rows, strict=True)]
        best, last, start = _longest(rows), document[text_at[stop - 1]], stop
        whole = best[0] != last if start < len(query) else np.ones(len(best[0]), bool)
        held = [x[~whole] for x in best]
        if whole.any():
            yield [x[whole] for x in best]


def _matches(tests: TestSuffixes, ids: np.ndarray, text_at: np.ndarray, query: np.ndarray, n_same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the corpus and suffixes of items that match from there on, with the number of words, but for those that could begin a word earlier, since the earlier match holds them."""
    suffix = tests.same[np.repeat(tests.same_begin[query] - (np.cumsum(n_same) - n_same), n_same) + np.arange(int(n_same.sum()))]
    text_at = np.repeat(text_at, n_same)
    before_t = np.where(text_at > 0, ids[text_at - 1], 0)
    before_s = np.where(tests.begin[suffix] > 0, tests.text[tests.begin[suffix] - 1], -2)
    first = before_t != before_s
    text_at, suffix = text_at[first], suffix[first]
    length = np.full(len(text_at), tests.least, np.int64)
    going = np.arange(len(text_at))
    while len(going):
        t, s = text_at[going] + length[going], tests.begin[suffix[going]] + length[going]
        ok = (t < len(ids)) & (s < len(tests.text))
        ok[ok] = ids[t[ok]] == tests.text[s[ok]]
        going = going[ok]
        length[going] += 1
    return text_at, suffix, length


class _Shard:
    """Words of documents, gathered until there are enough for a suffix array."""

    def __init__(self, vocabulary: dict[str, int], least: int):
        self.vocabulary, self.least, self.parts, self.size = vocabulary, least, [], 0

    def add(self, number: int, text: str | None) -> None:
        get = self.vocabulary.get
        words = words_of(text)
        if len(words) < self.least:
            return
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        known = np.concatenate(([0], (ids != 0).view(np.int8), [0]))
        edges = np.flatnonzero(np.diff(known))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= self.least:
                self.parts.append((number, a, ids[a:b]))
                self.size += b - a + 1

    def matches(self, blocks: list) -> Iterator[tuple[TestSuffixes, list[np.ndarray]]]:
        """The matches of all blocks of test items (broadcasts, of which one is in memory at a time), in pieces."""
        if not self.parts:
            return
        ids = np.concatenate([np.concatenate((p[2], [0])) for p in self.parts])
        lens = np.array([len(p[2]) + 1 for p in self.parts])
        document = np.repeat(np.array([p[0] for p in self.parts]), lens)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(lens) - lens - np.array([p[1] for p in self.parts]), lens)
        self.parts, self.size = [], 0
        order = suffix_array(ids, self.least)
        for block in blocks:
            tests = block.value
            if len(tests.queries):
                for found in search_shard(tests, ids, order, document, place):
                    yield tests, found
            if len(blocks) > 1 and hasattr(block, "_value"):
                del block._value  # read again from the executor's disk when it is its turn


def leaks(documents: DataFrame, items: DataFrame, least: int = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, n_words, doc_word, item_word: for each row of documents (doc_id, text) and each item (item_id, text) with `least` or more
    consecutive words in common, the longest such run, where it begins in both. Repeated rows are reported each on its own, so are repeated items.
    Null, empty and short texts on either side give nothing. Text lengths are compared after folding only: one character may fold to several words."""
    spark = documents.sparkSession
    kinds = documents.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_words int, doc_word int, item_word int"
    sized = items.where(F.col("text").isNotNull()).select("item_id", "text")
    chars = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-chars // block_chars))
    vocabulary: dict[str, int] = {}
    blocks = []
    for block in range(n_blocks):
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()  # about block_chars characters
        blocks.append(spark.sparkContext.broadcast(TestSuffixes([(r["item_id"], r["text"]) for r in rows], least, vocabulary)))
    words = spark.sparkContext.broadcast(vocabulary)
    return spread(documents.select("doc_id", "text").where(F.col("text").isNotNull())).mapInArrow(_searcher(blocks, words, least, kinds), schema)


def _searcher(blocks: list, words_broadcast, least: int, kinds: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "n_words", "doc_word", "item_word"]
        arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        vocabulary = words_broadcast.value
        if not vocabulary:
            for _ in batches:
                pass
            return
        shard, doc_ids = _Shard(vocabulary, least), []

        def search():
            nonlocal doc_ids
            ids, doc_ids = pa.array(doc_ids, arrow[kinds[0]]), []
            for tests, (document, item, length, at, offset) in shard.matches(blocks):
                columns = [ids.take(pa.array(document)), pa.array(tests.item_ids, arrow[kinds[1]]).take(pa.array(item))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(x.astype(np.int32)) for x in (length, at, offset)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                shard.add(len(doc_ids), text)
                doc_ids.append(doc_id)
                if shard.size >= SHARD_WORDS:
                    yield from search()
        yield from search()

    return run


def remove_leaked(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents without those that hold a test passage. Rows with a null doc_id stay: no leak can be tied to them."""
    return documents.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
