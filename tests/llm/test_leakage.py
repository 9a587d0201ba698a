import random
from pathlib import Path

import numpy as np

from ledgerloom.llm import leakage as L

ROOT = Path(__file__).resolve().parents[2]


def brute(docs, items, least):
    out = {}
    for d, text in enumerate(docs):
        a = L.words_of(text)
        for i, item in enumerate(items):
            b = L.words_of(item)
            best = 0
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                        n += 1
                    best = max(best, n)
            if best >= least:
                out[d, i] = best
    return out


def test_suffix_array_orders_by_depth():
    rng = np.random.default_rng(1)
    for _ in range(30):
        ids = rng.integers(0, 4, rng.integers(1, 200))
        order = L.suffix_array(ids, 12).tolist()
        keys = [tuple(ids[p : p + 12]) for p in order]
        assert keys == sorted(keys) and sorted(order) == list(range(len(ids)))


def test_equals_brute_force(spark):
    rng = random.Random(7)
    pool = ["canal", "the", "water", "Révised", "x1", "licence"]
    items = [" ".join(rng.choice(pool) for _ in range(rng.randint(3, 25))) for _ in range(12)] + ["", None, "canal canal canal canal canal canal canal"]
    docs = [" ".join(rng.choice([*pool, "other"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    for d in range(0, 60, 4):
        words = (items[d % 12] or "").split()
        docs[d] += " new " + ", ".join(words[rng.randint(0, 3) :]).upper() + "! end"
    docs += [None, "", docs[0], docs[0], "canal " * 30]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(docs)], "doc_id long, text string, n_words string").repartition(3)
    tests = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = brute(docs, items, 5)
    for block in (10**6, 300):
        got = {(r["doc_id"], r["item_id"]): r["n_words"] for r in L.leaks(df, tests, 5, block).collect()}
        assert got == want
    found = L.leaks(df, tests, 5)
    for r in found.collect():
        a, b = L.words_of(docs[r["doc_id"]]), L.words_of(items[r["item_id"]])
        assert a[r["doc_word"] : r["doc_word"] + r["n_words"]] == b[r["item_word"] : r["item_word"] + r["n_words"]]
    left = {r["doc_id"] for r in L.remove_leaked(df, found).collect()}
    assert left == set(range(len(docs))) - {d for d, _ in want}


def test_shards_of_any_size(spark, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = [(i, f"a{i} {passage} b") for i in range(30)]
    df, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, passage), (2, passage)], "item_id long, text string")
    assert L.leaks(df, tests).count() == 60
    assert L.leaks(df, tests.where("false")).count() == 0 and L.leaks(df.where("false"), tests).count() == 0


def test_characters_that_fold_to_several_words(spark):
    """U+2474 to U+2481 are fourteen characters and fourteen words."""
    text = "".join(chr(c) for c in range(0x2474, 0x2482))
    docs = spark.createDataFrame([(1, text), (2, " ".join(str(n) for n in range(1, 15))), (3, text[:11])], "doc_id long, text string")
    found = L.leaks(docs, spark.createDataFrame([(7, text)], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"]) for r in found) == [(1, 14), (2, 14)]


def shared_footer(n_docs, n_items, pairs):
    """A footer that all documents and all items hold: documents, and how many matches there were and at most in a piece."""
    footer = " ".join(f"f{i}" for i in range(13))
    vocabulary = {}
    tests = L.TestSuffixes([(i, f"q{i} {footer}") for i in range(n_items)], 12, vocabulary)
    shard = L._Shard(vocabulary, 12)
    for d in range(n_docs):
        shard.add(d, f"d{d} {footer} end")

    class Block:
        value = tests

    total = most = 0
    before, L.PAIRS = L.PAIRS, pairs
    try:
        for _, found in shard.matches([Block()]):
            assert (found[2] == 13).all()
            total, most = total + len(found[0]), max(most, len(found[0]))
    finally:
        L.PAIRS = before
    return total, most


def test_pairs_of_a_shared_passage_come_in_pieces():
    total, most = shared_footer(3000, 240, L.PAIRS)
    assert total == 3000 * 240 and most <= L.PAIRS


def test_shared_passage_of_a_whole_shard_stays_small():
    import subprocess
    import sys

    code = "import resource; from tests.llm.test_leakage import shared_footer, L; before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; print(shared_footer(71_429, 240, L.PAIRS)[0], (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)"
    total, mb = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=str(ROOT)).stdout.split())
    assert total == 71_429 * 240 and mb < 400


def test_words():
    assert L.words_of("Café café, ＡＢＣ-12 ﬁne_x") == ["cafe", "cafe", "abc", "12", "fine", "x"]
