import random

import numpy as np

from ledgerloom.llm import bpe, encode


def sequential(natural, word, n, limit, overlap):
    """Greedy cuts one after another."""
    ends, start = [], 0
    while True:
        reach = start + limit
        if reach >= n:
            return ends + [n]
        floor = start + overlap if ends else overlap
        inside = [p for p in range(floor + 1, reach + 1) if natural[p]] or [p for p in range(floor + 1, reach + 1) if word[p]] or [reach]
        ends.append(inside[-1])
        start = ends[-1] - overlap


def test_doubling_equals_sequential_cuts():
    rng = random.Random(6)
    for _ in range(200):
        sizes = [rng.randint(21, 400) for _ in range(rng.randint(1, 5))]
        limit, overlap = 20, rng.randint(0, 6)
        natural, word, begin, end, base = [], [], [], [], []
        want, at = [], 0
        for n in sizes:
            a = [False] + [rng.random() < 0.05 for _ in range(n - 1)] + [False]
            b = [x or rng.random() < 0.3 for x in a]
            base.append(at)
            natural += a
            word += b
            begin += [at] * (n + 1)
            end += [at + n] * (n + 1)
            want.append([at + e for e in sequential(a, b, n, limit, overlap)])
            at += n + 1
        succ = encode.successors(np.array(natural), np.array(word), np.array(begin), np.array(end), limit, overlap)
        base = np.array(base)
        chains, ends = encode.greedy_chain(succ, succ[base + overlap], base + np.array(sizes))
        assert [sorted(ends[chains == i].tolist()) for i in range(len(sizes))] == want


def pieces(spark, texts, limit=64, overlap=8):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, piece_no string")
    return encode.split_oversized(df, limit, overlap).orderBy("doc_id", "piece_no").collect()


def test_pieces(spark):
    texts = [None, "", "short", "One two three. " * 60, "# Head\n\nText of it here.\n\n" * 40, "x" * 2000, "字" * 500, "para graph\n\n" * 100, "a b " * 200, "One two three. " * 60]
    got = pieces(spark, texts)
    ids, offsets, *_ = bpe.encoder().encode_batch(texts)
    big = {i for i in range(len(texts)) if offsets[i + 1] - offsets[i] > 64}
    assert {r["doc_id"] for r in got} == big and {3, 4, 5, 6, 7, 8, 9} <= big
    for d in big:
        own = [r for r in got if r["doc_id"] == d]
        assert own[0]["token_from"] == 0 and own[-1]["token_to"] == own[0]["doc_tokens"] == offsets[d + 1] - offsets[d]
        for i, r in enumerate(own):
            assert r["piece_no"] == i and 0 < r["n_tokens"] <= 64 and r["n_tokens"] == r["token_to"] - r["token_from"]
            part = ids[offsets[d] + r["token_from"] : offsets[d] + r["token_to"]].tolist()
            assert r["text"] == b"".join(bpe.encoder().transducer.bytes_of[t] for t in part).decode("utf-8", "replace")
            if i:
                assert r["token_from"] == own[i - 1]["token_to"] - 8
    kinds = lambda d: {r["boundary"] for r in got if r["doc_id"] == d and r["token_to"] != r["doc_tokens"]}
    assert kinds(3) == {"sentence"} and kinds(4) <= {"heading", "paragraph"} and kinds(5) == {"token"} and kinds(7) == {"paragraph"} and kinds(8) == {"word"}


def test_exactly_at_the_limit_and_bad_parameters(spark):
    text = " a" * 64
    assert pieces(spark, [text]) == [] and len(pieces(spark, [text + " a"])) == 2
    for limit, overlap in ((10, 10), (10, -1)):
        try:
            encode.split_oversized(spark.createDataFrame([(1, "x")], "doc_id long, text string"), limit, overlap)
        except ValueError:
            continue
        raise AssertionError("accepted")
