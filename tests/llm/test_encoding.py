import base64
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import bpe, encode

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    own = tokenizers.Tokenizer.from_file(bpe.TOKENIZER)
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids


HARD = ["", " ", "a" * 3000, " " * 2000, "ab" * 1500, "é" * 900, "<|endoftext|>x", "\x00\x01", "　 x", "\x85a", "\x1c b", "it's we'll 'S '", "½ ² Ⅷ x1", "你好 世界。", "👩‍👩‍👧 á", "_a__b_", "\n\n \n\tx", "http://" + "x" * 300]


def test_hard_texts(reference):
    ids, offsets, *_ = bpe.encoder().encode_batch([*HARD, None])
    for i, text in enumerate(HARD):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == reference(text), repr(text[:20])
    assert offsets[-1] == offsets[-2]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="etaoin shrdlu'T.,-_12\n", max_size=80))
def test_any_text(reference, text):
    own = bpe.encoder()
    ids, *_ = own.encode_batch([text])
    assert ids.tolist() == reference(text)
    assert "".join(bpe.decode_stream(own.transducer, ids.tolist())) == text


def test_full_stores_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_POOL", 10)
    own = bpe.Encoder(bpe.Transducer.load())
    texts = ["International harbour registration " * 3, "x" * 400 + "yz" * 100, "Canal lighting"]
    for text in texts * 2:
        ids, *_ = own.encode_batch([text])
        assert ids.tolist() == reference(text)


def test_small_merges_by_brute_force():
    rng = random.Random(4)
    vocab = {bytes((b,)): i for i, b in enumerate(b"abc")}
    merges = []
    while len(vocab) < 20:
        a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
        if a + b not in vocab:
            vocab[a + b] = len(vocab)
            merges.append((a, b))
    own = bpe.Transducer(vocab, merges)
    for _ in range(3000):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30)))
        assert own.run(word) == [vocab[t] for t in own._merge(word)], word


def test_utf8_machine_equals_codec():
    rng = random.Random(5)
    for _ in range(500):
        data = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x99, 0x82, 0xED, 0xA0, 0xFF]) for _ in range(12))
        machine = bpe.Utf8Decoder()
        got = "".join(machine.feed(data[i : i + 1]) for i in range(len(data))) + machine.close()
        assert got == data.decode("utf-8", "replace")


def test_query_shape(spark, reference):
    rows = [(1, "A canal.", "x"), (2, None, "x"), (3, "", "x"), (None, "b", "x"), (1, "A canal.", "x"), (4, "long " * 20_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"] or 0), list(r["ids"])) for r in encode.encode(df).collect())
    assert got == sorted((d or 0, reference(t) if t else []) for d, t, _ in rows)
    assert all(r["same"] for r in encode.round_trip(df).collect())
    back = encode.decode(encode.encode(df)).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t, _ in rows)
    assert encode.encode(df.where("false")).count() == 0


def test_second_library_agrees():
    tiktoken = pytest.importorskip("tiktoken")
    path = bpe.TOKENIZER.replace(".json", ".tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in HARD:
        assert bpe.encoder().encode_batch([text])[0].tolist() == other.encode_ordinary(text)
