import random
from datetime import datetime, timedelta

import numpy as np

from ledgerloom.operators import snapshots as S

SCHEMA = "source_table string, side int, key array<string>, content string, version timestamp, row_id long, extra string"


def brute(rows):
    best, first = {}, {}
    for t, side, key, content, version, row_id, _ in rows:
        k = (t, tuple(key), side)
        rank = (version or datetime.min, row_id)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, content)
        first[k] = min(first.get(k, row_id), row_id)
    out = set()
    for t, key in {(t, key) for t, key, _ in best}:
        old, new = best.get((t, key, 0)), best.get((t, key, 1))
        if old is None:
            out.add((t, first[t, key, 1], "added"))
        elif new is None:
            out.add((t, first[t, key, 0], "removed"))
        elif old[1] != new[1]:
            out.add((t, first[t, key, 1], "changed"))
    return out


def test_equals_brute_force_with_hot_key(spark):
    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        url = "hot" if i % 3 == 0 else rng.choice([f"u{rng.randint(0, 300)}", None, ""])
        rows.append((rng.choice("ab"), rng.randint(0, 1), [url, rng.choice(["en", None])], rng.choice(["x", "y"]), rng.choice([None, start + timedelta(days=rng.randint(0, 3))]), i, "z"))
    df = spark.createDataFrame(rows, SCHEMA)
    for bucket_rows in (1_000_000, 50):
        delta = S.snapshot_delta(df, bucket_rows)
        assert {(r["source_table"], r["row_id"], r["delta_class"]) for r in delta.collect()} == brute(rows)
    values = S.differing_values(df, delta).collect()
    assert len(values) == len(brute(rows)) and all(r["old_content"] != r["new_content"] for r in values)


def test_empty_sides(spark):
    assert S.snapshot_delta(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([("a", 1, ["u", "en"], "", None, 7, "")], SCHEMA)
    assert [tuple(r)[3:] for r in S.snapshot_delta(one).collect()] == [(7, "added")]


def test_equal_first_hashes_are_told_apart():
    k1 = np.array([5, 5, 5, 9])
    at = S._match(k1, np.array([1, 2, 3, 4]), np.array([5, 5, 9, 7]), np.array([3, 8, 4, 0]))
    assert at.tolist() == [2, -1, 3, -1]


def test_folding(spark):
    row = spark.createDataFrame([("HTTPs://Www.x.Y//A-b ", " SHA256: AB cd\n")], "u string, f string").select(S.folded_url("u"), S.folded_fingerprint("f")).first()
    assert tuple(row) == ("httpswwwxyab", "abcd")
