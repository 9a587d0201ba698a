import random
import time
from collections import Counter, defaultdict

from ledgerloom.operators import balance as B


def records(spark, rows):
    return spark.createDataFrame(rows, "rid int, publisher string, document_type string, schema_name string, title string, load string")


def test_pack_splits_large_keys_and_spreads_load():
    placed, light, load = B.pack({1: 1000, 2: 400, 3: 10}, dict.fromkeys(range(16), 5), 8)
    assert len(placed[1]) >= len(placed[2]) > 1 and len(light) == 16
    assert max(load) <= 1.5 * sum(load) / 8
    assert all(0 <= t < 8 for ts in placed.values() for t in ts)


def test_every_key_above_its_share_is_split(spark):
    """400 equal keys on 20,000 tasks: fifty fair shares each."""
    counts = spark.range(400).selectExpr("cast(id AS string) AS key", "1000000 AS load")
    B.estimate(counts, ["key"], 8, loads=counts)
    began = time.perf_counter()
    packing = B.estimate(counts, ["key"], 20_000, loads=counts)
    B._placed(counts, ["key"], packing)
    took = time.perf_counter() - began
    shards = [r["_ll_tasks"] for r in packing.places.where("heavy").collect()]
    load = Counter()
    for tasks in shards:
        for t in tasks:
            load[t] += 1_000_000 / len(tasks)
    assert len(shards) == 400 and max(load.values()) <= 1.5 * 400_000_000 / 20_000
    assert took < 5


def test_profile_equals_brute_force_under_skew(spark):
    rng = random.Random(3)
    rows = []
    for rid in range(900):
        rows.append((rid, "big" if rid % 3 == 0 else rng.choice(["p1", "p2", None, ""]), rng.choice(["x", "y"]), "s", "t" * rng.randint(0, 5), "extra"))
    rows += rng.choices(rows, k=300)
    rng.shuffle(rows)
    got = {(r["field_name"], r["key_value"]): r for r in B.balanced_key_profile(records(spark, rows), "rid", ["publisher", "document_type", "schema_name"], ["title"]).collect()}
    once = {r[0]: r for r in rows}
    want, chars, given = Counter(), defaultdict(int), Counter()
    for r in once.values():
        for i, f in enumerate(("publisher", "document_type", "schema_name"), 1):
            want[f, r[i]] += 1
            chars[f, r[i]] += len(r[4])
    for r in rows:
        for i, f in enumerate(("publisher", "document_type", "schema_name"), 1):
            given[f, r[i]] += 1
    assert {k: r["n_records"] for k, r in got.items()} == dict(want)
    assert {k: r["total_chars"] for k, r in got.items()} == dict(chars)
    assert {k: r["rows_delivered"] for k, r in got.items()} == dict(given)
    assert all(r["n_total"] == 900 and r["is_major"] == (r["n_records"] * 25 >= 900) for r in got.values())


def test_copies_that_differ_count_under_each_value(spark):
    rows = [(1, "a", "x", "s", "", ""), (1, "b", "x", "s", "", ""), (None, "a", "x", "s", "", "")]
    got = {(r["field_name"], r["key_value"]): r["n_records"] for r in B.balanced_key_profile(records(spark, rows), "rid", ["publisher", "document_type"]).collect()}
    assert got == {("publisher", "a"): 1, ("publisher", "b"): 1, ("document_type", "x"): 1}


def test_empty_table(spark):
    assert B.balanced_key_profile(records(spark, []), "rid", ["publisher"]).collect() == []


def test_join_replicates_to_shards_and_keeps_nulls_and_clashes(spark):
    rows = [(i, "hot" if i % 2 else None if i % 10 == 0 else f"k{i % 7}", i) for i in range(500)]
    left = spark.createDataFrame(rows, "id int, key string, extra int")
    side = spark.createDataFrame([("hot", 1), (None, 2), ("k1", 3)], "key string, extra int")
    got = B.fragment_replicate_join(left, side, ["key"], ["id"], tasks=4).select("id", "key", "extra", "extra_side").collect()
    values = {"hot": 1, None: 2, "k1": 3}
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((i, e, values[k]) for i, k, e in rows if k in values)
    assert B.fragment_replicate_join(left, side, ["key"], ["id"], tasks=4, how="left").count() == 500


def test_lookup_with_and_without_hot_keys(spark):
    rows = [(i, "hot" if i % 2 else f"k{i % 5}" if i % 3 else None) for i in range(300)]
    left = spark.createDataFrame(rows, "id int, key string")
    unique = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, value int")
    for side in (unique, unique.where("key <> 'hot'"), unique.where("false")):
        for how in ("inner", "left"):
            plain = sorted(map(tuple, left.join(side, "key", how).select("id", "value").collect()), key=str)
            for tasks in (500,):
                assert sorted(map(tuple, B.lookup(left, side, ["key"], how, tasks=tasks).select("id", "value").collect()), key=str) == plain


def test_hot_keys_are_all_those_above_their_share(spark):
    counts = spark.createDataFrame([(f"k{i}", 10) for i in range(300)] + [("hot", 3000), (None, 10**6)], "key string, n long")
    hot = {r["_ll_hash"]: r["_ll_shards"] for r in B.hot_keys(counts, ["key"], 2400).collect()}
    assert len(hot) == 301 and max(hot.values()) == 2400  # fair share 2.5 rows: all keys, the hot one in as many shards as tasks
    assert len(B.hot_keys(counts, ["key"], 4).collect()) == 1
