import json
import random
import re
import unicodedata
from collections import Counter, defaultdict

from ledgerloom.functions.json_tools import canonical
from ledgerloom.functions.text import STOP_WORDS
from ledgerloom.llm import frequency, ledger


def fold_tokens(text):
    low = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode().lower()
    return {t for t in (m.strip("._-") for m in re.findall(r"[a-z0-9][a-z0-9._-]*", low)) if len(t) >= 2 and t not in STOP_WORDS}


def test_frequencies_equal_sets(spark):
    rng = random.Random(8)
    spell = ["water", "Water", "WáTéR", "ｗａｔｅｒ", " water ", "(water", "water_", "and", "--", "", None, "a", "two words", "café"] + [f"t{i}" for i in range(80)]
    rows = [(i, "water" if i % 3 == 0 else rng.choice(spell), rng.choice([1, 2, 3, None]), rng.randint(0, 60) if i % 97 else None, "x") for i in range(1500)]
    rows += rng.choices(rows, k=400)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "posting_id long, token string, tf int, rid int, salt string").repartition(5)
    occurrences, records = Counter(), defaultdict(set)
    for p, token, tf, rid, _ in {r[0]: r for r in rows}.values():
        for t in fold_tokens(token):
            occurrences[t] += tf or 0
            records[t].add(rid)
    n = len({r[3] for r in rows})
    got = {r["token"]: (r["occurrences"], r["records"], r["mark"]) for r in frequency.term_frequencies(df).collect()}
    mark = lambda k: "rare" if k <= 2 else "common" if 5 * k >= n else None
    assert got == {t: (occurrences[t], len(s), mark(len(s))) for t, s in records.items()}
    assert frequency.term_frequencies(df.where("false")).count() == 0


def test_runs_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_frequencies_equal_sets(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_canonical_form():
    same = ['{"a": "Big Canal!", "b": [1, {"x": null}]}', '{ "b":[1,{"x":null}],\n"a":"big-canal" }']
    assert len({canonical(t) for t in same}) == 1
    other = ['{"a": "Big Canal!", "b": [{"x": null}, 1]}', '{"A": "Big Canal!", "b": [1, {"x": null}]}', '{"a": "Big Canal!", "b": ["1", {"x": null}]}', '{"a": "Big Canal!", "b": [1, {"x": false}]}', '{"a": "Big Canals", "b": [1, {"x": null}]}', "{damaged", "", None, '"damaged"']
    assert len({canonical(t) for t in [same[0], *other]}) == 1 + len(other)


SCHEMA = "source_table string, id long, fields array<string>, json array<string>, k1 string"


def data(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if i % 3 == 0 else rng.randint(1, n // 4)
        body = {"title": f"Canal rules {k}", "n": k, "tags": [None, True, {"q": "A b"}]}
        items = list(body.items())
        rng.shuffle(items)
        text = json.dumps(dict(items), indent=rng.choice([None, 1]))
        if rng.random() < 0.5:
            text = text.replace("Canal rules", rng.choice(["CANAL   RULES", "canal-rules!", "“Canal” rules"]))
        url = rng.choice([f"https://X.y/{k}", f"HTTPS://x.y//{k}/"])
        rows.append((rng.choice(["a", "b"]), i, [url, None if k % 5 == 0 else "en"], [text], "z"))
    rng.shuffle(rows)
    return rows


def brute(rows):
    groups = defaultdict(list)
    for t, i, fields, (text,), _ in rows:
        body = json.loads(text)
        title = re.sub(r"[\W_]+", "", body["title"]).lower()
        groups[t, re.sub(r"[\W_]+", "", fields[0]).lower(), fields[1], title, body["n"]].append(i)
    return {(k[0], min(v), len(v)) for k, v in groups.items()}, {(k[0], min(v), i) for k, v in groups.items() for i in v if i != min(v)}


def test_ledger_by_batches_equals_brute_force(spark):
    rows = data(600, 9)
    own = ledger.DuplicateLedger(spark, bucket_rows=40)
    keys = ledger.canonical_keys(spark.createDataFrame(rows, SCHEMA))
    for n, part in enumerate((rows[:100], rows[100:110], rows[110:])):
        assert own.update(ledger.canonical_keys(spark.createDataFrame(part, SCHEMA)), f"batch_{n}")
    groups, copies = brute(rows)
    assert {(r["source_table"], r["keep_id"], r["copies"]) for r in own.table().collect()} == groups
    assert {tuple(r) for r in ledger.copies(keys, own).collect()} == copies
    assert [v[1] for v in own._versions()] == [2, 2, 8] and len(own._latest()) == 8
    # Another session goes on from the folder; a batch that is there already, given again, changes nothing.
    again = ledger.DuplicateLedger(spark, own.path, bucket_rows=40)
    assert not again.update(keys, "batch_1")
    assert {(r["source_table"], r["keep_id"], r["copies"]) for r in again.table().collect()} == groups


def test_small_batch_leaves_other_buckets_alone(spark):
    own = ledger.DuplicateLedger(spark, bucket_rows=10)
    some = spark.range(200).selectExpr("'t' AS source_table", "id", "id AS k1", "id AS k2")
    own.update(some, "all")
    before = own._latest()
    own.update(some.where("k1 = 5").selectExpr("source_table", "id + 1000 AS id", "k1", "k2"), "one")
    after = own._latest()
    assert len(before) == 32 and [b for b in before if before[b] != after[b]] == [5]
    assert sorted((r["keep_id"], r["copies"]) for r in own.table().where("copies > 1").collect()) == [(5, 2)] and own.table().count() == 200


def test_update_that_failed_before_its_commit_does_not_count(spark):
    own = ledger.DuplicateLedger(spark)
    some = spark.range(20).selectExpr("'t' AS source_table", "id", "id AS k1", "id AS k2")
    own.update(some, "a")
    some.write.parquet(f"{own.path}/v-000001-1-b")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    own._hadoop()[1].delete(Path(f"{own.path}/v-000001-1-b/_SUCCESS"), False)
    assert own.table().count() == 20 and own.update(some, "b") and {r["copies"] for r in own.table().collect()} == {2}


def test_ledger_of_nothing(spark):
    own = ledger.DuplicateLedger(spark)
    assert own.table().count() == 0
    own.update(ledger.canonical_keys(spark.createDataFrame([], SCHEMA)), "none")
    assert own.table().count() == 0
    odd = [("a", 1, [None], [None], ""), ("a", 2, [""], [None], ""), ("a", 3, [None], [None], ""), ("a", 4, [None], ["{x"], ""), ("a", 5, None, None, "")]
    own.update(ledger.canonical_keys(spark.createDataFrame(odd, SCHEMA)), "odd")
    assert sorted((r["keep_id"], r["copies"]) for r in own.table().collect()) == [(1, 2), (2, 1), (4, 1), (5, 1)]
