"""The retrieval systems: the scan of blocks against BM25 by joins, and how much work their queries start."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import index, projection, scan_rank
from ledgerloom.plans import catalogue

#: Jobs that the query may start: a few a step, not some for each system.
JOBS = 60
WORDS = ["canal", "quarry", "lock", "weir", "barge", "ferry", "common", "café", "tow.path", "the"]
VARIANTS = [(1, False), (2, False), (3, False), (3, True), (1, True)]
RECORD = (
    "rid int, title string, title_key string, url string, description string, publisher string, document_type string, schema_name string, lifecycle string, language string, jurisdiction string,"
    " evidence_sha256 string, tags string, inferred_text string, record_shard string"
)


def _rows(rng, n=400):
    text = lambda most: None if rng.random() < 0.05 else " ".join(rng.choices(WORDS, [1, 2, 3, 4, 5, 6, 60, 2, 2, 9], k=rng.randint(0, most)))
    return [(i * 7 % n, text(6), text(4), text(3), i % 3 == 0) for i in range(n)]


def _asked(rng):
    asked = [(q, " ".join(rng.sample(WORDS, rng.randint(1, 5)))) for q in range(60)]
    return [*asked, (60, "common"), (61, "unknown words"), (62, ""), (63, None), (64, "Canal canal CAFE unknown")]


@pytest.mark.parametrize("n", [400, 40, 0])
def test_scan_finds_what_bm25_finds(spark, n):
    rng = random.Random(n)
    rows, asked = _rows(rng, n), spark.createDataFrame(_asked(rng), "query_id long, text string")
    df = spark.createDataFrame(rows, "ordinal int, a string, b string, c string, single boolean").repartition(5)
    docs = df.select("ordinal", *[index.token_runs_of(F.concat_ws(" ", c)).alias(c) for c in "abc"], "single")
    got = scan_rank.best_records(docs, list("abc"), "single", asked, VARIANTS, 7).collect()
    for i, (layers, narrow) in enumerate(VARIANTS):
        counts = index.term_counts(df.where("single") if narrow else df, "ordinal", F.concat_ws(" ", *"abc"[:layers])).localCheckpoint()
        size = counts.select("ordinal", "len").distinct().agg(F.count(F.lit(1)), F.avg("len")).first()
        want = index.bm25(asked, counts, counts.groupBy("token").agg(F.count(F.lit(1)).alias("df")), size[0], size[1] or 1.0, 7).collect()
        assert sorted((r["query_id"], r["rank"], r["ordinal"], r["score"]) for r in got if r["variant"] == i) == sorted((r["query_id"], r["rank"], r["ordinal"], r["score"]) for r in want)


def test_scan_is_the_same_for_any_blocks(monkeypatch):
    """One block or many, in any order of the records: the best stay the same."""
    rng = random.Random(3)
    rows = [(i, [w for w in rng.choices(WORDS, k=rng.randint(0, 6))], rng.choice([True, False])) for i in range(500)]
    asked = scan_rank.Asked([(q, rng.sample(WORDS, rng.randint(0, 4))) for q in range(40)])

    def best(rows, first, most):
        monkeypatch.setattr(scan_rank, "FIRST", first)
        monkeypatch.setattr(scan_rank, "MOST", most)
        batches = [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part, strict=True), (pa.int64(), pa.list_(pa.string()), pa.bool_()), strict=True)], names=["ordinal", "a", "n"]) for part in (rows[:123], rows[123:])]
        sums = np.zeros((2, len(asked.vocabulary) + 2), np.int64)
        for b in scan_rank._statistics(SimpleNamespace(value=asked), [(1, False), (1, True)])(iter(batches)):
            for v, place, n in zip(*b.to_pydict().values(), strict=True):
                sums[v, place] += n
        plans = [scan_rank.Plan(asked, 1, bool(v), int(s[-2]), int(s[-1]), s[:-2]) for v, s in enumerate(sums)]
        found = scan_rank._searcher(SimpleNamespace(value=asked), SimpleNamespace(value=plans), 9, 1.2, 0.75)(iter(batches))
        return [b.to_pydict() for b in found]

    want = best(rows, 1000, 1000)
    assert want[0]["scores"]
    for first, most in ((1, 4), (16, 100), (300, 300)):
        assert best(rng.sample(rows, len(rows)), first, most) == want


def test_rounding_is_that_of_spark(spark):
    values = [1.2345675, 0.0000005, 2.5e-7, 12.0000015, 3.4999995, 0.1234564999, 7.0]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 6)).collect()]
    assert scan_rank._rounded(np.array(values)).tolist() == want


def test_short_lists_look_for_linked_records(spark):
    """Only lists of fewer than `top` results take linked records in, each list by its own flag."""
    ranked = spark.createDataFrame([(q, run, o, o, run == 0) for q, n in ((1, 2), (2, 4)) for run in (0, 1) for o in range(1, n + 1)], "query_id int, run int, ordinal int, rank int, linked boolean")
    edges = spark.createDataFrame([(1, 50), (40, 1), (1, 2), (3, 60)], "source int, target int")
    got = sorted((r["query_id"], r["run"], r["rank"], r["ordinal"], r["score"]) for r in projection.staged_search(ranked, edges, 2, 4, by=("query_id", "run")).collect())
    own = lambda q, run, n: [(q, run, o, o, 10_000 - 100 * o) for o in range(1, n + 1)]
    assert got == [*own(1, 0, 2), (1, 0, 3, 40, 9_300), (1, 0, 4, 50, 9_300), *own(1, 1, 2), *own(2, 0, 4), *own(2, 1, 4)]


def _records(spark, folder):
    rng, words = random.Random(1), [f"word{chr(97 + i)}" for i in range(20)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(i + 1, t := f"Title {text(3)}", t.lower(), f"https://x/{i}", text(6), rng.choice(["Board a", "Board b", None]), "guide", "s", rng.choice(["published", "withdrawn"]), "en", "uk", rng.choice(["", "e"]), '["en"]', text(2), f"data/records-{i % 3}.json") for i in range(300)]
    spark.createDataFrame([*rows, *rows[:5]], RECORD).coalesce(1).write.parquet(f"{folder}/records.parquet")
    return str(folder), rows


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_outcomes_are_one_plan_for_all_systems(spark, tmp_path):
    folder, rows = _records(spark, tmp_path)
    got, jobs = _jobs(spark, "outcomes", lambda: catalogue.QUERIES["system_outcomes"](spark, folder).collect())
    assert len(got) == 30 and {r["query_id"] for r in got} == {100, 200, 300}
    exact = [r for r in got if r["system"] == "baseline-exact-known-item"]
    assert {(r["recall"], r["mrr"], r["n_results"]) for r in exact} == {(1.0, 1.0, 1)}
    by = {s: sorted(tuple(r[c] for c in r.asDict() if c != "system") for r in got if r["system"] == s) for s in {r["system"] for r in got}}
    assert by["proposal-graph"] == by["control-expanded-jsonld"] == by["control-expanded-yamlld"] and by["proposal-graph"]
    assert jobs <= JOBS, jobs


def test_slices_start_no_plan_for_each_system(spark, tmp_path):
    folder, rows = _records(spark, tmp_path)
    got, jobs = _jobs(spark, "slices", lambda: catalogue.QUERIES["system_slices"](spark, folder).collect())
    cell = {(r["dimension"], r["value"], r["system"]): r for r in got}
    asked = [r for r in rows if r[0] % 100 == 0]
    wide = {"all": lambda r: "all", "language": lambda r: r[9], "document_type": lambda r: r[6], "schema_name": lambda r: r[7], "lifecycle": lambda r: r[8], "jurisdiction": lambda r: r[10], "publisher": lambda r: r[5]}
    for dimension, of in wide.items():
        values = [of(r) for r in asked]
        assert {k[1]: r["n"] for k, r in cell.items() if k[0] == dimension and k[2] == "proposal-graph"} == {v: values.count(v) for v in values}
        assert all(cell[dimension, v, "baseline-exact-known-item"]["avg_recall"] == 1.0 for v in values)
    assert len({k[2] for k in cell}) == 10 and cell["all", "all", "proposal-graph"]["avg_n_results"] == 10.0
    assert jobs <= JOBS, jobs
