"""Retrieval systems as plans over one set of questions: what each finds, how well, and whether a repeated run gives the same."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import evaluate, index, projection, scan_rank
from ledgerloom.session import durable

#: The systems under comparison, by name: role, retrieval, and whether edges, trust signals, inferred text and the answerability classifier are used; single_source narrows the inventory.
SYSTEMS = {
    "proposal-graph": ("proposal", "typed", True, True, True, True, False),
    "baseline-exact-known-item": ("baseline", "exact", False, False, False, False, False),
    "baseline-flat-metadata-fts": ("baseline", "flat", False, False, False, False, False),
    "baseline-typed-metadata-fts": ("baseline", "native", False, True, False, False, False),
    "ablation-no-graph": ("ablation", "typed", False, True, True, True, False),
    "ablation-no-provenance-lifecycle": ("ablation", "typed", True, False, True, True, False),
    "ablation-single-source-inventory": ("ablation", "typed", True, True, True, True, True),
    "ablation-source-native-only": ("ablation", "native", True, True, False, True, False),
    "control-expanded-jsonld": ("serialization_control", "typed", True, True, True, True, False),
    "control-expanded-yamlld": ("serialization_control", "typed", True, True, True, True, False),
}
#: Points of a result for its rank, a quoted title, stated evidence and a published lifecycle.
#: The inventory of a system that knows a single source.
SINGLE_SOURCE = "record_shard = 'data/records-0.json'"
TITLE_QUOTED, EVIDENCE, PUBLISHED = 10_000, 5, 2


def abstains(wording: Column) -> Column:
    """Whether a question can't be answered from metadata by its wording: it asks for a guarantee without the facts of a case, or says itself that there is not enough to answer safely. False for null."""
    text = F.lower(wording)
    holds = lambda *words: reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])
    unsure = holds("guarantee") & holds("no case facts", "without the facts", "personal outcome")
    return F.coalesce(unsure | (holds("not enough to answer") & holds("safely")), F.lit(False))


def exact_hits(questions: DataFrame, rows: DataFrame, limit: int = 10) -> DataFrame:
    """(query_id, ordinal, rank): records whose title a question quotes, or whose address it names."""
    quoted = F.array_union(F.regexp_extract_all(F.lower("text"), F.lit('["“]([^"”]+)["”]'), F.lit(1)), F.regexp_extract_all("text", F.lit(r"(https?://[^\s)>\"]+)"), F.lit(1)))
    asked = questions.select("query_id", F.explode(quoted).alias("name")).distinct()
    names = rows.select(F.col("rid").alias("ordinal"), F.explode(F.array("title_key", "url")).alias("name"))
    found = asked.join(names, "name").select("query_id", "ordinal").distinct()
    return index.ranked(found.withColumn("score", F.lit(0)), limit)


#: What each retrieval scores by BM25: how many of LAYERS, one after another, are its text.
LAYERS = ("flat_tokens", "native_tokens", "typed_tokens")
DEPTH = {"flat": 1, "native": 2, "typed": 3}


def searchable(rows: DataFrame) -> DataFrame:
    """Add what the systems read of each record: the tokens that each layer of its text adds, and whether the single source has it."""
    added = {"flat_tokens": ["title", "description"], "native_tokens": ["publisher", "document_type", "schema_name", "lifecycle"], "typed_tokens": [F.array_join(F.from_json("tags", "array<string>"), " "), "inferred_text"]}
    layers = [index.token_runs_of(F.concat_ws(" ", *added[layer])).alias(layer) for layer in LAYERS]
    return rows.select("*", *layers, F.coalesce(F.expr(SINGLE_SOURCE), F.lit(False)).alias("single"))


def retrieved(names: Sequence[str], questions: DataFrame, rows: DataFrame, limit: int = 50) -> DataFrame:
    """(retrieval, single, query_id, ordinal, rank): the best 50 of each retrieval that the systems use, made once for all that share it, in one scan of the records. rows: see searchable."""
    used = list(dict.fromkeys((SYSTEMS[n][1], SYSTEMS[n][6]) for n in names))
    scored = [x for x in used if x[0] != "exact"]
    named = lambda r, s: [F.lit(r).alias("retrieval"), F.lit(s).alias("single")]
    found = [exact_hits(questions, rows.where("single") if s else rows, limit).select(*named(r, s), "query_id", "ordinal", "rank") for r, s in used if r == "exact"]
    if scored:
        best = scan_rank.best_records(rows.withColumn("ordinal", F.col("rid")), LAYERS, "single", questions, [(DEPTH[r], s) for r, s in scored], limit)
        of = F.array(*[F.struct(*named(r, s)) for r, s in scored])
        found.append(best.select(F.element_at(of, F.col("variant") + 1).alias("_r"), "query_id", "ordinal", "rank").select("_r.*", "query_id", "ordinal", "rank"))
    return durable(reduce(DataFrame.unionByName, found), "retrieved")


def run_systems(names: Sequence[str], questions: DataFrame, rows: DataFrame, edges: DataFrame, seeds: int = 5, top: int = 10) -> DataFrame:
    """(query_id, system, ordinal, score, rank) of several systems. questions: (query_id, text); rows: see searchable; edges: (source, target) ordinals. All systems are one plan, and systems with the same flags are run once."""
    same: dict[tuple, list[str]] = {}
    for name in names:
        same.setdefault(SYSTEMS[name][1:2] + SYSTEMS[name][2:4] + SYSTEMS[name][5:], []).append(name)
    runs = F.array(*[F.struct(F.lit(r).alias("retrieval"), F.lit(s).alias("single"), F.lit(g).alias("graph"), F.lit(t).alias("trust"), F.lit(c).alias("classifier"), F.lit(i).alias("run")) for i, (r, g, t, c, s) in enumerate(same)])
    shown = retrieved(names, questions, rows).join(rows.select(F.col("rid").alias("ordinal"), "title", "evidence_sha256", "lifecycle"), "ordinal", "left").join(questions, "query_id")
    quoted = F.when(F.contains(F.lower("text"), F.concat(F.lit('"'), F.lower("title"), F.lit('"'))), TITLE_QUOTED).otherwise(0)
    trusted = F.when(F.col("evidence_sha256") != "", EVIDENCE).otherwise(0) + F.when(F.col("lifecycle") == "published", PUBLISHED).otherwise(0)
    each = shown.select("retrieval", "single", "query_id", "ordinal", "rank", quoted.alias("quoted"), trusted.alias("trusted"), abstains(F.col("text")).alias("abstains"))
    each = each.withColumn("_s", F.explode(F.filter(runs, lambda x: (x["retrieval"] == F.col("retrieval")) & (x["single"] == F.col("single"))))).where(~(F.col("_s.classifier") & F.col("abstains")))
    ranked = each.select("query_id", F.col("_s.run").alias("run"), "ordinal", "rank", F.col("_s.graph").alias("linked"), (F.col("quoted") + F.when(F.col("_s.trust"), F.col("trusted")).otherwise(0)).alias("bonus"))
    found = projection.staged_search(ranked, edges, seeds, top, by=("query_id", "run"))
    listed = F.array(*[F.array(*map(F.lit, own)) for own in same.values()])
    return found.select("query_id", F.explode(F.element_at(listed, F.col("run") + 1)).alias("system"), "ordinal", "score", "rank")


def outcomes(questions: DataFrame, results: DataFrame, gold: DataFrame, systems: Sequence[str] = tuple(SYSTEMS), k: int = 10) -> DataFrame:
    """One row per question and system: the question's columns, n_results, abstained, recall, mrr, ndcg. gold: (query_id, item, grade). Systems without a result for a question have zeros."""
    each = evaluate.systems_matrix(questions, {s: {"classifier": SYSTEMS[s][5]} for s in systems})
    key = lambda q, s: F.concat_ws("\0", q.cast("string"), s)
    wanted = gold.join(F.broadcast(results.sparkSession.createDataFrame([(s,) for s in systems], "system string"))).select(key(F.col("query_id"), F.col("system")).alias("query_id"), "item", "grade")  # ten systems
    scores = evaluate.ranking_metrics(results.select(key(F.col("query_id"), F.col("system")).alias("query_id"), F.col("ordinal").alias("item"), "rank"), wanted, k)
    n = results.groupBy(key(F.col("query_id"), F.col("system")).alias("query_id")).agg(F.count(F.lit(1)).alias("n_results"))
    both = scores.join(n, "query_id", "left").withColumnRenamed("query_id", "_key")
    abstained = F.col("classifier") & abstains(F.col("text"))
    return each.withColumn("_key", key(F.col("query_id"), F.col("system"))).join(both, "_key", "left").select(
        *questions.columns, "system", F.coalesce("n_results", F.lit(0)).alias("n_results"), abstained.cast("int").alias("abstained"), *[F.coalesce(m, F.lit(0.0)).alias(m) for m in ("recall", "mrr", "ndcg")]
    )


def means(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(system, n, mean of each measure, rounded to 6 places); nulls don't count."""
    return rows.groupBy("system").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 6).alias(f"mean_{m}") for m in measures])


def usage_faults(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, total) of usage columns whose total isn't zero, as a run without models and network has."""
    totals = rows.agg(*[F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    return totals.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("total")) for c in columns])).alias("u")).select("u.column", "u.total").where("total <> 0")


def replay_faults(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that one of two runs has more often than the other, with the run and how many more; empty if and only if both are equal as multisets."""
    columns = first.columns
    count = lambda df, sign: df.select(*columns).groupBy(*columns).agg(F.count(F.lit(sign)).alias("n")).withColumn("n", F.col("n") * sign)
    more = count(first, 1).unionByName(count(second, -1)).groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")
    return more.select(*columns, F.when(F.col("n") > 0, "first").otherwise("second").alias("run"), F.abs("n").alias("n_more"))
