"""Inverted index and search: weighted postings, capped lists, prefixes, ranked keyword search, suggestions, BM25.

Queries are data: a table of (query_id, text) is answered by joins with the postings, so one query and a million of them have
the same plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.identity import search_shard
from ledgerloom.functions.text import token_runs, tokens

#: Weight and mask bit of each field.
FIELDS = {
    "title": (16, 1), "publisher": (8, 2), "description": (5, 4), "record_type": (4, 8), "schema": (4, 16),
    "tags": (3, 32), "url": (2, 64), "language": (3, 128), "lifecycle": (4, 256),
}
POSTING_CAP = 2000
PREFIX_LENGTHS = (3, 12)
PREFIX_CAP = 100
TITLE_BONUS = 4


def field_tokens(rows: DataFrame, ordinal: str, fields: Mapping[str, Column]) -> DataFrame:
    """(ordinal, field, token), each token once per field."""
    texts = F.array(*[F.struct(F.lit(name).alias("field"), column.alias("text")) for name, column in fields.items()])
    parts = rows.select(F.col(ordinal).alias("ordinal"), F.explode(texts).alias("f")).select("ordinal", "f.field", "f.text")
    return parts.where(F.col("text") != "").select("ordinal", "field", F.explode(tokens(F.col("text"))).alias("token"))


def postings(rows: DataFrame, ordinal: str, fields: Mapping[str, Column]) -> DataFrame:
    """(token, ordinal, score, mask, shard): score is the sum of the weights of the fields that hold the token, mask their bits. All tokens of a record
    come from its one row, so they are combined within it: building the index shuffles nothing. Ordinals must be unique."""
    none = F.array().cast("array<string>")
    held = rows.select(F.col(ordinal).alias("ordinal"), *[F.coalesce(tokens(c), none).alias(f"_{f}") for f, c in fields.items()])

    def combined(token: Column) -> Column:
        score = mask = F.lit(0)
        for f in fields:
            weight, bit = FIELDS[f]
            inside = F.array_contains(F.col(f"_{f}"), token)
            score, mask = score + F.when(inside, weight).otherwise(0), mask + F.when(inside, bit).otherwise(0)
        return F.struct(token.alias("token"), score.alias("score"), mask.alias("mask"))

    every = F.array_distinct(F.concat(*[F.col(f"_{f}") for f in fields]))
    found = held.select("ordinal", F.explode(F.transform(every, combined)).alias("p"))
    return found.select("p.token", "ordinal", "p.score", "p.mask", search_shard(F.col("p.token")).alias("shard"))


def lexicon(found: DataFrame) -> DataFrame:
    """(token, df), never capped."""
    return found.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def capped(found: DataFrame, cap: int = POSTING_CAP) -> DataFrame:
    """The cap best postings of each token by (score desc, ordinal), with the rank. Of each of 16 parts of a token the cap best are taken first, so a token that all records hold brings at most
    16 times cap rows together."""
    best = [F.desc("score"), F.col("ordinal")]
    part = F.pmod(F.xxhash64("ordinal"), F.lit(16))
    found = found.withColumn("_part", part).withColumn("_rank", F.row_number().over(Window.partitionBy("token", "_part").orderBy(*best))).where(F.col("_rank") <= cap).drop("_part", "_rank")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("token").orderBy(*best))).where(F.col("rank") <= cap)


def prefixes(terms: DataFrame, cap: int = PREFIX_CAP) -> DataFrame:
    """(prefix, token, df, rank): completions of all prefixes of 3 to 12 letters, the cap most frequent of each."""
    low, high = PREFIX_LENGTHS
    size = F.least(F.length("token"), F.lit(high))
    cut = terms.where(F.length("token") >= low).select("token", "df", F.explode(F.transform(F.sequence(F.lit(low), size), lambda n: F.left(F.col("token"), n))).alias("prefix"))
    return cut.withColumn("rank", F.row_number().over(Window.partitionBy("prefix").orderBy(F.desc("df"), "token"))).where(F.col("rank") <= cap)


def query_tokens(queries: DataFrame) -> DataFrame:
    """(query_id, token, n_tokens) of (query_id, text)."""
    return queries.withColumn("_t", tokens(F.col("text"))).select("query_id", F.explode("_t").alias("token"), F.size("_t").alias("n_tokens"))


def search(queries: DataFrame, lists: DataFrame, terms: DataFrame, limit: int = 20, cap: int = POSTING_CAP) -> DataFrame:
    """Ranked keyword search: (query_id, ordinal, search_score, matched_tokens, n_tokens, rank).

    lists are capped postings, terms the uncapped lexicon. A token is complete if its df is within the cap. Candidates are the
    records that hold all complete tokens; if there are none and several complete tokens, those that hold any; if no token is complete, those of the
    rarest token's list (of equally rare ones the first by name). Tokens the lexicon lacks are ignored. The score sums all tokens, the title bit adding
    TITLE_BONUS. Ties go to the smaller ordinal. A query without known tokens gives no rows.
    """
    known = query_tokens(queries).join(terms, "token")
    per_query = Window.partitionBy("query_id")
    known = known.withColumn("complete", F.col("df") <= cap).withColumn("n_complete", F.sum(F.col("complete").cast("int")).over(per_query))
    known = known.withColumn("rarest", F.min(F.struct("df", "token")).over(per_query)["token"])
    counted = F.when(F.col("n_complete") > 0, F.col("complete")).otherwise(F.col("token") == F.col("rarest"))
    hits = known.withColumn("counted", counted).join(lists.select("token", "ordinal", "score", "mask"), "token")
    scored = hits.groupBy("query_id", "ordinal").agg(
        F.sum(F.col("score") + F.when(F.col("mask").bitwiseAND(FIELDS["title"][1]) > 0, TITLE_BONUS).otherwise(0)).alias("search_score"),
        F.count(F.lit(1)).alias("matched_tokens"), F.sum(F.col("counted").cast("int")).alias("held"),
        F.max(F.greatest("n_complete", F.lit(1))).alias("wanted"), F.max("n_tokens").alias("n_tokens"),
    )
    scored = scored.where(F.col("held") > 0).withColumn("whole", F.col("held") == F.col("wanted"))
    scored = scored.withColumn("some_whole", F.max("whole").over(per_query)).where(F.col("whole") | ~F.col("some_whole"))
    ranked = scored.withColumn("rank", F.row_number().over(per_query.orderBy(F.desc("search_score"), "ordinal"))).where(F.col("rank") <= limit)
    return ranked.select("query_id", "ordinal", "search_score", "matched_tokens", "n_tokens", "rank")


def answerability(queries: DataFrame, results: DataFrame) -> DataFrame:
    """(query_id, n_results, answerability) of every query."""
    counted = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    n_tokens = queries.select("query_id", F.coalesce(F.size(tokens(F.col("text"))), F.lit(0)).alias("n_tokens"))
    state = F.when(F.col("n_tokens") <= 0, "no_supported_query").when(F.col("n").isNull(), "no_supported_result").otherwise("metadata_discovery")
    return n_tokens.join(counted, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).alias("n_results"), state.alias("answerability"))


def suggest(words: DataFrame, completions: DataFrame, top: int = 3, longest: int = 8) -> DataFrame:
    """(word, token, df, rank): for each word the completions of its longest available prefix of at most `longest` letters, the word itself first."""
    low = PREFIX_LENGTHS[0]
    size = F.least(F.length("word"), F.lit(longest))
    tries = words.where(F.length("word") >= low).select("word", F.explode(F.transform(F.sequence(F.lit(low), size), lambda n: F.left(F.col("word"), n))).alias("prefix"))
    found = tries.join(completions.select("prefix", "token", "df"), "prefix")
    found = found.withColumn("longest", F.max(F.length("prefix")).over(Window.partitionBy("word"))).where(F.length("prefix") == F.col("longest"))
    order = Window.partitionBy("word").orderBy(F.desc(F.col("token") == F.col("word")), F.desc("df"), "token")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("word", "token", "df", "rank")


def expand_missing(query: DataFrame, terms: DataFrame, completions: DataFrame, top: int = 3) -> DataFrame:
    """(query_id, token, member): each query token stands for itself if the lexicon has it, else for its suggestions (a group whose members are alternatives)."""
    known = query.join(terms.select("token"), "token", "left_semi").select("query_id", "token", F.col("token").alias("member"))
    missing = query.join(terms.select("token"), "token", "left_anti")
    offered = suggest(missing.select(F.col("token").alias("word")).distinct(), completions, top).select(F.col("word").alias("token"), F.col("token").alias("member"))
    return known.unionByName(missing.select("query_id", "token").join(offered, "token").select("query_id", "token", "member"))


def grouped_search(groups: DataFrame, lists: DataFrame, limit: int = 20) -> DataFrame:
    """(query_id, ordinal, score, rank): records that hold at least one member of every group, scored by the best member of each."""
    hits = groups.join(lists.select(F.col("token").alias("member"), "ordinal", "score"), "member").groupBy("query_id", "ordinal", "token").agg(F.max("score").alias("score"))
    wanted = groups.groupBy("query_id").agg(F.countDistinct("token").alias("wanted"))
    whole = hits.groupBy("query_id", "ordinal").agg(F.count(F.lit(1)).alias("held"), F.sum("score").alias("score")).join(wanted, "query_id").where("held = wanted")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "ordinal"))
    return whole.withColumn("rank", rank).where(F.col("rank") <= limit).select("query_id", "ordinal", "score", "rank")


def term_counts(rows: DataFrame, ordinal: str, text: Column) -> DataFrame:
    """(token, ordinal, tf, len): how often each row holds each of its tokens, and its number of tokens. Made within each row: nothing is moved. Ordinals must be unique."""
    held = rows.select(F.col(ordinal).alias("ordinal"), token_runs_of(text).alias("ts")).where(F.size("ts") > 0)
    count = lambda t: F.struct(t.alias("token"), F.size(F.filter("ts", lambda x: x == t)).alias("tf"))
    each = held.select("ordinal", F.size("ts").alias("len"), F.explode(F.transform(F.array_distinct("ts"), count)).alias("t"))
    return each.select("t.token", "ordinal", "t.tf", "len")


def bm25(queries: DataFrame, counts: DataFrame, df: DataFrame, n: int, average: float, limit: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, ordinal, score, rank) by BM25, idf floored at 1e-6; larger is better, rounded to 6 places before ranking, ties by ordinal. counts: see term_counts; df: (token, df); n rows of `average` tokens."""
    idf = F.greatest(F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    asked = query_tokens(queries).select("query_id", "token").join(df, "token")
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / average))
    hits = asked.join(counts, "token").groupBy("query_id", "ordinal").agg(F.round(F.sum(part), 6).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "ordinal"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= limit)


def ranked(hits: DataFrame, limit: int) -> DataFrame:
    """(query_id, ordinal, score, rank) of hits, the best `limit` of each query, ties by ordinal."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "ordinal"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= limit)


def token_runs_of(text: Column) -> Column:
    from ledgerloom.functions.text import folded

    return token_runs(folded(text))


POSTING_SCHEMA = T.StructType([T.StructField("token", T.StringType()), T.StructField("ordinal", T.LongType()), T.StructField("score", T.IntegerType()), T.StructField("mask", T.IntegerType())])
