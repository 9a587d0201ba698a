"""Queries of the operators on training text, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import STOP_WORDS, TOKEN
from ledgerloom.llm import encode, frequency, leakage, ledger
from ledgerloom.session import durable, table


def _ledger(spark: SparkSession, folder: str) -> tuple[DataFrame, ledger.DuplicateLedger]:
    """Each table is a batch of the ledger. Keys are computed once and kept in the shared folder."""
    own, whole = ledger.DuplicateLedger(spark), None
    for name, rows in ledger.duplicate_sources(spark, folder).items():
        keys = durable(ledger.canonical_keys(rows), "canonical-keys")
        own.update(keys, name)
        whole = keys if whole is None else whole.unionByName(keys)
    return whole, own


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.copies(*_ledger(spark, folder)).distinct()


def p3_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: its earliest row and its number of copies."""
    return _ledger(spark, folder)[1].table().select("source_table", "keep_id", "copies")


def p5_terms(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.term_frequencies(table(spark, folder, "be"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_terms(spark, folder).where(F.col("mark").isNotNull()).select("token", "mark")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode(table(spark, folder, "documents"))


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_tokens and whether decoding gives the text again, for every document."""
    return encode.round_trip(table(spark, folder, "documents"))


def p9_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_leaks(spark, folder).select("doc_id", "item_id").distinct()


def p9_clean(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and number of characters of the documents left when all leaked ones are removed."""
    documents = table(spark, folder, "documents")
    return leakage.remove_leaked(documents.select("doc_id", "n_chars"), p9_found(spark, folder))


def p10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode.split_oversized(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return encode.split_oversized(table(spark, folder, "documents"), with_text=False).where(F.col("piece_no") == 0).select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p3_found, p3_records, p5_found, p5_terms, p8_ids, p8_decoded, p9_found, p9_leaks, p9_clean, p10_found, p10_pieces)}

def _fold(column: str) -> str:
    """NFKD without marks, as far as these data need it: full-width letters and digits are the compatibility characters that strip_accents leaves."""
    wide = [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]
    return f"strip_accents(translate({column}, '{''.join(map(chr, wide))}', '{''.join(chr(c - 0xFEE0) for c in wide)}'))"


def _grams(key: str, name: str) -> str:
    words = f"SELECT {key}, regexp_extract_all(lower({_fold('text')}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {name} WHERE text IS NOT NULL"
    return f"(SELECT {key}, i AS at, list_slice(w, CAST(i AS BIGINT), CAST(i + 11 AS BIGINT)) AS g FROM ({words}), range(1, 20000) r(i) WHERE i + 11 <= len(w))"


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_TERMS = f"""
WITH once AS (SELECT posting_id, any_value(token) AS token, any_value(rid) AS rid, any_value(tf) AS tf FROM be GROUP BY posting_id),
 runs AS (SELECT posting_id, rid, tf, regexp_extract_all(lower(regexp_replace({_fold("token")}, '[^\\x00-\\x7F]', '', 'g')), '{TOKEN}') AS r FROM once),
 rows AS (SELECT posting_id, rid, tf, unnest(list_distinct(list_transform(r, lambda t: regexp_replace(t, '^[._-]+|[._-]+$', '', 'g')))) AS token FROM runs),
 n AS (SELECT count(DISTINCT rid) AS n_records FROM be),
 g AS (SELECT token, CAST(sum(coalesce(tf, 0)) AS BIGINT) AS occurrences, count(DISTINCT rid) AS records FROM rows WHERE length(token) >= 2 AND token NOT IN ({_STOP}) GROUP BY token),
 t AS (SELECT *, CASE WHEN records <= 2 THEN 'rare' WHEN records * 5 >= n_records THEN 'common' END AS mark FROM g, n)
"""
_LEAKS = f"WITH d AS {_grams('doc_id', 'documents')}, e AS {_grams('item_id', 'eval_items')}, m AS (SELECT doc_id, item_id, d.at AS da, e.at AS ea FROM d JOIN e USING (g)) "
#: DuckDB can't fold within JSON, run a transducer or decode one; those queries are tested against brute force and two libraries.
SQL: dict[str, str] = {
    "p5_terms": _TERMS + "SELECT token, occurrences, records, n_records, mark FROM t",
    "p5_found": _TERMS + "SELECT token, mark FROM t WHERE mark IS NOT NULL",
    "p9_found": _LEAKS + "SELECT DISTINCT doc_id, item_id FROM m",
    # Runs of places that go on together in both texts; of the longest the first in the document, then in the item.
    "p9_leaks": _LEAKS + """, r AS (SELECT *, da - row_number() OVER (PARTITION BY doc_id, item_id, da - ea ORDER BY da) AS run FROM m),
 s AS (SELECT doc_id, item_id, count(*) + 11 AS n, min(da) - 1 AS dw, min(ea) - 1 AS ew FROM r GROUP BY doc_id, item_id, da - ea, run)
 SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_words, CAST(dw AS INTEGER) AS doc_word, CAST(ew AS INTEGER) AS item_word FROM s QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, dw, ew) = 1""",
    "p9_clean": _LEAKS + "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM m)",
}
