"""Text functions: tokens, shards, slugs, phrases. Column expressions unless NFKD is needed, for which Spark has no built-in."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The stop words of the search tokeniser.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "into", "is", "it", "of", "on", "or", "the", "to", "with"]
#: The stop words of the lexical terms of questions.
LEXICAL_STOP_WORDS = (
    "about after again against also and answer are authoritative before being canonical could does every find from give gov govuk have identify into item need official only record result should source that the their"
    " then this through uk version what when where which with would"
).split()
TOKEN = r"[a-z0-9][a-z0-9._-]*"


def ascii_fold(text: str) -> str:
    """NFKD, then non-ASCII dropped, then lower case."""
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii").lower()


@F.pandas_udf(T.StringType())
def _fold_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else ascii_fold(t))


def folded(column: Column) -> Column:
    """ascii_fold of a column. Only texts with a character outside ASCII are folded in Python; all others reach it as null."""
    plain = column.rlike(r"^[\x00-\x7f]*$")
    return F.when(plain, F.lower(column)).otherwise(_fold_udf(F.when(~plain, column)))


def token_runs(low: Column) -> Column:
    """All tokens of a folded text, in order, repeats kept."""
    runs = F.regexp_extract_all(low, F.lit(f"({TOKEN})"), 1)
    trimmed = F.transform(runs, lambda t: F.regexp_replace(t, r"^[._-]+|[._-]+$", ""))
    return F.filter(trimmed, lambda t: (F.length(t) >= 2) & ~t.isin(STOP_WORDS))


def tokens(column: Column) -> Column:
    """The distinct tokens of a text; null for null."""
    return F.array_distinct(token_runs(folded(column)))


@F.pandas_udf(T.StringType())
def _browser_fold_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not "\u0300" <= c <= "\u036f").lower())


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def strip_markdown(column: Column) -> Column:
    """A Markdown text without its marking: links as their labels, the marks of code, emphasis, quotes and headings dropped, entities resolved, white space as single spaces."""
    bare = F.regexp_replace(F.regexp_replace(column, r"\[([^\]]*)\]\([^)]*\)", "$1"), "[`*_>#]", "")
    entity = F.contains(bare, F.lit("&"))
    return F.trim(F.regexp_replace(F.when(entity, _unescaped(F.when(entity, bare))).otherwise(bare), r"(?U)\s+", " "))


def stable_id(prefix: str, *parts: Column, size: int = 16) -> Column:
    """A short id of several texts: the prefix and the first digits of their SHA-256, in capitals."""
    return F.concat(F.lit(prefix + "-"), F.upper(F.left(F.sha2(F.concat_ws("\x1f", *parts), 256), F.lit(size))))


def browser_tokens(column: Column) -> Column:
    """The distinct tokens of a text as the browser takes them: NFKD, of other than ASCII only U+0300 to U+036F dropped, so that letters such as ß, ø and ł part tokens; null for null."""
    plain = column.rlike(r"^[\x00-\x7f]*$")
    return F.array_distinct(token_runs(F.when(plain, F.lower(column)).otherwise(_browser_fold_udf(F.when(~plain, column)))))
