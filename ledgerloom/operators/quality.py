"""Data quality: record checks, safety scans, trigger masks, review matching, integrity of relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Patterns of secrets and payloads that must not be published.
SECRETS = {
    "private_key_material": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "bearer_credential": r"(?i)\bauthorization\s*:\s*bearer\s+[A-Za-z0-9._~+/=-]{12,}",
    "aws_access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "data_uri_payload": r"(?i)^data:[^;,]{1,100};base64,",
    "long_base64_payload": r"^[A-Za-z0-9+/]{512,}={0,2}$",
}
#: Field names, in small letters with other characters than letters and digits as _, that must not be published.
BODY_FIELDS = frozenset(
    "body body_html body_markdown body_text page_body page_html page_markdown page_text raw_body raw_content rendered_body rendered_html source_body source_html attachment_body attachment_bytes"
    " file_bytes image_bytes media_bytes binary blob base64 payload document_content".split()
)
CREDENTIAL_FIELDS = frozenset(
    "password passwd secret client_secret api_key apikey access_token refresh_token bearer_token authorization proxy_authorization cookie set_cookie private_key ssh_key credential credentials".split()
)
STRING_CHARS = 1_048_576


def failed_checks(rows: DataFrame, key: str, checks: Mapping[str, Column]) -> DataFrame:
    """(key, failed): the names of the checks that a row fails, rows that fail none left out. A check that is null fails."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in checks.items()]))
    return rows.select(key, failed.alias("failed")).where(F.size("failed") > 0)


def error_ledger(found: DataFrame, order: Sequence[str], keep: int = 100) -> DataFrame:
    """The first `keep` errors with the number of all of them: the report is bounded, the count is not."""
    total = found.count()
    return found.orderBy(*order).limit(keep).withColumn("n_errors", F.lit(total).cast("long"))


def secret_scan(rows: DataFrame, key: str, columns: Sequence[str], patterns: Mapping[str, str] | None = None) -> DataFrame:
    """(key, column, pattern) for each text column that a pattern is found in."""
    tests = [F.when(F.col(c).rlike(p), F.struct(F.lit(c).alias("column"), F.lit(n).alias("pattern"))) for c in columns for n, p in (patterns or SECRETS).items()]
    return rows.select(key, F.explode(F.array_compact(F.array(*tests))).alias("f")).select(key, "f.column", "f.pattern")


@F.pandas_udf(T.ArrayType(T.StringType()))
def record_findings(texts: pd.Series) -> pd.Series:
    """The names of all findings within JSON texts: SECRETS in each string at any depth, complete HTML documents, strings over STRING_CHARS (not looked at further), and the fields of
    BODY_FIELDS and CREDENTIAL_FIELDS, whatever their value. Text that is no JSON is one string."""
    import re

    from ledgerloom.functions.json_tools import loads, opened

    patterns = [(name, re.compile(p)) for name, p in SECRETS.items()]

    def one(text: str | None) -> list[str]:
        found: set[str] = set()
        try:
            todo = [opened(loads(text)) if text else None]
        except ValueError:
            todo = [text]
        while todo:
            value = todo.pop()
            if isinstance(value, dict):
                names = {re.sub(r"[^a-z0-9]+", "_", k.casefold()).strip("_") for k in value}
                found |= {kind for kind, fields in (("prohibited_body_field", BODY_FIELDS), ("credential_field", CREDENTIAL_FIELDS)) if names & fields}
                todo.extend(value.values())
            elif isinstance(value, list):
                todo.extend(value)
            elif isinstance(value, str):
                if len(value) > STRING_CHARS:
                    found.add("oversized_string")
                    continue
                if value.lstrip()[:20].casefold().startswith(("<!doctype html", "<html")):
                    found.add("complete_html_document")
                found |= {name for name, p in patterns if p.search(value)}
        return sorted(found)

    return texts.map(one)


def record_scan(rows: DataFrame, key: str, column: str) -> DataFrame:
    """(key, column, pattern) for each finding of a column of JSON records: those of record_findings, and the patterns found in the text as it stands (in field names too)."""
    raw = F.array_compact(F.array(*[F.when(F.col(column).rlike(p), F.lit(n)) for n, p in SECRETS.items()]))
    return rows.select(key, F.lit(column).alias("column"), F.explode(F.array_union(raw, record_findings(column))).alias("pattern"))


def trigger_mask(text: Column, triggers: Mapping[str, str]) -> Column:
    """One bit for each trigger pattern found in a text, in the order of the mapping."""
    mask = F.lit(0)
    for bit, pattern in enumerate(triggers.values()):
        mask = mask + F.when(text.rlike(pattern), 1 << bit).otherwise(0)
    return F.coalesce(mask, F.lit(0)).cast("int")


def nested_mask(fields: Mapping[str, Sequence[str]]):
    """A function of JSON texts to the bits of the groups of field names that occur at any depth with a value that isn't empty."""
    groups = {name: 1 << bit for bit, names in enumerate(fields.values()) for name in names}

    @F.pandas_udf(T.IntegerType())
    def mask(texts: pd.Series) -> pd.Series:
        from ledgerloom.functions.json_tools import record_of

        def one(text: str | None) -> int:
            found, todo = 0, [record_of(text)]
            while todo:
                value = todo.pop()
                if isinstance(value, dict):
                    for k, v in value.items():
                        if v not in (None, "", [], {}, False):
                            found |= groups.get(k.lower().replace("-", "_"), 0)
                    todo.extend(value.values())
                elif isinstance(value, list):
                    todo.extend(value)
            return found

        return texts.map(one).astype("int32")

    return mask


def without_fields(names: Sequence[str]):
    """A function of JSON texts to the same without the named fields at any depth, in one spelling; null for what is no JSON object."""
    dropped = frozenset(names)

    @F.pandas_udf(T.StringType())
    def prune(texts: pd.Series) -> pd.Series:
        import json

        from ledgerloom.functions.json_tools import record_of

        def cut(value):
            if isinstance(value, dict):
                return {k: cut(v) for k, v in value.items() if k not in dropped}
            return [cut(v) for v in value] if isinstance(value, list) else value

        return texts.map(lambda t: None if (r := record_of(t)) is None else json.dumps(cut(r), sort_keys=True, ensure_ascii=False, separators=(",", ":")))

    return prune


@F.pandas_udf(T.StringType())
def canonical_sha256(texts: pd.Series) -> pd.Series:
    """SHA-256 of a JSON text in canonical form: sorted fields, no white space, UTF-8 unescaped. Null for what is no JSON."""
    import hashlib
    import json

    from ledgerloom.functions.json_tools import loads

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else hashlib.sha256(json.dumps(loads(text), sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")).hexdigest()
        except ValueError:
            return None

    return texts.map(one)


@F.pandas_udf(T.StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    """A JSON text in canonical form: sorted fields, no white space, UTF-8 unescaped. Null for what is no JSON."""
    import json

    from ledgerloom.functions.json_tools import loads

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(loads(text), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        except (ValueError, RecursionError):
            return None

    return texts.map(one)


def citation_gate(citations: DataFrame, sources: DataFrame, reviews: DataFrame, waivers: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(citation_id, released, failed): the release decision on each citation (citation_id, source_id, claim_id, ...), a conjunction of checks: those given, and that its source is known and not withdrawn (sources: source_id, withdrawn),
    that exactly one review accepts its claim (reviews: claim_id, accepted), and that its id is unique. A waiver (citation_id, check) lifts a check. A check that is null fails."""
    once = sources.groupBy("source_id").agg(F.max(F.coalesce(F.col("withdrawn").cast("int"), F.lit(0))).alias("_withdrawn"))
    votes = reviews.groupBy("claim_id").agg(F.count(F.lit(1)).alias("_reviews"), F.sum(F.coalesce(F.col("accepted").cast("int"), F.lit(0))).alias("_accepted"))
    copies = citations.groupBy("citation_id").agg(F.count(F.lit(1)).alias("_copies"))
    lifted = waivers.groupBy("citation_id").agg(F.collect_set("check").alias("_waived"))  # at most one entry a check
    whole = citations.join(once, "source_id", "left").join(votes, "claim_id", "left").join(copies, "citation_id", "left").join(lifted, "citation_id", "left")
    every = {**checks, "source_known": F.col("_withdrawn").isNotNull(), "source_current": F.col("_withdrawn") == 0, "claim_reviewed_once": F.col("_reviews") == 1, "claim_accepted": F.col("_accepted") == 1, "unique_id": F.col("_copies") == 1}
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in every.items()]))
    left = F.array_sort(F.array_except(failed, F.coalesce("_waived", F.array().cast("array<string>"))))
    return whole.select("citation_id", (F.size(left) == 0).alias("released"), left.alias("failed")).distinct()


def topology_faults(written: DataFrame, recomputed: DataFrame, key: str = "host") -> DataFrame:
    """(key, column, written, recomputed) where a written topology differs from one made anew; a host that one of them lacks differs in every column."""
    columns = [c for c in recomputed.columns if c != key]
    side = lambda df, n: df.select(F.col(key), F.struct(*[F.to_json(F.struct(c)).alias(c) for c in columns]).alias(n))
    both = side(written, "w").join(side(recomputed, "r"), key, "full_outer")
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"w.{c}").alias("written"), F.col(f"r.{c}").alias("recomputed")) for c in columns])
    return both.select(key, F.explode(each).alias("d")).select(key, "d.*").where(~F.col("written").eqNullSafe(F.col("recomputed")))


def timestamp_key(text: str) -> tuple[int, float, str]:
    """(validity, epoch seconds, text): ISO forms as datetime.fromisoformat reads them are valid, UTC where they state no zone."""
    from datetime import UTC, datetime

    try:
        at = datetime.fromisoformat(text.replace("Z", "+00:00"))
        return 1, (at if at.tzinfo else at.replace(tzinfo=UTC)).timestamp(), text
    except (ValueError, OverflowError):
        return 0, 0.0, text


@F.pandas_udf(T.StructType([T.StructField("valid", T.IntegerType()), T.StructField("epoch", T.DoubleType()), T.StructField("raw", T.StringType())]))
def latest_retrieval(texts: pd.Series) -> pd.DataFrame:
    """The greatest timestamp_key of retrieved_at and of closing_evidence[].retrieved_at of JSON records; that of an empty text for what states none or is no JSON object."""
    from functools import lru_cache

    from ledgerloom.functions.json_tools import opened, record_of

    key = lru_cache(maxsize=65_536)(timestamp_key)

    def one(text: str | None) -> tuple[int, float, str]:
        record = record_of(text) or {}
        evidence = opened(record.get("closing_evidence"))
        stated = [record, *(e for e in (evidence if isinstance(evidence, list) else []) if isinstance(e, dict))]
        valid, epoch, raw = max(key(str(r.get("retrieved_at") or "")) for r in stated)
        return valid, epoch, raw.encode("utf-8", "replace").decode()

    return pd.DataFrame([one(t) for t in texts], columns=["valid", "epoch", "raw"])


def watermark(rows: DataFrame, by: Sequence[str], text: str) -> DataFrame:
    """(by, watermark): the text of the latest retrieval of each group, by validity, instant and text."""
    return rows.select(*by, latest_retrieval(text).alias("m")).groupBy(*by).agg(F.max("m")["raw"].alias("watermark"))


def audit_items(rows: DataFrame, key: str, mask: str, kind: str) -> DataFrame:
    """(key, mask, observations, kinds): one row per item, its bits of all observations together."""
    return rows.where(F.col(mask) > 0).groupBy(key).agg(F.bit_or(mask).alias("mask"), F.count(F.lit(1)).alias("observations"), F.array_sort(F.collect_set(kind)).alias("kinds"))


def unreviewed(items: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Items of which no review covers all bits: reviews has key and review_mask."""
    covered = items.join(reviews.select(key, "review_mask"), key).where(F.col("review_mask").bitwiseAND(F.col("mask")) == F.col("mask")).select(key).distinct()
    return items.join(covered, key, "left_anti")


def pairing_conflicts(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(side, value, n) where an a has several b or a b several a, which a one-to-one relation never has."""
    pairs = rows.where((F.col(a) != "") & (F.col(b) != "")).select(a, b).distinct()
    one = lambda x, name: pairs.groupBy(F.col(x).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(name).alias("side"), "value", "n")
    return one(a, a).unionByName(one(b, b))


def tree_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(path, difference) of two file tables (path, sha256): only_left, only_right or changed."""
    both = a.select("path", F.col("sha256").alias("l")).join(b.select("path", F.col("sha256").alias("r")), "path", "full_outer")
    difference = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").when(F.col("l") != F.col("r"), "changed")
    return both.select("path", difference.alias("difference")).where(F.col("difference").isNotNull())


def plain_digest(rows: DataFrame, by: Sequence[str], line: Column) -> DataFrame:
    """(by, n, digest): SHA-256 of each group's lines in order, joined by line feeds. The lines of a group meet in one task, so this is for small groups; ordered_digest is the form for groups of any size, and gives other digests."""
    ordered = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sha2(ordered, 256).alias("digest"))


def ordered_digest(rows: DataFrame, by: Sequence[str], line: Column, levels: Sequence[int] = (6, 4, 2)) -> DataFrame:
    """(by, n, digest) of the multiset of lines of each group, whatever order and partitions they come in. A hash tree: lines go to leaves by the first digits of their hash, a leaf's
    digest is that of its sorted line hashes, a node's that of its children's in order. With six digits a leaf of a thousand million lines has some sixty; a node has at most 256 children.
    No line is moved, only its hash. Lines repeated very often are counted before the shuffle."""
    counted = rows.select(*by, F.sha2(line, 256).alias("h")).groupBy(*by, "h").agg(F.count(F.lit(1)).alias("k"))
    node = counted.select(*by, F.left("h", F.lit(levels[0])).alias("p"), F.col("h").alias("o"), F.concat_ws("*", "h", "k").alias("d"), F.col("k").alias("n"))
    for width in (*levels[1:], 0, None):
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "d"))), lambda x: x["d"]), "")
        node = node.groupBy(*by, "p").agg(F.sum("n").alias("n"), F.sha2(children, 256).alias("d"))
        if width is not None:
            node = node.select(*by, F.left("p", F.lit(width)).alias("p"), F.col("p").alias("o"), "d", "n")
    return node.select(*by, "n", F.col("d").alias("digest"))


def index_faults(lists: DataFrame, terms: DataFrame, found: DataFrame, cap: int) -> DataFrame:
    """(token, fault) of a search index, lists (token, ordinal, score, mask, rank) and terms (token, df), against the postings found again: df that is not the number of postings, a list over the cap,
    ranks that are not 1, 2, 3 and so on (contiguity), entries not by score descending and ordinal (order), and entries that are missing, not due or of other values (entries)."""
    from pyspark.sql.window import Window

    from ledgerloom.operators.index import capped

    counted = found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    df = terms.select("token", "df").join(counted, "token", "full_outer").where(~F.col("df").eqNullSafe(F.col("n"))).select("token", F.lit("df").alias("fault"))
    place = F.struct(-F.col("score"), "ordinal")
    ordered = lists.withColumn("_late", F.lag(place).over(Window.partitionBy("token").orderBy("rank", "ordinal")) >= place)
    shape = ordered.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("low"), F.max("rank").alias("high"), F.countDistinct("rank").alias("ranks"), F.max("_late").alias("late"))
    tests = {"cap": F.col("n") > cap, "contiguity": (F.col("low") != 1) | (F.col("high") != F.col("n")) | (F.col("ranks") != F.col("n")), "order": F.col("late")}
    shaped = shape.select("token", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))).alias("fault"))
    own, due = (x.select("token", "ordinal", F.struct("score", "mask", F.col("rank").cast("int").alias("rank")).alias(n)) for x, n in ((lists, "own"), (capped(found, cap), "due")))
    entries = own.join(due, ["token", "ordinal"], "full_outer").where(~F.col("own").eqNullSafe(F.col("due"))).select("token", F.lit("entries").alias("fault"))
    return df.unionByName(shaped).unionByName(entries).distinct()
