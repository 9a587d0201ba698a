"""Projections of four kinds of source rows to one record shape, and of records to what clients and exports show."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.identity import candidate_key, first_nonempty, title_from_path
from ledgerloom.functions.urls import simple_url

#: The columns of a record, in order.
RECORD = (
    "candidate_key", "entity_class", "source_native_id", "source_id", "content_id", "canonical_url", "base_path", "title", "description", "document_type", "schema_name", "locale", "timestamp",
    "retrieved_at", "evidence_url",
)


def path_of(url: Column) -> Column:
    """The path of an address, `/` for none."""
    return first_nonempty(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1), F.when(url.startswith("/"), F.regexp_extract(url, r"^([^?#]*)", 1)), F.lit("/"))


def shaped(rows: DataFrame, source: str, kind: str, url: Column, native: Column | None = None, **columns: Column) -> DataFrame:
    """Records of one source: `native` identifies a record within it (its address if there is none); the title falls through to the last part of the path. Rows without an address give none."""
    text = lambda name, otherwise=None: first_nonempty(columns[name]) if name in columns else F.lit(otherwise).cast("string")
    address = simple_url(url)
    locale = F.coalesce(text("locale"), F.lit("en"))
    own = first_nonempty(native.cast("string"), address) if native is not None else address
    made = {
        "candidate_key": candidate_key(F.lit(kind), own, address, locale), "entity_class": F.lit(kind), "source_native_id": own, "source_id": F.lit(source), "content_id": text("content_id"), "canonical_url": address,
        "base_path": path_of(address), "title": F.coalesce(text("title"), first_nonempty(title_from_path(path_of(address))), F.lit("Untitled")), "description": F.coalesce(text("description"), F.lit("")),
        "document_type": F.coalesce(text("document_type"), F.lit("unknown")), "schema_name": F.coalesce(text("schema_name"), text("document_type"), F.lit("unknown")), "locale": locale,
        "timestamp": text("timestamp"), "retrieved_at": text("retrieved_at"), "evidence_url": text("evidence_url"),
    }
    return rows.where(url != "").select(*[made[c].alias(c) for c in RECORD])


def from_search(rows: DataFrame) -> DataFrame:
    """Search results: search_index_id, canonical_path, parent_title, document_type, content_id, retrieved_at, evidence_url. A result is its id in the index, not its address."""
    return shaped(rows, "search", "search_result", F.col("canonical_path"), F.col("search_index_id"), content_id=F.col("content_id"), title=F.col("parent_title"), document_type=F.col("document_type"), retrieved_at=F.col("retrieved_at"), evidence_url=F.col("evidence_url"))


def from_sitemap(rows: DataFrame) -> DataFrame:
    """Sitemap entries: loc, lastmod."""
    return shaped(rows, "sitemap", "route", F.col("loc"), document_type=F.lit("sitemap_route"), schema_name=F.lit("unknown"), timestamp=F.col("lastmod"))


def from_content(rows: DataFrame) -> DataFrame:
    """Content pages: content_id, base_path, title, document_type, locale, public_timestamp."""
    return shaped(rows, "content", "identity", F.col("base_path"), F.col("content_id"), content_id=F.col("content_id"), title=F.col("title"), document_type=F.col("document_type"), locale=F.col("locale"), timestamp=F.col("public_timestamp"))


def from_organisations(rows: DataFrame) -> DataFrame:
    """Organisations: content_id, url, title."""
    return shaped(rows, "organisations", "organisation", F.col("url"), F.col("content_id"), content_id=F.col("content_id"), title=F.col("title"), document_type=F.lit("organisation"), schema_name=F.lit("organisation"))


def enumerated(*parts: DataFrame) -> DataFrame:
    """All records of several enumerators, each once."""
    return reduce(DataFrame.unionByName, parts).distinct()


def result_documents(rows: DataFrame, dropped: tuple[str, ...] = ("evidence_url", "source_memberships")) -> DataFrame:
    """What a result list shows of a record: all but its evidence."""
    return rows.drop(*dropped)


#: Field of an export, and of the record that it comes from.
EXPORT = {
    "id": "open", "content_id": "content_id", "route": "open", "title": "title", "type": "document_type", "canonical_url": "url", "lifecycle_status": "lifecycle", "language": "language", "jurisdiction": "jurisdiction",
    "source_status": "confidence", "evidence_url": "evidence_url", "evidence_sha256": "evidence_sha256",
}


def export_rows(rows: DataFrame) -> DataFrame:
    """Records under the names of an export; fields a record lacks are null."""
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(name) for name, c in EXPORT.items()])


def client_records(rows: DataFrame) -> DataFrame:
    """Records as a client holds them: text trimmed and never null, tags as a list without empty ones, whether the source states the record itself, the first letter for an index."""
    text = lambda c, otherwise="": F.coalesce(first_nonempty(F.trim(F.regexp_replace(F.col(c), r"\s+", " "))), F.lit(otherwise))
    tags = F.filter(F.coalesce(F.from_json("tags", "array<string>"), F.array().cast("array<string>")), lambda t: t != "")
    return rows.select(
        F.col("open").alias("id"), text("title", "Untitled").alias("title"), text("description").alias("description"), text("publisher", "unknown").alias("publisher"), text("document_type", "unknown").alias("type"),
        text("language", "en").alias("language"), text("lifecycle", "published").alias("status"), text("url").alias("canonical_url"), F.array_distinct(tags).alias("tags"),
        F.coalesce(F.col("confidence").startswith("source-observed"), F.lit(False)).alias("source_observed"), first_nonempty(F.upper(F.left(F.regexp_replace("title", "[^A-Za-z0-9]", ""), F.lit(1))), F.lit("#")).alias("initial"),
    )
