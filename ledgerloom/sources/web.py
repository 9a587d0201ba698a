"""Web sources as text columns: sitemaps, rendered pages, robots rules, Markdown."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.identity import part_key
from ledgerloom.functions.text import strip_markdown


def sitemap_entries(rows: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, kind, loc, lastmod) of sitemap texts: entries of a urlset or a sitemapindex, whatever the namespace."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(k, *entry) for k, text in zip(pdf[key], pdf[xml], strict=True) for entry in _entries(text)]
            yield pd.DataFrame(found, columns=[key, "kind", "loc", "lastmod"])

    return rows.select(key, xml).mapInPandas(run, f"`{key}` {kind}, kind string, loc string, lastmod string")


def _entries(text: str | None) -> Iterator[tuple[str, str, str | None]]:
    """(kind, loc, lastmod) of each entry by itself, so that one without a date takes no other's. An entry without an address gives nothing, nor does text that is no XML."""
    local = lambda e: e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""
    try:
        root = ElementTree.fromstring(text.strip().encode()) if text and text.strip() else None
    except ElementTree.ParseError:
        root = None
    for entry in root if root is not None else ():
        if local(entry) in ("url", "sitemap"):
            values = {local(e): (e.text or "").strip() for e in reversed(entry)}  # of repeated fields the first holds
            if values.get("loc"):
                yield local(entry), values["loc"], values.get("lastmod") or None


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(loc, lastmod) of sitemap files, by Spark's XML reader; entries without lastmod have null."""
    return spark.read.format("xml").option("rowTag", "url").option("ignoreNamespace", "true").schema("loc string, lastmod string").load(path)


#: Extensions of documents, types of pages, and beginnings of paths that are never read.
RESOURCE_EXTENSIONS = ("csv", "doc", "docx", "epub", "geojson", "ics", "json", "ods", "odt", "pdf", "ppt", "pptx", "rdf", "rtf", "tsv", "txt", "xls", "xlsx", "xml", "zip")
PAGE_TYPES = ("text/html", "application/xhtml+xml")
DENIED_PREFIXES = ("/api/", "/search", "/email-signup", "/print/")


class _Page(HTMLParser):
    """Links, language, text and JSON-LD of one page; scripts, styles and templates give no text."""

    SILENT = frozenset({"script", "style", "template"})

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.silent, self.language, self.in_data = 0, None, False
        self.links: list[tuple] = []
        self.texts: list[str] = []
        self.data: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "html" and a.get("lang"):
            self.language = a["lang"]
        if tag in self.SILENT:
            self.silent += 1
            self.in_data = tag == "script" and (a.get("type") or "").lower() == "application/ld+json"
        for name in ("href", "src"):
            if a.get(name) and tag in ("a", "link", "img", "iframe", "script"):
                self.links.append((tag, a[name].strip(), a.get("rel"), a.get("type")))

    def handle_endtag(self, tag):
        if tag in self.SILENT and self.silent:
            self.silent -= 1
            self.in_data = False

    def handle_data(self, data):
        if self.in_data:
            self.data.append(data)
        elif not self.silent:
            self.texts.append(data)


#: Fixed value: the marks that no white space stands before.
_TIGHT = r"\s+([,.;:!?])"


def tidy(text: Column) -> Column:
    """Runs of white space as one space, none outside and none before punctuation."""
    return F.regexp_replace(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), _TIGHT, "$1")


@F.pandas_udf(T.StringType())
def _resolved(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else html.unescape(v))


@F.pandas_udf(T.StringType())
def _without_tags(values: pd.Series) -> pd.Series:
    def one(value: str | None) -> str | None:
        if value is None:
            return None
        page = _Page()
        page.feed(value)
        page.close()
        return " ".join(page.texts)

    return values.map(one)


def html_text(value: Column) -> Column:
    """Text of a fragment: tags dropped, entities resolved, white space tidied. Only fragments with a tag are parsed, and only those with an entity reach Python otherwise."""
    tagged, entity = F.contains(value, F.lit("<")), F.contains(value, F.lit("&"))
    bare = F.when(~tagged & ~entity, value)
    return tidy(F.coalesce(bare, _without_tags(F.when(tagged, value)), _resolved(F.when(~tagged & entity, value))))


def _types(value, found: list[str]) -> None:
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            t = v.get("@type")
            found += [t] if isinstance(t, str) else [x for x in t if isinstance(x, str)] if isinstance(t, list) else []
            todo.extend(v.values())
        elif isinstance(v, list):
            todo.extend(v)


def escaped(text: Column) -> Column:
    """A text as it stands in HTML, between tags or in a quoted attribute."""
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


PAGE = "language string, text string, links array<struct<tag:string,href:string,rel:string,type:string>>, types array<string>"


def page_parts(rows: DataFrame, key: str, page: str) -> DataFrame:
    """(key, language, text, links, types) of HTML pages, each parsed once. Damaged HTML gives what can be read; null pages give nulls and empty lists."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, text in zip(pdf[key], pdf[page], strict=True):
                if text is None:
                    out.append((k, None, None, [], []))
                    continue
                p = _Page()
                p.feed(text)
                p.close()
                types: list[str] = []
                for block in p.data:
                    try:
                        _types(json.loads(block), types)
                    except (ValueError, RecursionError):
                        continue
                body = re.sub(_TIGHT, r"\1", re.sub(r"\s+", " ", " ".join(p.texts)).strip())
                out.append((k, p.language, body, [dict(zip(("tag", "href", "rel", "type"), x, strict=True)) for x in p.links], sorted(set(types))))
            yield pd.DataFrame(out, columns=[key, "language", "text", "links", "types"])

    return rows.select(key, page).mapInPandas(run, f"`{key}` {kind}, {PAGE}")


def page_links(parts: DataFrame, key: str) -> DataFrame:
    """(key, position, tag, href, rel, type): one row per link."""
    return parts.select(key, F.posexplode("links").alias("position", "l")).select(key, "position", "l.tag", "l.href", "l.rel", "l.type")


def is_resource(url: Column, mime: Column, hosts: list[str], host: Column) -> Column:
    """Whether a link is a resource: on a host of assets, with a document's extension, or of a declared type other than HTML."""
    extension = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*://[^/?#]*)?[^?#]*/[^/?#]*\.([a-z0-9]+)(?:[?#]|$)", 1).isin(*RESOURCE_EXTENSIONS)
    declared = F.coalesce(~F.lower(mime).isin("", *PAGE_TYPES), F.lit(False))
    return F.coalesce(host.isin(hosts), F.lit(False)) | F.coalesce(extension, F.lit(False)) | declared


def denied(path: Column, prefixes: tuple[str, ...] | None = None) -> Column:
    """Whether a path is one of those that are never read."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.startswith(path, F.lit(p)) for p in prefixes or DENIED_PREFIXES]), F.lit(False))


def robots_rules(text: str, agent: str = "*") -> list[tuple[bool, str]]:
    """(allow, pattern) of the group of an agent, in order; empty patterns say nothing. Groups of several agents share their rules."""
    rules: list[tuple[bool, str]] = []
    agents: list[str] = []
    fresh = False
    for line in text.splitlines():
        name, colon, value = line.split("#", 1)[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            continue
        if name == "user-agent":
            agents = [*agents, value.lower()] if fresh else [value.lower()]
            fresh = True
        else:
            fresh = False
            if name in ("allow", "disallow") and value and agent.lower() in agents:
                rules.append((name == "allow", value))
    return rules


def robots_allows(path: Column, rules: list[tuple[bool, str]]) -> Column:
    """Longest matching pattern decides, allow wins ties, no match allows. The rules of a site are a short list, so they are part of the expression."""
    best = F.lit(None).cast("struct<size:int,allow:boolean>")
    for allow, pattern in rules:
        end = pattern.endswith("$")
        body = ".*".join(re.escape(p) for p in pattern.rstrip("$").split("*"))
        here = F.when(path.rlike("^" + body + ("$" if end else "")), F.struct(F.lit(len(pattern)).alias("size"), F.lit(allow).alias("allow")))
        best = F.greatest(best, here) if rules else best
    return F.coalesce(best["allow"], F.lit(True))


def markdown_links(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, label, url) of inline links; images are no links."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?:^|[^!])\[[^\]\n]*\]\([^)\s]+\)"), F.lit(0))
    each = rows.select(key, F.posexplode(found).alias("position", "m"))
    return each.select(key, "position", F.regexp_extract("m", r"\[([^\]]*)\]\(", 1).alias("label"), F.regexp_extract("m", r"\]\(([^)]+)\)", 1).alias("url"))


def markdown_links_in_context(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, paragraph, context, position, label, url): inline links with the paragraph they stand in, without its marking, and its number. Paragraphs are parted by blank lines."""
    parts = rows.select(key, F.posexplode(F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), r"\n[ \t]*(?:\n[ \t]*)+")).alias("paragraph", "_text"))
    each = parts.select(key, "paragraph", "_text", F.posexplode(F.regexp_extract_all("_text", F.lit(r"(?:^|[^!])\[[^\]\n]*\]\([^)\s]+\)"), F.lit(0))).alias("position", "m"))
    return each.select(key, "paragraph", strip_markdown(F.col("_text")).alias("context"), "position", F.regexp_extract("m", r"\[([^\]]*)\]\(", 1).alias("label"), F.regexp_extract("m", r"\]\(([^)]+)\)", 1).alias("url"))


def search_parts(rows: DataFrame, key: str, parts: str) -> DataFrame:
    """(key, part_key, part_index, part_link, part_slug, part_title, extract_text) of search results: `parts` holds a JSON array of objects with link, slug, title and body. The text of a body is that of its HTML;
    parts without any are left out; what is no array has none."""
    shape = "array<struct<link:string,slug:string,title:string,body:string>>"
    held = F.when(F.col(parts).rlike(r"^\s*\["), F.from_json(parts, shape))
    each = rows.select(key, F.posexplode(held).alias("part_index", "p")).select(key, "part_index", "p.*").withColumn("extract_text", html_text(F.col("body"))).where("extract_text <> ''")
    return each.select(key, part_key(F.col(key).cast("string"), F.col("part_index"), F.col("link"), F.col("slug")).alias("part_key"), "part_index", F.col("link").alias("part_link"), F.col("slug").alias("part_slug"), F.coalesce("title", F.lit("")).alias("part_title"), "extract_text")


def markdown_lines(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, level, title): the lines of Markdown texts, level 1 to 6 for headings, else 0."""
    lines = rows.select(key, F.posexplode(F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), "\n")).alias("position", "line"))
    level = F.length(F.regexp_extract("line", r"^(#{1,6})[ \t]", 1))
    return lines.select(key, "position", level.alias("level"), F.trim(F.regexp_replace("line", r"^#{1,6}[ \t]+|[ \t]+#*\s*$", "")).alias("title"))
