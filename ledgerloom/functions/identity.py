"""Identity rules: stable ids, hash buckets, deterministic samples, fall-through of empty values. All Column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import folded


def first_nonempty(*columns: Column) -> Column:
    """The first that is neither null nor empty; null if none is."""
    return F.coalesce(*[F.when(c != "", c) for c in columns])


def slug(column: Column, fallback: str = "item", size: int = 120) -> Column:
    """Lower-case ASCII letters and digits joined by hyphens, at most `size` characters; the fallback for what has none. Null stays null."""
    parts = F.regexp_replace(F.regexp_replace(folded(column), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(column.isNotNull(), first_nonempty(F.left(parts, F.lit(size)), F.lit(fallback)))


def search_shard(column: Column, size: int = 2) -> Column:
    """First letters and digits of a token; `_` for one without."""
    return first_nonempty(F.left(F.regexp_replace(F.lower(column), "[^a-z0-9]", ""), F.lit(size)), F.lit("_"))


@F.pandas_udf(T.LongType())
def _fnv1a32(values: pd.Series) -> pd.Series:
    """All texts of a batch at once, one byte of each at a time, the longest first so that the ones still going stand together."""
    raw = [v.encode("utf-8", "surrogatepass") for v in values]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    order = np.argsort(-sizes, kind="stable")
    data, begins = np.frombuffer(b"".join(raw), np.uint8), (np.cumsum(sizes) - sizes)[order]
    going = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")
    seen = np.full(len(raw), 2166136261, np.uint64)
    for at, n in enumerate(going.tolist()):
        seen[:n] = ((seen[:n] ^ data[begins[:n] + at]) * np.uint64(16777619)) & np.uint64(0xFFFFFFFF)
    out = np.empty(len(raw), np.int64)
    out[order] = seen
    return pd.Series(out)


def fnv1a32(column: Column) -> Column:
    """32-bit FNV-1a of the UTF-8 bytes, as a long. Offset basis 2166136261, prime 16777619. Null stays null."""
    return F.when(column.isNotNull(), _fnv1a32(F.coalesce(column, F.lit(""))))


def adjacency_bucket(column: Column) -> Column:
    """The top byte of the hash as two hexadecimal digits: 256 buckets that any client can work out from the id."""
    return F.lower(F.lpad(F.hex(F.shiftright(fnv1a32(column), 24)), 2, "0"))


def sha_number(column: Column) -> Column:
    """The first 64 bits of the SHA-256, as a decimal without sign."""
    return F.conv(F.substring(F.sha2(column, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def hash_sample(column: Column, per_cent: int) -> Column:
    """Whether an id belongs to the sample: the same ids at any partitioning and in any run."""
    return sha_number(column) % 100 < per_cent


def nul_joined(*columns: Column) -> Column:
    return F.concat_ws("\0", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def assertion_id(source: Column, kind: Column, target: Column, evidence: Column, predicate: Column, locator: Column) -> Column:
    return F.concat(F.lit("assertion-"), F.sha2(nul_joined(source, kind, target, evidence, predicate, locator), 256))


def candidate_key(entity_class: Column, native_id: Column, url: Column, locale: Column) -> Column:
    return F.sha2(nul_joined(entity_class, first_nonempty(native_id, url), locale, url), 256)


def part_key(index_id: Column, number: Column, link: Column, slug_: Column) -> Column:
    return F.sha2(nul_joined(index_id, number, first_nonempty(link, slug_, number.cast("string"))), 256)


def dataset_route(content_id: Column, url: Column, locale: Column) -> Column:
    own = F.lower(F.regexp_replace(F.coalesce(content_id, F.lit("")), "[^A-Za-z0-9-]", ""))
    return F.concat(F.lit("dataset/"), first_nonempty(own, F.concat(F.lit("route-"), F.left(F.sha2(url, 256), F.lit(24)))), F.lit("-"), slug(locale))


def title_from_path(path: Column) -> Column:
    """The last part of a path as a title."""
    return F.initcap(F.replace(F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1), F.lit("-"), F.lit(" ")))


def predicate_name(column: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one underscore, none outside."""
    return F.regexp_replace(F.regexp_replace(F.lower(column), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def quoted_phrases(column: Column) -> Column:
    return F.regexp_extract_all(column, F.lit('["“]([^"”]+)["”]'), 1)


def language_tag(column: Column) -> Column:
    """BCP 47 form of a tag: language lower, region upper, script in title case; null for what is no tag."""
    parts = F.split(F.replace(F.trim(column), F.lit("_"), F.lit("-")), "-")
    shaped = F.transform(parts, lambda p, i: F.when(i == 0, F.lower(p)).when(F.length(p) == 4, F.initcap(p)).when(F.length(p) == 2, F.upper(p)).otherwise(F.lower(p)))
    return F.when(column.rlike(r"^\s*[A-Za-z]{2,3}([-_][A-Za-z0-9]{2,8})*\s*$"), F.array_join(shaped, "-"))


def clean_text(column: Column, size: int) -> Column:
    """Control characters and runs of white space as one space, outer space dropped, at most `size` characters."""
    return F.left(F.trim(F.regexp_replace(column, r"[\x00-\x20\x7f]+", " ")), F.lit(size))


def version_in_url(column: Column) -> Column:
    """A version number (v1.2, 1.2.3) in a URL's path, else a commit hash, else null."""
    return first_nonempty(F.regexp_extract(column, r"[/@v]v?(\d+\.\d+(?:\.\d+)?)(?:[/?#]|$)", 1), F.regexp_extract(column, r"/([0-9a-f]{40})(?:[/?#]|$)", 1))
