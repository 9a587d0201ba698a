"""URLs: one spelling for each, relative ones resolved, hosts classed."""

from __future__ import annotations

from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Query parameters that never belong to the identity of a page: credentials, and those that track.
CREDENTIALS = ("access_token", "api_key", "apikey", "auth", "key", "password", "secret", "signature", "token")
TRACKING = ("utm_",)


def normal_url(text: str | None, base: str = "https://www.gov.example") -> str | None:
    """Scheme and host in lower case, IDNA host, no default port, no fragment, no credential or tracking parameters, `/` for an empty path; a path alone
    belongs to base. None for null and for what is unsafe or no web address: control characters, backslashes, `//host` forms, other schemes,
    user names, no host, bad ports."""
    if text is None or text.startswith("//") or "\\" in text or any(ord(c) < 32 for c in text):
        return None
    try:
        parts = urlsplit(base + text if text.startswith("/") else text)
        port = parts.port
        host = (parts.hostname or "").encode("idna").decode("ascii").lower()
    except (ValueError, UnicodeError):
        return None
    scheme = parts.scheme.lower()
    if scheme not in ("http", "https") or parts.username or parts.password or not host:
        return None
    kept = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k.lower() not in CREDENTIALS and not k.lower().startswith(TRACKING)]
    shown = host if port in (None, {"http": 80, "https": 443}[scheme]) else f"{host}:{port}"
    return urlunsplit((scheme, shown, parts.path or "/", urlencode(kept), ""))


def resolved_url(base: str | None, link: str | None) -> str | None:
    """The normal URL of a link on a page; None for links that aren't addresses of pages."""
    if base is None or link is None:
        return None
    try:
        return normal_url(urljoin(base, link.strip()))
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def normalise_url(texts: pd.Series) -> pd.Series:
    return texts.map(normal_url)


@F.pandas_udf(T.StringType())
def resolve_url(bases: pd.Series, links: pd.Series) -> pd.Series:
    return pd.Series([resolved_url(b, x) for b, x in zip(bases, links, strict=True)], dtype=object)


def simple_url(column: Column) -> Column:
    """The part of normalise_url that a plain expression can do, for the common case: outer white space, case of scheme and host, repeated slashes in the path,
    fragment, trailing slash."""
    bare = F.regexp_replace(F.regexp_replace(column, r"^\s+|\s+$", ""), "#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z]+://[^/?]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(bare, r"^[A-Za-z]+://[^/?]*", ""), "/{2,}", "/")
    return F.concat(head, F.regexp_replace(rest, "/$", ""))


def host_of(column: Column) -> Column:
    return F.lower(F.regexp_extract(column, r"^\s*[A-Za-z]+://([^/?#:\s]+)", 1))


def host_kind(host: Column, main: str, domain: str) -> Column:
    """main, domain boundary (another host of the domain) or external; null without a host."""
    return F.when(host == "", None).when(host == main, "main").when((host == domain) | host.endswith("." + domain), "domain_boundary").otherwise("external")
