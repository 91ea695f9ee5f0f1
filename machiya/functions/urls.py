"""Listing and search addresses: repair, canonical form, keys.  Bad addresses give null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from machiya.functions.text import strip


def absolute(c: Column, base: str) -> Column:
    """An absolute address: slashes after the scheme repaired, ``//`` and ``/`` completed; scripts and anchors are null."""
    s = strip(c)
    s = F.when(s.startswith("//"), F.concat(F.lit("https:"), s)).when(s.startswith("/"), F.concat(F.lit(base.rstrip("/")), s)).otherwise(s)
    s = F.regexp_replace(F.regexp_replace(s, r"(?i)^https:/+", "https://"), r"(?i)^http:/+", "http://")
    return F.when(s.rlike(r"(?i)^https?://"), s)


def canonical(c: Column, base: str, hosts: Sequence[str] | None, path: str, keep_query: bool = False) -> Column:
    """The address of a page of interest: host in the list (any if None), path matching; without fragment."""
    s = absolute(c, base)
    where, host, query = F.try_parse_url(s, F.lit("PATH")), F.lower(F.try_parse_url(s, F.lit("HOST"))), F.try_parse_url(s, F.lit("QUERY"))
    scheme = F.lower(F.try_parse_url(s, F.lit("PROTOCOL")))
    out = F.concat(scheme, F.lit("://"), host, where)
    if keep_query:
        out = F.concat(out, F.coalesce(F.concat(F.lit("?"), query), F.lit("")))
    fits = where.rlike(path)
    return F.when(fits & host.isin(*hosts) if hosts else fits, out)


def path_key(c: Column, pattern: str) -> Column:
    """First group of a pattern in the path of an address, lower case; null if absent."""
    return F.nullif(F.lower(F.regexp_extract(F.try_parse_url(c, F.lit("PATH")), pattern, 1)), F.lit(""))
