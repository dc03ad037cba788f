"""The host an outbound call goes to, and the call's name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsignals.functions.text import ascii_lower, ascii_upper


def url_host(url: Column) -> Column:
    """Lowercase host of an absolute URL (bracketed IPv6 kept), else null."""
    authority = F.regexp_extract(url, r"(?s)\A(?!://).+?://([^/?#]*)", 1)
    host_port = F.substring_index(authority, "@", -1)
    host = F.when(host_port.startswith("["), F.regexp_extract(host_port, r"\A\[[^\]]*+\]", 0)).otherwise(
        F.split(host_port, ":", 2)[0]
    )
    return F.when(host != "", ascii_lower(host))


def call_name(method: Column, url: Column) -> Column:
    """``<METHOD> <host>``; never a path or query."""
    verb = F.when(F.coalesce(method, F.lit("")) == "", "GET").otherwise(ascii_upper(method))
    return F.concat(verb, F.lit(" "), F.coalesce(url_host(url), F.lit("unknown")))


def domain_suffixes(host: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``: a subdomain test becomes an equality join."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
