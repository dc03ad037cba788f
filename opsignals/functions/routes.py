"""Route and span names reduced so that no raw path can name a person."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsignals.functions.text import ascii_lower, ascii_upper

MAX_SEGMENT = 40
# A template segment (":id", "{id}", "<int:id>", "[slug]", "*rest"), the methods.
TEMPLATE_SEGMENT = r"\A(?:\*[^\n]*|:[^\n]+|\{[^\n]+\}|<[^\n]+>|\[[^\n]+\])\z"
METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS")

_CALL = rf"\A(?i:({'|'.join(METHODS)}))[ \t\n\x0B\f\r]++([^ \t\n\x0B\f\r]++)"
_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.-]*+://"
_PORT = r":[0-9]++\z"


def strict_path(path: Column) -> Column:
    """A route template is kept whole; a raw path keeps its first segment only."""
    bare = F.split(path, "[?#]", 2)[0]
    segments = F.split(bare, "/", -1)
    named = F.filter(segments, lambda s: s != "")
    first = F.get(named, F.lit(0))
    is_id = first.rlike("[0-9]") | (F.char_length(first) > MAX_SEGMENT)
    reduced = F.concat(
        F.when(bare.startswith("/"), "/").otherwise(""),
        F.when(is_id, ":id").otherwise(first),
        F.when(F.size(named) > 1, "/:path").otherwise(""),
    )
    return (
        F.when(F.exists(segments, lambda s: s.rlike(TEMPLATE_SEGMENT)), bare)
        .when(F.size(named) == 0, "/")
        .otherwise(reduced)
    )


def call_host(target: Column) -> Column:
    """Host of a call target without scheme, credentials and port; null for a relative path."""
    has_scheme = target.rlike(_SCHEME)
    authority = F.split(F.regexp_replace(target, _SCHEME, ""), "[/?#]", 2)[0]
    authority = F.substring_index(authority, "@", -1)
    has_port = authority.rlike(_PORT)
    host = F.regexp_replace(authority, _PORT, "")
    is_host = has_scheme | has_port | F.contains(host, F.lit(".")) | (ascii_lower(host) == "localhost")
    return F.when((host != "") & is_host, host)


def strict_name(name: Column) -> Column:
    """``GET /patients/42`` -> ``GET /patients/:path``; ``GET https://h/x`` -> ``GET h``."""
    method = F.regexp_extract(name, _CALL, 1)
    target = F.regexp_extract(name, _CALL, 2)
    reduced = F.when(target.startswith("/"), strict_path(target)).otherwise(
        F.coalesce(call_host(target), strict_path(target))
    )
    return (
        F.when(name.startswith("/"), strict_path(name))
        .when(method != "", F.concat(ascii_upper(method), F.lit(" "), reduced))
        .otherwise(name)
    )
