"""ASCII-only text helpers. Signal text is UTF-8, but every rule that reads it
(case folding, trimming, word edges) looks at ASCII characters alone."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "[A-Za-z0-9_]"
NOT_AFTER_WORD = f"(?<!{WORD})"
NOT_BEFORE_WORD = f"(?!{WORD})"
WHITESPACE = " \t\n\x0b\f\r"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def ascii_upper(c: Column) -> Column:
    return F.translate(c, string.ascii_lowercase, string.ascii_uppercase)


def ascii_trim(c: Column, characters: str = WHITESPACE) -> Column:
    return F.btrim(c, F.lit(characters))


def is_blank(c: Column) -> Column:
    return ascii_trim(c) == ""


def bind(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` mentions it. Inside a
    conditional, Spark may otherwise run an expensive expression once per mention."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def rewrite_matches(c: Column, pattern: str, rewrite) -> Column:
    """``rewrite`` applied to every match of ``pattern``, the text between kept.

    ``split`` and ``regexp_extract_all`` walk the same matches, so zipping the two
    arrays back together needs no marker character inside the text.
    """
    gaps = F.split(c, pattern, -1)
    hits = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    filled = F.concat(F.transform(hits, rewrite), F.array(F.lit("")))
    return F.array_join(F.zip_with(gaps, filled, lambda gap, hit: F.concat(gap, hit)), "")


def utf8_prefix(c: Column, max_bytes: int) -> Column:
    """The longest valid prefix of at most ``max_bytes`` UTF-8 bytes."""
    raw = c.cast("binary")
    cuts = [F.substring(raw, 1, max_bytes - back).cast("string") for back in range(4)]
    return F.coalesce(*[F.when(F.is_valid_utf8(cut), cut) for cut in cuts])
