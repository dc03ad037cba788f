"""Message fingerprints: variable parts of an error message replaced, the rest hashed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsignals.functions.text import NOT_AFTER_WORD, NOT_BEFORE_WORD, WORD, bind

FINGERPRINT_LENGTH = 32

# Matching may start only where a run of address characters starts (or right after the
# previous match): a start inside the run reaches the same "@", and trying each one makes
# a long run without "@" quadratic.
EMAIL_PLAIN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
EMAIL = rf"(?:\G|(?<![a-zA-Z0-9._%+-])){EMAIL_PLAIN.replace('+@', '++@')}"

_HEX = "[0-9a-fA-F]"
_UUID = f"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"

# What is replaced, in this order. Each pattern starts with a plain character
# test, so the engine passes over ordinary text without looking behind at every character.
REPLACEMENTS = (
    (EMAIL, "<email>"),
    (r'"[^"\r\n]*+"', "<str>"),
    (rf"'(?<!{WORD}')[^'\r\n]*+'{NOT_BEFORE_WORD}", "<str>"),
    (r"0x[0-9a-fA-F]{4,}+", "0x"),
    (rf"(?={_HEX}){NOT_AFTER_WORD}{_UUID}{NOT_BEFORE_WORD}", "<uuid>"),
    (rf"(?=[0-9]){NOT_AFTER_WORD}[0-9]++{NOT_BEFORE_WORD}", "<n>"),
)
# What a text must hold for a replacement to happen at all.
_NEEDS = ("@", '"', "'", "0x", "-", None)


def normalize(message: Column) -> Column:
    for (pattern, label), needed in zip(REPLACEMENTS, _NEEDS, strict=True):
        message = _replace(message, pattern, label, needed)
    return message


def _replace(c: Column, pattern: str, label: str, needed: str | None) -> Column:
    if needed is None:
        return F.regexp_replace(c, pattern, label)
    return bind(c, lambda t: F.when(F.contains(t, F.lit(needed)), F.regexp_replace(t, pattern, label)).otherwise(t))


def hash_normalized(normalized: Column) -> Column:
    return F.substring(F.sha2(normalized, 256), 1, FINGERPRINT_LENGTH)


def fingerprint(message: Column) -> Column:
    return hash_normalized(normalize(message))
