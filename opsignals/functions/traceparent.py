"""The W3C ``traceparent`` header as a struct column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsignals.functions.text import ascii_trim

_HEADER = r"(?s)\A([0-9a-f]{2})-([0-9a-f]{32})-([0-9a-f]{16})-[0-9a-f]{2}(-.*)?\z"


def parse(header: Column) -> Column:
    """``struct<trace_id, parent_span_id>``, or null for a header that can't be used."""
    value = ascii_trim(header, " \t\r\n")
    version, trace_id, span_id, tail = (F.regexp_extract(value, _HEADER, i) for i in range(1, 5))
    usable = (
        value.rlike(_HEADER)
        & (version != "ff")
        & ((version != "00") | (tail == ""))
        & (trace_id != "0" * 32)
        & (span_id != "0" * 16)
    )
    return F.when(usable, F.struct(trace_id.alias("trace_id"), span_id.alias("parent_span_id")))
