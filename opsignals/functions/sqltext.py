"""SQL text: literals masked, and the objects a masked statement touches.

Both are plain column expressions. Every unbounded group loop is possessive: a greedy one
recurses per repetition in Java's regex engine and can overflow an executor's stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsignals.functions.text import (
    NOT_BEFORE_WORD,
    WHITESPACE,
    ascii_lower,
    ascii_trim,
    ascii_upper,
    bind,
    is_blank,
    utf8_prefix,
)

# Fixed values. Clients with little memory cut at 4000 bytes a statement, 10 names a kind of 200
# bytes each and 5 causes; here nothing is cut unless a caller passes such numbers.
CLIENT_STATEMENT_BYTES = 4000
CLIENT_NAMES = 10
CLIENT_NAME_BYTES = 200
CLIENT_CAUSES = 5
COMPILING_MARKER = "while compiling:"
OPERATIONS = (
    "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "WITH", "CALL", "EXEC", "EXECUTE",
    "CREATE", "ALTER", "DROP", "TRUNCATE",
)
BUILTINS = (
    "count", "sum", "min", "max", "avg", "now", "coalesce", "nullif", "lower", "upper", "length",
    "concat", "cast", "date_trunc", "current_timestamp", "current_date", "row_number", "rank",
    "json_build_object", "json_agg", "array_agg",
)
NOT_RELATIONS = ("select", "set", "values", "where", "lateral", "only", "unnest", "generate_series")

_STRING = (
    r"(?:(?<![A-Za-z0-9_$])(?:[EeXxNnBb]|[Uu]&))?"
    r"'(?:[^'\\]++|\\[\s\S]|'')*+(?:'|\\?\z)"
)
_DOUBLE_QUOTED = r'"(?:[^"\\]++|\\[\s\S]|"")*+(?:"|\\?\z)'
_DOLLAR_BODY = r"\$([A-Za-z_]*+)\$(?:[\s\S]*?\$\1\$|[\s\S]*+)"
_NUMBER = (
    r"(?<![A-Za-z0-9_$.])(?:"
    rf"0[xX][0-9A-Fa-f]++{NOT_BEFORE_WORD}|0[bB][01]++{NOT_BEFORE_WORD}|"
    rf"(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?{NOT_BEFORE_WORD})"
)
# The characters a literal can start with, tested before any alternative is tried.
_LITERAL = rf"(?=['$0-9.EeXxNnBbUu])(?:{_STRING}|{_DOLLAR_BODY}|{_NUMBER})"
_LITERAL_MYSQL = rf"(?=['\"$0-9.EeXxNnBbUu])(?:{_STRING}|{_DOUBLE_QUOTED}|{_DOLLAR_BODY}|{_NUMBER})"

_PART = r'(?:[A-Za-z0-9_$#@]++|"[^"]++"|`[^`]++`|\[[^\]]++\])'
_NAME = rf"{_PART}(?:\.{_PART})*+"
_TOKEN = rf"{_NAME}|[^ \t\n\x0B\f\r]"
# Tokens are laid out one after the other, each closed by this mark.
_END = "\x01"
_MARK_STAND_IN = "\ue001"
_CLAUSE_WITH_FROM = (
    rf"(?<={_END})(?i:extract|substring|trim|overlay){_END}\({_END}"
    rf"(?:(?![()]{_END})[^{_END}]++{_END})*+\){_END}"
)
_PROCEDURE_CALL = (
    rf"(?<={_END})(?i:call|exec|execute|perform){_END}"
    rf"(?!(?i:immediate|function|procedure)[.{_END}])({_NAME})(?={_END})"
)
_RELATION = rf"(?<={_END})(?i:from|join|into|update|table){_END}{_NAME}{_END}(?:\({_END})?"
_BARE_SELECT = rf"\A{_END}(?i:select){_END}({_NAME}){_END}\({_END}"


def mask(statement: Column, system: Column | None = None, *, max_bytes: int | None = None) -> Column:
    """Every literal replaced by ``?``; blank gives null. Only MySQL and MariaDB read double
    quotes as strings. With ``max_bytes``, longer results are cut at a character and end in ``...``."""
    plain = F.regexp_replace(statement, _LITERAL, "?")
    if system is None:
        masked = plain
    else:
        is_mysql = F.coalesce(ascii_lower(system).isin("mysql", "mariadb"), F.lit(False))
        masked = F.when(is_mysql, F.regexp_replace(statement, _LITERAL_MYSQL, "?")).otherwise(plain)
    if max_bytes is not None:
        whole = masked
        masked = bind(
            whole,
            lambda m: F.when(F.octet_length(m) > max_bytes, F.concat(utf8_prefix(m, max_bytes), F.lit("..."))).otherwise(m),
        )
    return F.when(~is_blank(statement), masked)


def _clean(names: Column, max_names: int | None, max_name_bytes: int | None) -> Column:
    trimmed = F.transform(names, lambda n: ascii_trim(F.translate(n, _MARK_STAND_IN, _END), WHITESPACE))
    if max_name_bytes is not None:
        trimmed = F.transform(trimmed, lambda n: F.substring(n.cast("binary"), 1, max_name_bytes).cast("string"))
    found = F.array_distinct(F.filter(trimmed, lambda n: n.rlike(rf"\A{_NAME}\z")))
    return found if max_names is None else F.slice(found, 1, max_names)


def objects(masked: Column, *, max_names: int | None = None, max_name_bytes: int | None = None) -> Column:
    """``struct<operation, procedures, relations>`` named by a masked statement, or null.

    The statement is cut into tokens once and laid out with a mark after each, so "keyword,
    then a name" is one regex over whole tokens, left to right and without overlap.
    """
    tokens = F.regexp_extract_all(F.translate(masked, _END, _MARK_STAND_IN), F.lit(_TOKEN), F.lit(0))
    laid_out = F.concat(F.lit(_END), F.array_join(tokens, _END), F.lit(_END))
    found = bind(
        F.regexp_replace(laid_out, _CLAUSE_WITH_FROM, ""), lambda x: _named_in(x, max_names, max_name_bytes)
    )
    return F.when(~is_blank(masked), bind(found, lambda f: F.when(~_is_empty(f), f)))


def _named_in(laid_out: Column, max_names: int | None, max_name_bytes: int | None) -> Column:
    called = F.regexp_extract_all(laid_out, F.lit(_PROCEDURE_CALL), F.lit(1))
    pairs = F.transform(
        F.regexp_extract_all(laid_out, F.lit(_RELATION), F.lit(0)),
        lambda m: F.struct(
            F.split_part(m, F.lit(_END), F.lit(2)).alias("name"),
            (ascii_lower(F.split_part(m, F.lit(_END), F.lit(1))).isin("from", "join") & m.endswith(f"({_END}")).alias(
                "is_function"
            ),
        ),
    )
    pairs = F.filter(pairs, lambda p: ~ascii_lower(p["name"]).isin(*NOT_RELATIONS))

    selected = F.regexp_extract(laid_out, _BARE_SELECT, 1)
    is_bare = (
        (selected != "")
        & ~ascii_lower(selected).isin(*BUILTINS)
        & ~laid_out.rlike(rf"(?<={_END})(?i:from){_END}")
    )
    bare = F.when(is_bare, F.array(selected)).otherwise(F.array().cast("array<string>"))
    word = ascii_upper(F.regexp_extract(laid_out, rf"\A{_END}([A-Za-z0-9_]*+)", 1))

    def parts(p: Column) -> Column:
        functions = F.transform(F.filter(p, lambda x: x["is_function"]), lambda x: x["name"])
        relations = F.transform(F.filter(p, lambda x: ~x["is_function"]), lambda x: x["name"])
        return F.struct(
            F.when(word.isin(*OPERATIONS), word).alias("operation"),
            _clean(F.concat(called, functions, bare), max_names, max_name_bytes).alias("procedures"),
            _clean(relations, max_names, max_name_bytes).alias("relations"),
        )

    return bind(pairs, parts)


def _is_empty(found: Column) -> Column:
    return found["operation"].isNull() & (F.size(found["procedures"]) == 0) & (F.size(found["relations"]) == 0)


def statement_in_text(what: Column) -> Column:
    """The statement after ``while compiling:`` in an exception's text, or null."""
    at = F.instr(what, COMPILING_MARKER)
    rest = ascii_trim(F.substring(what, at + len(COMPILING_MARKER), F.length(what)))
    return F.when((at > 0) & (rest != ""), rest)
