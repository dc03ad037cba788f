"""Personal data in text: IBANs, eight fixed patterns, then card numbers in any grouping."""

from __future__ import annotations

import re
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsignals.functions import jsontext
from opsignals.functions.fingerprint import EMAIL, EMAIL_PLAIN
from opsignals.functions.text import NOT_AFTER_WORD as START
from opsignals.functions.text import NOT_BEFORE_WORD as STOP
from opsignals.functions.text import WORD, bind, rewrite_matches

REDACTED = "[FILTERED]"
IBAN_LABEL = "[IBAN FILTERED]"
CARD_LABEL = "[CREDIT CARD FILTERED]"

EITHER_EDGE = rf"(?:(?<={WORD}){STOP}|{START}(?={WORD}))"

# Label and pattern, replaced in this order.
PATTERNS = (
    ("EMAIL", EMAIL),
    ("SSN", rf"{START}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{STOP}"),
    ("CREDIT CARD", rf"{START}[0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{1,4}}{STOP}"),
    ("BEARER TOKEN", rf"{START}(?i:bearer)[ \t\n\x0B\f\r]+[A-Za-z0-9\-._~+/]++=*+"),
    ("JWT", rf"{START}ey[A-Za-z0-9_-]{{10,}}+\.[A-Za-z0-9_-]{{10,}}+\.[A-Za-z0-9_-]{{10,}}{EITHER_EDGE}"),
    ("AWS KEY", rf"{START}AKIA[0-9A-Z]{{16}}{STOP}"),
    ("STRIPE KEY", rf"{START}[sr]k_(?:live|test)_[A-Za-z0-9]{{10,}}+{STOP}"),
    ("GITHUB TOKEN", rf"{START}gh[pousr]_[A-Za-z0-9]{{20,}}+{STOP}"),
)
LABELS = ("IBAN", *(label for label, _ in PATTERNS))
# A key that contains one of these, once reduced to lowercase letters and digits.
SENSITIVE_WORDS = (
    "password", "passwd", "pwd",
    "secret", "apisecret", "clientsecret", "secretkey",
    "token", "accesstoken", "refreshtoken", "apikey", "apitoken", "authorization", "authtoken",
    "bearer", "sessiontoken", "csrftoken",
    "creditcard", "cardnumber", "cardnum", "cvv", "cvv2", "cvc",
    "iban", "accountnumber", "routingnumber", "bankaccount",
    "ssn", "socialsecuritynumber", "socialsecurity",
    "privatekey",
)
# Card numbers start with 4, 51-55, 2221-2720, 34, 37, 6011, 644-649, 65,
# 3528-3589, 36, 300-305 or 62, and have 13 to 19 digits.
CARD_PREFIX = (
    "^(?:4|5[1-5]|222[1-9]|22[3-9][0-9]|2[3-6][0-9][0-9]|27[01][0-9]|2720|34|37|6011|64[4-9]|65"
    "|352[89]|35[3-8][0-9]|36|30[0-5]|62)"
)
CARD_MIN, CARD_MAX = 13, 19

IBAN_CANDIDATE = rf"{START}[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,4}})?){STOP}"
DIGIT_RUN = rf"{START}[0-9]++{STOP}(?:[ -][0-9]++{STOP})*+"
# A run can only hold a card when it has 13 digits.
LONG_DIGIT_RUN = rf"{START}(?=[0-9](?:[ -]?[0-9]){{{CARD_MIN - 1}}})[0-9]++{STOP}(?:[ -][0-9]++{STOP})*+"
_GROUPS_PER_BLOCK = 256


def _iban_ok(candidate: Column) -> Column:
    def check(compact: Column) -> Column:
        turned = F.concat(F.substring(compact, 5, 34), F.substring(compact, 1, 4))
        codes = F.transform(
            F.sequence(F.lit(1), F.length(compact)), lambda i: F.ascii(F.substring(turned, i, F.lit(1)))
        )
        remainder = F.aggregate(
            codes,
            F.lit(0),
            lambda r, c: F.when(c >= 65, (r * 100 + c - 55) % 97).otherwise((r * 10 + c - 48) % 97),
        )
        return F.length(compact).between(15, 34) & (remainder == 1)

    return bind(F.translate(candidate, " ", ""), check)


def _is_card(digits: Column) -> Column:
    return (
        F.length(digits).between(CARD_MIN, CARD_MAX)
        & digits.rlike(CARD_PREFIX)
        & F.call_function("luhn_check", digits)
    )


def _longest_card(groups: Column, i: Column) -> Column:
    """How many groups from ``i`` on make the longest card number; 0 for none."""
    return bind(
        F.slice(groups, i + 1, F.lit(CARD_MAX)),
        lambda ahead: F.coalesce(
            F.array_max(
                F.filter(
                    F.sequence(F.lit(1), F.size(ahead)),
                    lambda n: bind(F.array_join(F.slice(ahead, F.lit(1), n), ""), _is_card),
                )
            ),
            F.lit(0),
        ),
    )


def _redact_run(run: Column) -> Column:
    gaps = F.concat(F.regexp_extract_all(run, F.lit("[ -]"), F.lit(0)), F.array(F.lit("")))
    return bind(F.split(run, "[ -]", -1), lambda groups: bind(gaps, lambda g: _redact_groups(groups, g)))


def _redact_groups(groups: Column, gaps: Column) -> Column:
    """From each group on, the longest stretch of whole groups that is a card number.

    The walk is a fold over the groups. It goes block by block, so the text a step copies
    stays short however long the run is.
    """

    def advance(state: Column, i: Column, found: Column) -> Column:
        used = F.greatest(found, F.lit(1))
        shown = F.when(found > 0, F.lit(CARD_LABEL)).otherwise(F.get(groups, i))
        return F.struct(
            F.concat(state["text"], shown, F.get(gaps, i + used - 1)).alias("text"), (i + used).alias("next")
        )

    def step(state: Column, i: Column) -> Column:
        moved = bind(_longest_card(groups, i), lambda found: advance(state, i, found))
        return F.when(i < state["next"], state).otherwise(moved)

    def block(state: Column, first: Column) -> Column:
        last = F.least(first + (_GROUPS_PER_BLOCK - 1), F.size(groups) - 1)
        start = F.struct(F.lit("").alias("text"), state["next"].alias("next"))
        return bind(
            F.aggregate(F.sequence(first, last), start, step),
            lambda done: F.struct(
                F.concat(state["parts"], F.array(done["text"])).alias("parts"), done["next"].alias("next")
            ),
        )

    blocks = F.sequence(F.lit(0), F.size(groups) - 1, F.lit(_GROUPS_PER_BLOCK))
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("next"))
    return F.array_join(F.aggregate(blocks, start, block, lambda s: s["parts"]), "")


# What a text must hold for a pattern to match: literals in its lowercase form, or a regex that
# starts with a plain character test. Most texts hold none, and are passed through untouched.
_NEEDED_TEXT = {
    "EMAIL": ("@",),
    "BEARER TOKEN": ("bearer",),
    "AWS KEY": ("akia",),
    "STRIPE KEY": ("k_live_", "k_test_"),
    "GITHUB TOKEN": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
}
_NEEDED_SHAPE = {
    "SSN": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "CREDIT CARD": "[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]",
    # One attempt to each run of the pieces' own characters; each reads three runs at most.
    "JWT": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]",
}
_IBAN_SHAPE = "[A-Z]{2}[0-9]{2}"
_RUN_SHAPE = rf"[0-9](?:[ -]?[0-9]){{{CARD_MIN - 1}}}"


def _may_hold(label: str, text: Column, lowered: Column) -> Column:
    if label in _NEEDED_SHAPE:
        return text.rlike(_NEEDED_SHAPE[label])
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(x)) for x in _NEEDED_TEXT[label]])


def _replace(text: Column, label: str, pattern: str, lowered: Column) -> Column:
    return bind(
        text,
        lambda t: F.when(_may_hold(label, t, lowered), F.regexp_replace(t, pattern, f"[{label} FILTERED]")).otherwise(t),
    )


def _rewrite(text: Column, shape: str, pattern: str, rewrite) -> Column:
    return bind(text, lambda t: F.when(t.rlike(shape), rewrite_matches(t, pattern, rewrite)).otherwise(t))


def redact(text: Column) -> Column:
    """The text with every hit replaced by its label. IBANs go first, because the middle of a
    spaced IBAN looks like a card number."""

    def whole(t: Column, lowered: Column) -> Column:
        out = _rewrite(t, _IBAN_SHAPE, IBAN_CANDIDATE, lambda c: F.when(_iban_ok(c), F.lit(IBAN_LABEL)).otherwise(c))
        for label, pattern in PATTERNS:
            out = _replace(out, label, pattern, lowered)
        return _rewrite(out, _RUN_SHAPE, LONG_DIGIT_RUN, _redact_run)

    return bind(text, lambda t: bind(F.lower(t), lambda lowered: whole(t, lowered)))


def label_hits(text: Column, redacted: Column, label: str) -> Column:
    """How often redaction put ``label`` into a text."""
    mark = f"[{label} FILTERED]"

    def count(c: Column) -> Column:
        return (F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)

    return F.when(text == redacted, 0).otherwise(count(redacted) - count(text)).cast("long")


def is_sensitive_key(key: Column) -> Column:
    reduced = F.lower(F.regexp_replace(key, "[^A-Za-z0-9]", ""))
    return F.coalesce(reduced.rlike("|".join(SENSITIVE_WORDS)), F.lit(False))


def looks_nested(value: Column) -> Column:
    """Whether a text may be a JSON object or array."""
    return F.coalesce(value.rlike(r"\A[ \t\r\n]*+[\[{]"), F.lit(False))


def redact_map(column: Column) -> Column:
    """One level of ``map<string, string>``: values of sensitive keys hidden, others redacted."""
    return F.transform_values(
        column, lambda k, v: F.when(v.isNotNull() & is_sensitive_key(k), F.lit(REDACTED)).otherwise(redact(v))
    )


# The same rules for JSON text of unknown depth, which no column expression can walk: used by
# one Arrow UDF only. Python's re has no \G; a run of address characters ends an earlier match,
# so looking behind is not needed either.
_PY_PATTERNS = {
    label: re.compile(EMAIL_PLAIN.replace("+@", "++@") if label == "EMAIL" else pattern)
    for label, pattern in PATTERNS
}
# What every pattern needs one of.
_PY_ANY = re.compile(
    r"@|[0-9][ -]?[0-9]|[Bb][Ee][Aa][Rr][Ee][Rr]|ey[A-Za-z0-9_-]{10}|AKIA|k_live_|k_test_|gh[pousr]_"
)
_PY_IBAN = re.compile(IBAN_CANDIDATE)
_PY_RUN = re.compile(LONG_DIGIT_RUN)
_PY_CARD_PREFIX = re.compile(CARD_PREFIX)


def _py_iban(match: re.Match) -> str:
    compact = match.group().replace(" ", "")
    turned = compact[4:] + compact[:4]
    ok = 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1
    return IBAN_LABEL if ok else match.group()


def _py_is_card(digits: str) -> bool:
    if not CARD_MIN <= len(digits) <= CARD_MAX or not _PY_CARD_PREFIX.match(digits):
        return False
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in doubled) % 10 == 0


def _py_run(match: re.Match) -> str:
    pieces = re.split("([ -])", match.group())
    groups, gaps = pieces[::2], [*pieces[1::2], ""]
    out, i = [], 0
    while i < len(groups):
        sizes = [n for n in range(1, CARD_MAX + 1) if i + n <= len(groups) and _py_is_card("".join(groups[i : i + n]))]
        n = max(sizes, default=0)
        out.append((CARD_LABEL if n else groups[i]) + gaps[i + max(n, 1) - 1])
        i += max(n, 1)
    return "".join(out)


def redact_text(text: str) -> str:
    """:func:`redact` for one Python string."""
    if not _PY_ANY.search(text):
        return text
    lowered = text.lower()
    text = _PY_IBAN.sub(_py_iban, text)
    for label, pattern in _PY_PATTERNS.items():
        if any(needed in lowered for needed in _NEEDED_TEXT.get(label, ("",))):
            text = pattern.sub(f"[{label} FILTERED]", text)
    return _PY_RUN.sub(_py_run, text)


@lru_cache(maxsize=4096)
def key_is_sensitive(key: str) -> bool:
    reduced = re.sub("[^a-z0-9]", "", key.translate(_ASCII_FOLD))
    return any(word in reduced for word in SENSITIVE_WORDS)


_ASCII_FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def redact_json_text(text: str) -> str:
    """JSON text with sensitive keys hidden and its strings redacted, strings of JSON included; other
    text redacted as it is."""
    found = jsontext.rewrite(text, key_is_sensitive, _redact_nested, REDACTED)
    return redact_text(text) if found is None else found


def _redact_nested(text: str) -> str:
    if text.lstrip(" \t\r\n")[:1] in ("{", "["):
        found = jsontext.rewrite(text, key_is_sensitive, redact_text, REDACTED)
        if found is not None:
            return found
    return redact_text(text)
