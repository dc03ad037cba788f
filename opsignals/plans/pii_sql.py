"""Redaction in plain SQL, relationally: one row per candidate, a recursion over digit groups.

RE2 has ASCII word edges and no lookaround, so the patterns are written anew here. This is the
slow, independent road the column expressions are checked against.
"""

from __future__ import annotations

import re

from opsignals.functions import pii
from opsignals.functions.fingerprint import EMAIL_PLAIN

_WORD_EDGES = (pii.EITHER_EDGE, pii.START, pii.STOP)  # the first holds the others


def _re2(pattern: str) -> str:
    """A rule's pattern for RE2: word edges by their short name, loops that give back."""
    for edge in _WORD_EDGES:
        pattern = pattern.replace(edge, r"\b")
    return re.sub(r"([+*}])\+", r"\1", pattern)


_PATTERNS = tuple((label, _re2(EMAIL_PLAIN if label == "EMAIL" else pattern)) for label, pattern in pii.PATTERNS)
LABELS = pii.LABELS
_IBAN = _re2(pii.IBAN_CANDIDATE)
_RUN = r"\b[0-9]+(?:[ -][0-9]+)*\b"
_PREFIX = pii.CARD_PREFIX


def _patterns(c: str) -> str:
    for label, pattern in _PATTERNS:
        c = f"regexp_replace({c}, '{pattern}', '[{label} FILTERED]', 'g')"
    return c


# Ends in ``redacted (doc_id, text, clean)``.
REDACTED = f"""WITH RECURSIVE
ibans AS (
  SELECT doc_id, k, c, replace(c, ' ', '') AS compact
  FROM (SELECT doc_id, unnest(hits) AS c, unnest(range(1, len(hits) + 1)) AS k
        FROM (SELECT doc_id, regexp_extract_all(text, '{_IBAN}') AS hits FROM documents))),
iban_digits AS (
  SELECT doc_id, k, c, compact,
         list_transform(string_split(substring(compact, 5) || substring(compact, 1, 4), ''),
                        lambda x: CASE WHEN x >= 'A' THEN CAST(ascii(x) - 55 AS VARCHAR) ELSE x END) AS parts
  FROM ibans),
iban_fixed AS (
  SELECT doc_id, k,
         CASE WHEN length(compact) BETWEEN 15 AND 34
               AND list_reduce(list_transform(string_split(array_to_string(parts, ''), ''),
                                              lambda x: CAST(x AS INTEGER)),
                               lambda r, x: (r * 10 + x) % 97) = 1
              THEN '[IBAN FILTERED]' ELSE c END AS fixed
  FROM iban_digits),
without_ibans AS (
  SELECT doc_id, string_agg(piece || coalesce(fixed, ''), '' ORDER BY k) AS t
  FROM (SELECT doc_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS k
        FROM (SELECT doc_id, string_split_regex(text, '{_IBAN}') AS pieces FROM documents))
  LEFT JOIN iban_fixed USING (doc_id, k) GROUP BY doc_id),
patterned AS (SELECT doc_id, {_patterns("t")} AS t FROM without_ibans),
runs AS (
  SELECT doc_id, unnest(hits) AS run, unnest(range(1, len(hits) + 1)) AS k
  FROM (SELECT doc_id, regexp_extract_all(t, '{_RUN}') AS hits FROM patterned)),
split_runs AS (
  SELECT doc_id, k, string_split_regex(run, '[ -]') AS groups, regexp_extract_all(run, '[ -]') AS gaps
  FROM runs WHERE length(regexp_replace(run, '[ -]', '', 'g')) >= 13),
stretches AS (
  SELECT doc_id, k, i, n, array_to_string(groups[i:i + n - 1], '') AS digits
  FROM (SELECT *, unnest(range(1, len(groups) + 1)) AS i FROM split_runs), range(1, 20) AS s(n)
  WHERE i + n - 1 <= len(groups)),
cards AS (
  SELECT doc_id, k, i, max(n) AS n FROM stretches
  WHERE length(digits) BETWEEN 13 AND 19 AND regexp_matches(digits, '{_PREFIX}')
    AND list_sum(list_transform(range(1, length(digits) + 1), lambda p:
          CASE WHEN (length(digits) - p) % 2 = 1
               THEN CAST(digits[p] AS INTEGER) * 2 - CASE WHEN digits[p] > '4' THEN 9 ELSE 0 END
               ELSE CAST(digits[p] AS INTEGER) END)) % 10 = 0
  GROUP BY doc_id, k, i),
walk AS (
  SELECT doc_id, k, groups, gaps, CAST(1 AS BIGINT) AS i, '' AS fixed FROM split_runs
  UNION ALL
  SELECT w.doc_id, w.k, groups, gaps, w.i + coalesce(c.n, 1),
         fixed || CASE WHEN c.n IS NULL THEN groups[w.i] ELSE '[CREDIT CARD FILTERED]' END
               || coalesce(gaps[w.i + coalesce(c.n, 1) - 1], '')
  FROM walk w LEFT JOIN cards c ON c.doc_id = w.doc_id AND c.k = w.k AND c.i = w.i
  WHERE w.i <= len(groups)),
run_fixed AS (SELECT doc_id, k, fixed FROM walk WHERE i > len(groups)),
redacted AS (
  SELECT doc_id, any_value(d.text) AS text, any_value(d.source) AS source,
         string_agg(piece || coalesce(f.fixed, r.run, ''), '' ORDER BY k) AS clean
  FROM (SELECT doc_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS k
        FROM (SELECT doc_id, string_split_regex(t, '{_RUN}') AS pieces FROM patterned)) p
  LEFT JOIN runs r USING (doc_id, k) LEFT JOIN run_fixed f USING (doc_id, k) JOIN documents d USING (doc_id)
  GROUP BY doc_id)
"""


def _hits(label: str) -> str:
    mark = f"[{label} FILTERED]"
    return (
        f"CAST(sum((length(clean) - length(replace(clean, '{mark}', ''))"
        f" - length(text) + length(replace(text, '{mark}', ''))) // {len(mark)}) AS BIGINT)"
    )


AUDIT = (
    REDACTED
    + ", totals AS (SELECT source, count(*) AS n, CAST(sum(CASE WHEN text <> clean THEN 1 ELSE 0 END) AS BIGINT) AS hit, "
    + ", ".join(f'{_hits(label)} AS "{label}"' for label in LABELS)
    + " FROM redacted GROUP BY source) "
    + " UNION ALL ".join(
        f"""SELECT source, n AS rows, hit AS rows_hit, round(hit / n, 6) AS share, '{label}' AS label,
            "{label}" AS hits FROM totals"""
        for label in LABELS
    )
)
