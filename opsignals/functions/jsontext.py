"""JSON text of any depth with sensitive keys hidden and the remaining strings redacted.

No column expression can walk text of unknown depth, so this is Python. It reads tokens with a
stack of its own: depth costs no recursion, numbers keep their text, repeated keys stay.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

_TOKEN = re.compile(
    r'[ \t\r\n]*+(?:("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+")'
    r"|(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|true|false|null)|([{}\[\],:]))"
)
_END = re.compile(r"[ \t\r\n]*\Z")


def rewrite(text: str, is_sensitive: Callable[[str], bool], redact: Callable[[str], str], mark: str) -> str | None:
    """The text, compact, with ``mark`` for what stands under a sensitive key (null stays) and
    ``redact`` applied to the other strings; None if it isn't one JSON value."""
    out: list[str] = []
    stack: list[tuple[str, bool]] = []  # the open bracket, and whether its elements are under a sensitive key
    hidden = 0  # depth at which a hidden value began, or 0
    want, sensitive = "value", False  # value, first (value or end), key, first key, colon, comma
    at = 0
    while True:
        if want == "end":
            return "".join(out) if _END.match(text, at) else None
        token = _TOKEN.match(text, at)
        if token is None:
            return None
        at = token.end()
        string, plain, sign = token.groups()
        if string is not None and want in ("key", "first key"):
            key = json.loads(string)
            sensitive = is_sensitive(key)
            if not hidden:
                out.append(string)
            want = "colon"
        elif string is not None or plain is not None:
            if want not in ("value", "first"):
                return None
            if not hidden:
                if plain == "null" or plain is not None and not sensitive:
                    out.append(plain)
                elif sensitive:
                    out.append(json.dumps(mark, ensure_ascii=False))
                else:
                    out.append(json.dumps(redact(json.loads(string)), ensure_ascii=False))
            want = "comma" if stack else "end"
        elif sign in "{[":
            if want not in ("value", "first"):
                return None
            stack.append((sign, sensitive))
            if sensitive and not hidden:
                hidden = len(stack)
                out.append(json.dumps(mark, ensure_ascii=False))
            elif not hidden:
                out.append(sign)
            want = "first key" if sign == "{" else "first"
        elif sign in "}]":
            fits = stack and stack[-1][0] == ("{" if sign == "}" else "[")
            if not fits or want not in ("comma", "first key" if sign == "}" else "first"):
                return None
            if not hidden:
                out.append(sign)
            elif hidden == len(stack):
                hidden = 0
            stack.pop()
            want = "comma" if stack else "end"
        elif sign == ":" and want == "colon":
            if not hidden:
                out.append(sign)
            want = "value"
        elif sign == "," and want == "comma" and stack:
            if not hidden:
                out.append(sign)
            bracket, sensitive = stack[-1]
            want = "key" if bracket == "{" else "value"
        else:
            return None
