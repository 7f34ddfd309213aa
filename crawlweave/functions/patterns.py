"""Shell-style globs compiled on the driver to one anchored regex.

The produced regexes use neither look-around nor atomic groups, so the same
text is accepted by Java and by RE2 based engines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

NO_CHARACTER = r"[^\x00-\x{10FFFF}]"
MAX_PATTERN_LENGTH = 1000


def _escape(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/:\-= ,;%&@~\"'<>!])", r"\\\1", text)


def _charset(body: str) -> str:
    """Translate what stands between ``[`` and ``]`` of a glob."""
    negate = body.startswith("!")
    if negate:
        body = body[1:]
    parts = []
    i = 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            low, high = body[i], body[i + 2]
            if low <= high:
                parts.append(f"{_in_set(low)}-{_in_set(high)}")
            i += 3
        else:
            parts.append(_in_set(body[i]))
            i += 1
    if not parts:
        return "." if negate else NO_CHARACTER
    return f"[{'^' if negate else ''}{''.join(parts)}]"


def _in_set(char: str) -> str:
    return char if char.isalnum() else f"\\x{{{ord(char):x}}}"


def glob_body(pattern: str) -> str:
    """Regex for a glob without anchors: ``*``, ``?``, ``[set]`` and ``[!set]``."""
    out = []
    i = 0
    while i < len(pattern):
        char = pattern[i]
        if char == "*":
            if not out or out[-1] != ".*":
                out.append(".*")
        elif char == "?":
            out.append(".")
        elif char == "[":
            start = i + 2 if pattern[i + 1 : i + 2] == "!" else i + 1
            close = pattern.find("]", start + 1)
            if close < 0:
                out.append(r"\[")
            else:
                out.append(_charset(pattern[i + 1 : close]))
                i = close
        else:
            out.append(_escape(char))
        i += 1
    return "".join(out)


def glob_regex(pattern: str) -> str:
    return rf"\A(?s:{glob_body(pattern)})\z"


def any_glob_regex(patterns: list[str], wildcards: str = "*?[") -> str:
    """One alternation for several globs; ``wildcards`` names the active ones."""
    if wildcards == "*":
        bodies = [".*".join(_escape(piece) for piece in p.split("*")) for p in patterns]
    else:
        bodies = [glob_body(p) for p in patterns]
    return rf"\A(?s:{'|'.join(f'(?:{b})' for b in bodies)})\z"


def literal_prefix(pattern: str) -> str:
    """Text before the first wildcard; a column starting with it can be pruned by file statistics."""
    return re.split(r"[*?\[]", pattern, maxsplit=1)[0]


def matches_glob(col: Column, pattern: str) -> Column:
    """Whole-string, case-sensitive glob match."""
    prefix = literal_prefix(pattern)
    if prefix == pattern:
        return col == F.lit(pattern)
    rest = pattern[len(prefix) :]
    if rest == "*":
        return col.startswith(prefix)
    test = col.rlike(glob_regex(pattern))
    return (col.startswith(prefix) & test) if prefix else test
