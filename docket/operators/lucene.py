"""A small search language compiled to a column: ``field:value``, ``field:"phrase"``, ``field:(a b)``, ``field:[A TO B]``,
``field:*``, AND, OR, NOT and brackets. Values match by containment without regard to case; ranges compare text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r'\s*(?:(AND|OR|NOT)\b|([()])|(\w+):(?:"([^"]*)"|\(([^)]*)\)|\[(\S+) TO (\S+)\]|(\*)|([^\s()]+)))')


def compile_query(text: str) -> Column:
    """NOT binds tightest, then AND (also where nothing stands between terms), then OR."""
    tokens, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"cannot read the query at {text[at:]!r}")
        tokens.append(m)
        at = m.end()
    tokens.reverse()

    def word() -> str | None:
        return (tokens[-1][1] or tokens[-1][2]) if tokens else None

    def either() -> Column:
        left = both()
        while word() == "OR":
            tokens.pop()
            left = left | both()
        return left

    def both() -> Column:
        left = one()
        while tokens and word() not in ("OR", ")"):
            if word() == "AND":
                tokens.pop()
            left = left & one()
        return left

    def one() -> Column:
        if not tokens:
            raise ValueError("the query ends too early")
        m = tokens.pop()
        if m[1] == "NOT":
            return ~one()
        if m[2] == "(":
            inner = either()
            if word() != ")":
                raise ValueError("a bracket is not closed")
            tokens.pop()
            return inner
        if m[3] is None:
            raise ValueError(f"unexpected {m[0].strip()!r}")
        return _term(m)

    found = either()
    if tokens:
        raise ValueError(f"unexpected {tokens[-1][0].strip()!r}")
    return found


def _term(m: re.Match) -> Column:
    field = F.coalesce(F.col(m[3]).cast("string"), F.lit(""))
    if m[8]:
        return field != ""
    if m[6]:
        return field.between(m[6], m[7])
    words = [m[4]] if m[4] is not None else m[5].split() if m[5] is not None else [m[9]]
    found = F.lit(True)
    for w in words:
        found = found & F.contains(F.lower(field), F.lit(w.lower()))
    return found
