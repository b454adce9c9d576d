"""Markup to text. A profile is an ordered list of (pattern, replacement); patterns use only what Java and RE2 share, so
one list gives the Spark column and the DuckDB twin. Script and style go before tags, ``&amp;`` is decoded last."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Steps = list[tuple[str, str]]

_SPACE = "[\\s\u00a0]"
_ENTITIES: Steps = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&")]
_NOISE: Steps = [(f"(?is)<{t}\\b.*?</{t}>", " ") for t in ("script", "style")]
_TRIM: Steps = [(f"^{_SPACE}+|{_SPACE}+$", "")]

#: Page furniture that is removed before text is taken.
FURNITURE: Steps = [(f"(?is)<{t}\\b.*?</{t}>", " ") for t in ("script", "style", "nav", "footer", "table")]
EU: Steps = [*_NOISE, ("(?i)<br\\s*/?>", "\n"), ("(?i)</p>", "\n\n"), ("(?i)</li>", "\n"), ("<[^>]+>", " "), *_ENTITIES, ("[ \\t\u00a0]+", " "), (" *\n *", "\n"), ("\n{3,}", "\n\n"), *_TRIM]
STATUTE: Steps = [
    *_NOISE, ("(?i)</?(p|div|h[1-6]|li|ul|ol|article|section|header|tr|table)\\b[^>]*>", "\n"), ("(?i)</(td|th)>", " | "), ("(?i)<br\\s*/?>", "\n"), ("<[^>]+>", ""),
    *_ENTITIES, ("[ \\t\u00a0|]*\n[ \\t\u00a0|]*", "\n"), ("\n{2,}", "\n"), ("^[\\s|]+|[\\s|]+$", ""),
]
REGISTER: Steps = [*_NOISE, ("(?i)</h[1-6]>", "\n\n"), ("(?i)</p>", "\n"), ("(?i)<li[^>]*>", "\n - "), ("<[^>]+>", ""), *_ENTITIES, ("[ \\t]+", " "), ("\n{3,}", "\n\n"), *_TRIM]
CELL: Steps = [("(?i)<br\\s*/?>|</p>", "\n"), ("<[^>]+>", " "), *_ENTITIES, ("[ \\t]+", " "), (" *\n *", "\n"), ("\n{2,}", "\n"), *_TRIM]
DECLARATION: Steps = [("(?i)<br\\s*/?>|</p>", "\n"), ("<[^>]+>", ""), ("&nbsp;", " "), ("&amp;", "&"), *_TRIM]
PLAIN: Steps = [("<[^>]+>", ""), *_ENTITIES, *_TRIM]
INLINE: Steps = [("<[^>]+>", " "), *_ENTITIES, (f"{_SPACE}+", " "), *_TRIM]
XML_TEXT: Steps = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]


def _java(replacement: str) -> str:
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


def apply(text: Column, steps: Steps) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, _java(replacement))
    return text


def duck(text: str, steps: Steps) -> str:
    """The same steps as a DuckDB expression."""
    for pattern, replacement in steps:
        p, r = pattern.replace("'", "''"), replacement.replace("\\", "\\\\").replace("'", "''")
        text = f"regexp_replace({text}, '{p}', '{r}', 'g')"
    return text
