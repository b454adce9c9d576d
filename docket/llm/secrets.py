"""Secret scans: fixed patterns, and novelty measured with a primed zstandard compressor.

A candidate of the second kind is a run of key-like characters near a sensitive word, before or after it; a run on the
line after a candidate's is one too, so that a wrapped secret is followed to its end. It is compressed together with the
code around it, primed with a dictionary of common identifiers; its marginal cost is what it adds to the
compressed length of its surroundings alone. Names that the surroundings or the dictionary know cost little; a random
string costs about its own length and is reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import map_column, spread

# The patterns and least lengths of the base scan.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "novel")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
#: What may stand between a run and its continuation on the next line, and the last, shorter line of a wrapped run.
_WRAP = re.compile(r"[^A-Za-z0-9\n]{0,16}\n[^A-Za-z0-9\n]{0,64}")
_TAIL = re.compile(r"(\r?\n[\x20\t]*)([A-Za-z0-9+/_=-]{1,11})(?=[\x20\t]*(?:\r?\n|$))")
_SENSITIVE = re.compile(r"key|secret|token|passw|pwd|auth|credential|bearer|private|signature|session", re.IGNORECASE)
_AROUND = 512
#: Least marginal compressed bytes for each byte of the candidate.
NOVELTY = 0.7
_IDENTIFIERS = (
    "access account address admin algorithm api application authorization base64 bearer boolean buffer cache certificate class client code config "
    "connection const content context cookie create credential database date default delete description digest document email encode encoding endpoint "
    "environment error example export false file format function generate get hash header host http https id identifier import index input instance "
    "integer interface item json key length license list local login map message method module name namespace network null number object option output "
    "package parameter parse passphrase password path policy port prefix private process property protocol public query read record reference region "
    "request resource response return role root schema secret security select self server service session set sha256 signature source static status "
    "string struct system table template test this time timestamp token true type undefined update url user username utf-8 value variable version void write "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789"
).encode()
#: Ends every text that is measured: there is a match then without the candidate too, and it does not pay for the header
#: of the match section.
_KNOWN = b" abcdefghijklmnopqrstuvwxyz"


@lru_cache(maxsize=1)
def _primed() -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(_IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=9)
    return zstandard.ZstdCompressor(level=9, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


def marginal(text: str, start: int, end: int) -> float:
    """Compressed bytes that text[start:end] adds to its surroundings, for each byte of it."""
    before, after = text[max(0, start - _AROUND) : start].encode(), text[end : end + _AROUND].encode() + _KNOWN
    size = _primed().compress
    own = text[start:end].encode()
    return (len(size(before + own + after)) - len(size(before + after))) / len(own)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, whole matches in code points, sorted by start and kind."""
    found = []
    low = text.lower() if "=" in text or ":" in text else ""
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    found.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, KINDS[k]) for a, b, k in found]


def _uncovered(a: int, b: int, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts of a run that no base span covers, but for a name that an assignment ends."""
    parts, at = [], a
    for x, y, kind in base:
        if x < b and at < y:
            if at < x and kind != "assign":
                parts.append((at, x))
            at = max(at, y)
    return parts + [(at, b)] * (at < b)


def novel_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Incompressible candidates in sensitive context that base spans do not cover whole."""
    out = []
    runs = [m.span() for m in _CANDIDATE.finditer(text)]
    if not runs:
        return out
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    if not words:
        return out
    starts, ends = [x for x, _ in words], [y for _, y in words]
    last, known = 0, False  # where the last run ends, and whether it is in sensitive context
    for a, b in runs:
        # a word that ends in the stretch before the run, or begins in the one after it
        near = bisect_left(starts, a - _AROUND) < bisect_right(ends, a) or bisect_left(starts, b) < bisect_right(ends, b + _AROUND)
        known = near or (known and _WRAP.fullmatch(text, last, a) is not None)
        last = b
        if not known:
            continue
        follows = out and _WRAP.fullmatch(text, out[-1][1], a)
        parts = _uncovered(a, b, base)
        # a line that goes on from a reported one is also measured together with it
        if any(marginal(text, x, y) >= NOVELTY for x, y in parts) or (parts and follows and marginal(text, out[-1][0], b) >= NOVELTY):
            if follows and (tail := _TAIL.match(text, b)):
                b = tail.end(2)
            out.append((a, b, "novel"))
    return out


def spans(text: str) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    return sorted(base + novel_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns with ``secrets``: array of (start, end, kind), in code points, end exclusive.

    A span is the whole match (for assign: from the name to the end of its value). Whole texts are scanned; null and
    empty texts have no secrets; repeated rows get equal results; a column named secrets is replaced.
    """

    def start():
        return lambda texts: [[[{"start": s, "end": e, "kind": k} for s, e, k in spans(t or "")] for t in texts]]

    return map_column(spread(docs), text_col, "secrets array<struct<start:int,end:int,kind:string>>", start)


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows with every secret replaced by a mask (overlapping ones by one), other columns unchanged.

    Whole texts are masked, however long; null texts stay null, empty ones empty; repeated rows get equal results; an
    empty table gives an empty result.
    """

    def masked(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for a, b, _ in spans(text):
            if a >= at:
                out += [text[at:a], mask]
            at = max(at, b)
        return "".join(out) + text[at:] if out else text

    def start():
        return lambda texts: [[masked(t) for t in texts]]

    names = docs.columns
    new = "_" * (1 + max(map(len, names))) + "masked"  # longer than any column's name
    return map_column(spread(docs), text_col, f"{new} string", start).drop(text_col).withColumnRenamed(new, text_col).select(*names)


def joined(spans_col: str, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    return F.array_join(
        F.transform(F.filter(spans_col, lambda s: s["kind"].isin(*kinds)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def counted(spans_col: str, kind: str) -> Column:
    return F.size(F.filter(spans_col, lambda s: s["kind"] == kind)).cast("long")
