"""Toxicity by compression distance.

Two zstandard dictionaries of equal size are trained, one on toxic and one on ordinary text, in the manner of the COVER
algorithm: byte strings that occur in one class far more often than in the other are marks, and stretches of running text
are taken until every mark is covered. Both then hold the same common ordinary words, so that what both classes use costs
the same. A text is cut into windows of one word with its borders; each is compressed with either dictionary, and the
difference of the two lengths tells which it is closer to. How much a difference says about a window of its length is
calibrated on labelled rows, with dictionaries built from other rows, so that a dictionary never meets the text it was
built from, or a near copy of it; a document's score follows from its windows above the cutoff.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import cycle

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import map_column, spread

#: Labelled rows, and bytes of their texts, that the model is fitted on at most (rows with the smallest hash come first).
TRAIN_ROWS, TRAIN_BYTES = 8000, 64 << 20
#: Bytes of common ordinary words in both dictionaries, which end in text of their class.
SHARED_BYTES = 60_000
#: Bytes in a mark; its least rate against the other class, and least significance (likelihood ratio statistic).
MARK_BYTES = (4, 5, 6, 7, 8, 10)
ODDS, SIGNIFICANT = 8.0, 30.0
FOLDS = 5
_BANDS = 3
#: A text counts for a word so often at most.
TIMES = 3
LEVEL = 9
#: Windows count if their calibrated log-odds are larger.
CUTOFF = 0.5
#: Gains and window lengths are told apart up to these bounds; those beyond are calibrated together.
_GAINS, _LENGTHS = (-2, 12), 16
_FEATURES = 2
_LETTERS = re.compile(r"[^\W\d_]+")
#: Both dictionaries end in this string and it is added to each window. A window then always holds a match, so that
#: one more match shows at its full worth instead of first having to pay for the header of the match section.
_PRIMER = b"~0123456789abcdefghijklmnopqrstuvwxyz~"
#: Windows that a task remembers.
_CACHED = 1 << 18


def windows(text: str) -> list[str]:
    """The words of a text in lower case, without what is no letter; each is a window."""
    return _LETTERS.findall(text.lower())


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


class _Cells(dict):
    """Window to its cell (length, gain) of the calibration table; a bounded number is remembered."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        super().__init__()
        self.bad, self.good = _compressor(toxic).compress, _compressor(ordinary).compress

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED:
            self.clear()
        w = word.encode()
        s = b" %b %b" % (w, _PRIMER)
        low, high = _GAINS
        gain = min(max(len(self.good(s)) - len(self.bad(s)), low), high) - low
        found = self[word] = min(len(w), _LENGTHS) * (high - low + 1) + gain
        return found


_CELLS = (_LENGTHS + 1) * (_GAINS[1] - _GAINS[0] + 1)


def _evidence(odds: np.ndarray) -> list[float]:
    """The largest log-odds of a window above the cutoff, and the sum of all, as a logarithm."""
    odds = odds[odds > CUTOFF]
    return [float(odds.max()), float(np.log1p(odds.sum()))] if len(odds) else [0.0, 0.0]


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    table: np.ndarray  # log-odds of a window by its cell
    weights: np.ndarray

    def cells(self) -> _Cells:
        return _Cells(self.toxic, self.ordinary)

    def features(self, text: str, cells: _Cells | None = None) -> np.ndarray:
        cells = self.cells() if cells is None else cells
        return np.array(_evidence(self.table[[cells[w] for w in windows(text)]]))

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ self.weights[1:], -30, 30)))


def _copies(texts: list[np.ndarray]) -> np.ndarray:
    """Numbers of the texts by groups of near copies: two are linked if a pair of least hashes of their runs of three words
    agrees, as for copies with a few edits is all but certain."""
    group = list(range(len(texts)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    odd = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 2 * _BANDS + 1)], dtype=np.uint64)
    met: dict[tuple, int] = {}
    for i, t in enumerate(texts):
        t = np.r_[t, [-1] * max(0, 3 - len(t))].astype(np.int64).view(np.uint64)
        h = (t[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + t[1:-1]) * np.uint64(0x165667B19E3779F9) + t[2:]
        h ^= h >> np.uint64(29)
        least = [int((h * k ^ (h * k >> np.uint64(32))).min()) for k in odd]
        for band in range(_BANDS):
            j = met.setdefault((band, least[2 * band], least[2 * band + 1]), i)
            if j != i:
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return np.unique([root(i) for i in range(len(texts))], return_inverse=True)[1] if texts else np.zeros(0, dtype=np.int64)


def _supports(texts: list[np.ndarray], toxic: np.ndarray, group: np.ndarray, n: int) -> list[list[np.ndarray]]:
    """How often ordinary and toxic texts hold each of ``n`` words: without each of the folds in turn, and in all.

    Of a group of copies the first text of either class counts, and a word counts in one text up to ``TIMES`` times. One
    text that is copied often, or that repeats a word often, so does not make its words distinctive."""
    counts = [[np.zeros(n), np.zeros(n)] for _ in range(FOLDS + 1)]
    seen = set()
    for t, y, g in zip(texts, toxic.astype(int).tolist(), group.tolist()):
        if (g, y) not in seen:
            seen.add((g, y))
            word, times = np.unique(t, return_counts=True)
            counts[g % FOLDS][y][word] += np.minimum(times, TIMES)
    total = [sum(c[k] for c in counts[:FOLDS]) for k in (0, 1)]
    return [[total[k] - c[k] for k in (0, 1)] for c in counts]


def _strings(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(word, number of the string, how many there are) of the byte strings of each length that words with their borders hold."""
    raw = [b" %b " % w for w in words]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    data, word = np.frombuffer(b"".join(raw), dtype=np.uint8), np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    del raw
    h = np.zeros(len(data), dtype=np.uint64)
    for k in range(1, max(MARK_BYTES) + 1):
        h = h[: max(0, len(data) - k + 1)]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += data[k - 1 :]
        h += np.uint64(1)
        if k in MARK_BYTES:
            inside = word[: len(h)] == word[k - 1 :]  # the string ends in the word that it starts in
            names, at = h[inside], word[: len(h)][inside]
            names ^= names >> np.uint64(29)
            order = np.argsort(names, kind="stable").astype(np.int32)
            names = names[order]
            of = np.empty(len(names), dtype=np.int32)
            of[order] = np.cumsum(np.r_[False, names[1:] != names[:-1]][: len(names)], dtype=np.int32)
            n = int(of.max()) + 1 if len(of) else 0
            del names, order, inside
            yield at, of, n


def _marked(words: list[bytes], cases: list[tuple[np.ndarray, np.ndarray]]) -> list[list[int]]:
    """For each case (supports in the own and in the other class): words, most distinctive first, until they hold all marks."""
    found: list[list[tuple[np.ndarray, ...]]] = [[] for _ in cases]
    base = 0
    for word, of, n in _strings(words):
        for (own, other), out in zip(cases, found):
            n_own, n_other = max(own.sum(), 1.0), max(other.sum(), 1.0)
            rate = n_own / (n_own + n_other)
            a, b = np.bincount(of, weights=own[word], minlength=n), np.bincount(of, weights=other[word], minlength=n)
            total = np.maximum(a + b, 1e-9)
            stat = 2 * (a * np.log(np.maximum(a, 1e-9) / (total * rate)) + b * np.log(np.maximum(b, 1e-9) / (total * (1 - rate))))
            chosen = (a / n_own > ODDS * (b + 0.5) / n_other) & (stat >= SIGNIFICANT)
            take = np.flatnonzero(chosen[of] & (own[word] > 0))
            out.append((word[take], of[take] + base, stat[of[take]]))
        base += n
    return [_cover(words, own, *map(np.concatenate, zip(*out))) for (own, _), out in zip(cases, found)]


def _cover(words: list[bytes], own: np.ndarray, at: np.ndarray, name: np.ndarray, worth: np.ndarray) -> list[int]:
    held: dict[int, dict[int, float]] = {}
    for w, g, s in zip(at.tolist(), name.tolist(), worth.tolist()):
        held.setdefault(w, {})[g] = s
    left, out = set(name.tolist()), []
    for w in sorted(held, key=lambda w: (-sum(held[w].values()), -own[w], words[w])):
        if not left.isdisjoint(held[w]):
            out.append(w)
            left -= held[w].keys()
    return out


def _stretches(texts: list[np.ndarray], chosen: list[int], common: np.ndarray, words: list[bytes]) -> list[bytes]:
    """For each chosen word the three words of running text around it whose others are the most common."""
    best: dict[int, tuple[float, bytes]] = {}
    for t in texts:
        for p in np.flatnonzero(np.isin(t, chosen)).tolist():
            around = t[max(0, p - 1) : p + 2].tolist()
            ease = min((float(common[w]) for w in around if w != t[p]), default=0.0)
            found = ease, b" ".join(words[w] for w in around)
            if t[p] not in best or found > best[t[p]]:
                best[int(t[p])] = found
    return [best[w][1] for w in chosen]


def _dictionaries(texts: list[np.ndarray], toxic: np.ndarray, words: list[bytes], supports: list[np.ndarray], marked: list[list[int]]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary, of equal size up to a word."""
    good = supports[0]
    common = np.argsort(-good, kind="stable")
    common = common[good[common] > 0].tolist()
    sides = [_stretches([t for t, y in zip(texts, toxic) if y == k], marked[k], good, words) for k in (1, 0)]

    size_of_all = sum(len(words[w]) + 1 for w in common)

    def filled(size: int, skip: int = 0) -> list[bytes]:
        out = []
        for w in cycle(common[skip:] or common):
            if size <= 0:
                break
            out.append(words[w])
            size -= len(words[w]) + 1
        return out

    shared = filled(min(SHARED_BYTES, size_of_all))
    sizes = [sum(len(s) + 1 for s in side) for side in sides]
    made = [side + filled(max(sizes) - size, len(shared)) for side, size in zip(sides, sizes)]
    bad_end, good_end = (b" " + b" ".join([*shared[::-1], *side[::-1], b""]) + _PRIMER for side in made)
    return bad_end, good_end


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept is not shrunk."""
    x = np.c_[np.ones(len(x)), x]
    w, shrink = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (p - y) + shrink @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(texts: Iterable[str], toxic: Iterable[int]) -> Model:
    """Train on labelled texts; with one class only, the score is that class's smoothed rate."""
    return _fit(zip(texts, toxic))


def _fit(rows: Iterable[tuple[str, int]]) -> Model:
    """The texts are read one by one and held as numbers of their words."""
    number: dict[str, int] = {}
    coded, marks = [], []
    for text, mark in rows:
        coded.append(np.array([number.setdefault(w, len(number)) for w in windows(text)], dtype=np.int32))
        marks.append(mark)
    y = np.asarray(marks, dtype=float)
    names = list(number)
    del number
    words = [w.encode() for w in names]
    group = _copies(coded)
    folds = group % FOLDS
    supports = _supports(coded, y, group, len(words))
    marked = _marked(words, [(s[k], s[1 - k]) for s in supports for k in (0, 1)])
    marked = [marked[i : i + 2] for i in range(0, len(marked), 2)]
    table, weights = np.zeros(_CELLS), np.zeros(_FEATURES + 1)
    if 0 < y.sum() < len(y):
        # the cells of each text's windows, with dictionaries of the other folds
        cells: list[np.ndarray] = [np.zeros(0, dtype=np.int16)] * len(y)
        for fold in range(FOLDS):
            others, own = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            measured = _Cells(*_dictionaries([coded[i] for i in others], y[others], words, supports[fold], marked[fold]))
            used = np.unique(np.concatenate([np.zeros(0, dtype=np.int32), *(coded[i] for i in own)]))
            of = np.zeros(len(words), dtype=np.int16)
            of[used] = [measured[names[w]] for w in used.tolist()]
            for i in own:
                cells[i] = of[coded[i]]
            del measured
        counts = np.zeros((2, _CELLS), dtype=np.int64)
        for c, k in zip(cells, marks):
            counts[k] += np.bincount(c, minlength=_CELLS)
        sizes = [max(c.sum(), 1) for c in counts]
        table = np.log((counts[1] + 1) / sizes[1]) - np.log(counts[0] / sizes[0] + 1 / sizes[1])
        weights = _logistic(np.array([_evidence(table[c]) for c in cells]), y)
    else:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        weights[0] = np.log(rate / (1 - rate))
    return Model(*_dictionaries(coded, y, words, supports[FOLDS], marked[FOLDS]), table, weights)


def held_out(id_col: str) -> Column:
    """The rows that nothing is learned from: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Model:
    """Fit on at most ``rows`` labelled rows and ``size`` bytes of their texts that are not held out.

    Rows come in order of the hash of their id, then of their text; a row that would exceed the bytes is passed over.
    Null texts count as empty, labels that are null or not 0 or 1 and rows without an id are not used, and an id that is
    labelled both ways is toxic. Rows with one id are rows of their own. Without rows every score is 0.5.
    """
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).where(~held_out(id_col)).groupBy(id_col).agg(F.max("toxic").alias("_toxic"))
    chosen = marked.orderBy(F.xxhash64(id_col), id_col).limit(rows)
    text = F.coalesce(F.col(text_col), F.lit(""))
    some = docs.select(id_col, text.alias("_text"), F.octet_length(text).alias("_size")).join(F.broadcast(chosen), id_col)
    some = some.where(F.col("_size") <= size).orderBy(F.xxhash64(id_col), id_col, F.xxhash64("_text"), "_text").limit(rows)

    def taken() -> Iterator[tuple[str, int]]:
        left = size
        for r in some.toLocalIterator():
            if r["_size"] <= left:
                left -= r["_size"]
                yield r["_text"], int(r["_toxic"])

    return _fit(taken())


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more).

    Null texts count as empty, and an empty text gets the score of a text without any marked window. Whole texts are
    scored, window by window. Repeated rows get equal scores; columns named score or predicted are replaced; an empty
    table gives an empty result.
    """

    def start():
        cells = model.cells()

        def scored(texts):
            s = model.scores(np.array([model.features(t or "", cells) for t in texts]).reshape(len(texts), _FEATURES))
            return s, (s >= 0.5).astype("int32")

        return scored

    return map_column(spread(docs), text_col, "score double, predicted int", start)
