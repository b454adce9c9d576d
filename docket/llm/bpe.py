"""Byte-level BPE over a corpus, through a minimal acyclic transducer of its frequent words.

1. All words of all texts are counted (per task, then by a grouped sum).
2. Words that make up at least ``min_share`` of all words get their ids by exact merging; the bound on their number is
   1 / min_share whatever the corpus. They are compiled into a shared-suffix transducer, one file in the shared folder.
3. Spark hands that file to every executor; each Python worker maps it into memory. Texts are encoded word by word:
   known words by the transducer, all others by exact merging. The lexicon changes speed, never ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from docket.llm.common import checkpointed, fresh_path, map_column, spread
from docket.llm.lexicon import Lexicon, compile_lexicon

MIN_SHARE = 1e-5
#: Distinct words that a worker remembers the merges of, and that a counting task holds, before it starts anew.
_MEMORY = 400_000
_NONE = np.iinfo(np.int64).max

# Fixed value: the published split pattern of byte-level BPE.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


#: Where this process's Unicode tables may be of another version than the tokenizer's, texts are split by the library.
_OTHER = re.compile("[^\\x00-\u052f\u1e00-\u206f\u3000-\u9fff\uac00-\ud7a3]")
_LIBRARY_SPLIT = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def split_words(text: str) -> list[str]:
    if _OTHER.search(text):
        return [text[a:b] for _, (a, b) in _LIBRARY_SPLIT.pre_tokenize_str(text)]
    return SPLIT.findall(text)


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable, else the next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return letters


class ByteBPE:
    """Vocabulary, merges and special tokens of a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = _byte_letters(), spec["model"]

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = raw(a), raw(b)
            self.merge.setdefault((self.ids[left], self.ids[right]), (rank, self.ids[left + right]))
        self.single = [self.ids[bytes([b])] for b in range(256)]
        pair_of = sorted((a << 32 | b, rank, new) for (a, b), (rank, new) in self.merge.items())
        self.pair_keys, self.pair_ranks = (np.array([p[i] for p in pair_of], dtype=np.int64) for i in (0, 1))
        self.rank_new = np.zeros(len(pairs) + 1, dtype=np.int64)
        for _, rank, new in pair_of:
            self.rank_new[rank] = new
        size = 1 + max([*self.ids.values(), *self.special.values()])
        pieces = [b""] * size
        for t, i in self.ids.items():
            pieces[i] = t
        for t, i in self.special.items():
            pieces[i] = t.encode()
        self.piece_sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None

    def merged(self, word: bytes) -> list[int]:
        """Exact BPE: the pair of lowest rank first, leftmost among equals."""
        parts = [self.single[b] for b in word]
        if len(parts) > 64:
            return self._merged_long(parts)
        merge = self.merge
        while len(parts) > 1:
            best, at, new = 1 << 62, -1, 0
            for i in range(len(parts) - 1):
                found = merge.get((parts[i], parts[i + 1]))
                if found is not None and found[0] < best:
                    best, at, new = found[0], i, found[1]
            if at < 0:
                break
            parts[at : at + 2] = [new]
        return parts

    def _merged_long(self, parts: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        import heapq

        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(f[0], i, parts[i], parts[i + 1], f[1]) for i in range(n - 1) if (f := self.merge.get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or parts[i] != left or parts[j] != right:
                continue
            parts[i], gone[j], after[i] = new, True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (f := self.merge.get((parts[a], parts[after[a]]))):
                    heapq.heappush(heap, (f[0], a, parts[a], parts[after[a]], f[1]))
        return [p for p, g in zip(parts, gone) if not g]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, _NONE where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE) if len(self.pair_keys) else np.full(key.shape, _NONE)

    def merged_many(self, words: list[bytes]) -> list[list[int]]:
        """``merged`` for many words: words of one length lose one id each in every step, all at once."""
        out: list[list[int]] = [[]] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w), []).append(i)
        single = np.array(self.single, dtype=np.int64)
        for size, who in by_size.items():
            if size > 64:
                for i in who:
                    out[i] = self.merged(words[i])
                continue
            ids = single[np.frombuffer(b"".join([words[i] for i in who]), dtype=np.uint8)].reshape(len(who), size)
            at, ranks = np.array(who), self._ranks(ids[:, :-1], ids[:, 1:])
            while len(at):
                if not ranks.shape[1]:
                    done = np.ones(len(at), dtype=bool)
                else:
                    best = ranks.argmin(axis=1)
                    lowest = ranks[np.arange(len(at)), best]
                    done = lowest == _NONE
                if done.any():
                    for i, row in zip(at[done].tolist(), ids[done].tolist()):
                        out[i] = row
                    if done.all():
                        break
                    go = ~done
                    at, ids, ranks, best, lowest = at[go], ids[go], ranks[go], best[go], lowest[go]
                n, width = ids.shape
                row = np.arange(n)
                ids[row, best] = self.rank_new[lowest]
                keep = np.ones((n, width), dtype=bool)
                keep[row, best + 1] = False
                ids = ids[keep].reshape(n, width - 1)
                keep = np.ones((n, width - 1), dtype=bool)
                keep[row, best] = False
                ranks = ranks[keep].reshape(n, width - 2)
                r = np.flatnonzero(best > 0)
                ranks[r, best[r] - 1] = self._ranks(ids[r, best[r] - 1], ids[r, best[r]])
                r = np.flatnonzero(best < width - 2)
                ranks[r, best[r]] = self._ranks(ids[r, best[r]], ids[r, best[r] + 1])
        return out

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text; strings of special tokens stand alone."""
        if self.cut is None or not self.cut.search(text):
            return split_words(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += split_words(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + split_words(text[at:])

    def decoded(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, then decoded and encoded again if they are no UTF-8 (malformed parts become U+FFFD)."""
        data = _gather(self.piece_bytes, self.piece_starts[ids], self.piece_sizes[ids]).tobytes()
        try:
            data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="replace").encode()
        return data


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + sizes[i]] for all i, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> ByteBPE:
    return ByteBPE(path)


@lru_cache(maxsize=2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon.map(SparkFiles.get(name))


def word_counts(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """``texts(text)`` to ``(word, n)`` over all texts."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, seen = _tokenizer(tokenizer_path), Counter()
        for b in batches:
            for t in b["text"]:
                seen.update(tok.words(t))
                if len(seen) > _MEMORY:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    return texts.mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(texts: DataFrame, tokenizer_path: str, min_share: float = MIN_SHARE) -> str:
    """Compile the frequent words of all texts; the name under which Spark hands the file to executors."""
    spark = texts.sparkSession
    counts = word_counts(texts, tokenizer_path)
    # a word enters the sum only through words seen often enough to matter; both figures come from one table
    counts = checkpointed(counts.where("n > 1"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = [r.word for r in counts.where(F.col("n") >= max(2.0, min_share * total)).select("word").collect()]  # at most 1 / min_share words
    tok = _tokenizer(tokenizer_path)
    data = compile_lexicon([(w.encode(), tok.merged(w.encode())) for w in frequent if w not in tok.special])
    return _published(spark, data)


def _published(spark: SparkSession, data: bytes) -> str:
    """Write bytes to the shared folder and let Spark hand the file to all executors, also to later ones."""
    sc = spark.sparkContext
    path = f"{fresh_path(spark, 'lexicon')}-{hashlib.sha256(data).hexdigest()[:16]}.bin"
    jvm = sc._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    sc.addFile(path)
    return path.rsplit("/", 1)[1]


class Encoder:
    """Encodes batches of texts with a lexicon; ids do not depend on the lexicon or on what was seen before."""

    def __init__(self, tok: ByteBPE, lexicon: Lexicon) -> None:
        self.tok, self.lexicon, self.known = tok, lexicon, {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many belong to each text."""
        index: defaultdict[str, int] = defaultdict()
        index.default_factory = index.__len__  # a new word gets the next number
        place = index.__getitem__
        codes = [np.fromiter(map(place, words), dtype=np.int64, count=len(words)) for words in map(self.tok.words, texts)]
        words = list(index)
        ranks = self.lexicon.ranks([w.encode() for w in words])
        starts, sizes = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        hit = ranks >= 0
        lex = self.lexicon
        starts[hit] = lex.starts[ranks[hit]]
        sizes[hit] = lex.starts[ranks[hit] + 1] - starts[hit]
        extra: list[int] = []
        base, known = len(lex.ids), self.known
        if len(known) > _MEMORY:
            known.clear()
        missing = np.flatnonzero(~hit).tolist()
        new = [words[i] for i in missing if words[i] not in known]
        known.update(zip(new, self.tok.merged_many([w.encode() for w in new])))
        known.update((w, [i]) for w, i in self.tok.special.items())
        for i in missing:
            ids = known[words[i]]
            starts[i], sizes[i] = base + len(extra), len(ids)
            extra += ids
        flat = np.concatenate([lex.ids, np.array(extra, dtype="<i4")])
        every = np.concatenate(codes) if codes else np.zeros(0, dtype=np.int64)
        per_text = np.array([int(sizes[c].sum()) for c in codes], dtype=np.int64)
        return _gather(flat, starts[every], sizes[every]), per_text


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", min_share: float = MIN_SHARE, with_ids: bool = True) -> DataFrame:
    """All columns of ``docs`` but the text, and ``n_tokens``, ``ids`` (array<int>, if ``with_ids``), ``ids_sha256``
    (of little-endian unsigned 32-bit ids) and ``decoded_sha256`` (of the text that the ids decode to).

    Null and empty texts have no ids; very long texts and words are encoded whole; repeated rows give a row each;
    empty input gives no rows. Columns whose names clash with results are left out.
    """
    names = ["n_tokens", *(["ids"] * with_ids), "ids_sha256", "decoded_sha256"]
    rows = spread(docs.select(*(c for c in docs.columns if c == text_col or c not in names)))
    name = build_lexicon(rows.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")), tokenizer_path, min_share)

    def start():
        enc = Encoder(_tokenizer(tokenizer_path), _lexicon(name))

        def encoded(texts):
            flat, sizes = enc.encode([t or "" for t in texts])
            parts = np.split(flat, np.cumsum(sizes)[:-1])
            ids = [hashlib.sha256(p.astype("<u4").tobytes()).hexdigest() for p in parts]
            back = [hashlib.sha256(enc.tok.decoded(p)).hexdigest() for p in parts]
            return [sizes, *([parts] * with_ids), ids, back]

        return encoded

    out = map_column(rows, text_col, f"n_tokens long, {'ids array<int>, ' * with_ids}ids_sha256 string, decoded_sha256 string", start)
    return out.drop(text_col)


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Replace a column of ids by the text that they decode to (null ids: empty)."""

    def start():
        tok = _tokenizer(tokenizer_path)
        return lambda lists: [[tok.decoded(np.asarray(i or [], dtype=np.int64)).decode() for i in lists]]

    return map_column(encoded, ids_col, f"`{text_col}` string", start).drop(ids_col)
