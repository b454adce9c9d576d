"""Exact removal of repeated strings of 100 bytes by a common-prefix-aware distributed merge sort.

Texts are dealt into blocks. A string of 100 bytes holds sampled places: the minimizers of its stretches of 55 bytes,
which depend on its bytes only. Hashes of the sampled places are exchanged, and a string can occur twice only if all its
sampled places do. What is left are mostly true repeats; consecutive strings with one minimizer form one suffix run,
written from the minimizer to the right and then from it to the left. Each block sorts its distinct runs, front-codes
them and sends them to the task of their minimizer; there a loser tree merges them in sorted order with the lengths of
common prefixes, so that equal suffixes and all suffixes of one minimizer come together. Positions that are not the
first of their string go back to the blocks. Strings under a very frequent minimizer are sent one by one by their own
hash, so that no task gets all neighbourhoods of a common line.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.llm.common import text_bytes
from docket.llm.suffixes import front_coded, merged

LENGTH = 100
GRAM = 24
STRETCH = 32  # successive grams whose least is sampled
SPAN = GRAM + STRETCH - 1
GRAMS = LENGTH - GRAM + 1
#: Bytes of a block, and how often a sampled hash occurs before its strings are sent one by one.
BLOCK_BYTES = 6 << 20
HOT = 1000
_PIECE, _CHUNK, _BITS = 1 << 20, 2 << 20, 22
_LOW = np.uint64((1 << _BITS) - 1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_NULL = -(1 << 63)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = _CHUNK + _PIECE + LENGTH
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)

    def of(b: int) -> np.ndarray:
        p = np.empty(n, dtype=np.uint64)
        p[0] = 1
        done = 1
        while done < n:
            step = min(done, n - done)
            p[done : done + step] = p[:step] * np.uint64(pow(b, done, 1 << 64))
            done += step
        return p

    return of(base), of(inverse)


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` successive values."""
    span = 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    return np.minimum(v[: len(v) - (width - span)], v[width - span :]) if span < width else v


class _Chunk:
    """Some pieces of texts, one after another, with the sampled places and minimizers of their strings."""

    def __init__(self, data: bytes, sizes: list[int]) -> None:
        self.data = data
        b = np.frombuffer(data, dtype=np.uint8)
        n = len(b)
        ends = np.repeat(np.cumsum(sizes), sizes)
        p, inverse = _powers()
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * p[:n], out=sums[1:])
        h = (sums[GRAM:] - sums[: n - GRAM + 1]) * inverse[: n - GRAM + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        self.hash = h
        place = np.arange(len(h))
        v = (h & ~_LOW) | place.astype(np.uint64)
        v[place + GRAM > ends[: len(h)]] = _NONE
        self.stretch = _least(v, STRETCH)  # the low bits are the place of the least gram, leftmost of equals
        self.string = _least(v, GRAMS)
        self.stretch_ok = np.arange(len(self.stretch)) + SPAN <= ends[: len(self.stretch)]
        self.string_ok = np.arange(len(self.string)) + LENGTH <= ends[: len(self.string)]

    def samples(self) -> np.ndarray:
        """Hashes of the sampled places."""
        at = (self.stretch[self.stretch_ok] & _LOW).astype(np.int64)
        return self.hash[at[np.r_[True, at[1:] != at[:-1]]]] if len(at) else np.zeros(0, dtype=np.uint64)

    def runs(self, code) -> tuple[np.ndarray, ...]:
        """(first string, last string, minimizer, its code) of the runs of strings whose samples all repeat."""
        at = (self.stretch & _LOW).astype(np.int64)
        at[~self.stretch_ok] = 0
        new = np.r_[True, at[1:] != at[:-1]]
        codes = code(self.hash[at[new]])[np.cumsum(new) - 1]
        bad = np.r_[0, np.cumsum((codes == 0) & self.stretch_ok)]
        n = len(self.string)
        inner = LENGTH - SPAN + 1
        first = np.flatnonzero(self.string_ok & (bad[inner : inner + n] == bad[:n]))
        if not len(first):
            return (first,) * 4
        m = (self.string[first] & _LOW).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, (first[1:] != first[:-1] + 1) | (m[1:] != m[:-1])])
        last = np.r_[cut[1:], len(first)] - 1
        return first[cut], first[last], m[cut], code(self.hash[m[cut]])


class _Block:
    """The rows of a block in order of their ids; repeated ids are laid end to end."""

    def __init__(self, table: pa.Table) -> None:
        ids = [_NULL if i is None else i for i in table["id"].to_pylist()]
        texts = table["text"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        self.offsets, seen = [], {}
        for i, t in zip(self.ids, self.texts):
            self.offsets.append(seen.get(i, 0))
            seen[i] = self.offsets[-1] + len(t)

    def chunks(self):
        """(chunk, where its pieces begin in it, their ids, their starts)."""
        data, sizes, ids, starts = [], [], [], []
        for i, at, t in zip(self.ids, self.offsets, self.texts):
            for lo in range(0, max(0, len(t) - LENGTH) + 1, _PIECE) if len(t) >= LENGTH else ():
                data.append(t[lo : lo + _PIECE + LENGTH - 1])
                sizes.append(len(data[-1]))
                ids.append(i)
                starts.append(at + lo)
                if sum(sizes[-1:]) + sum(sizes[:-1]) >= _CHUNK:
                    yield _Chunk(b"".join(data), sizes), np.cumsum([0, *sizes[:-1]]), ids, starts
                    data, sizes, ids, starts = [], [], [], []
        if data:
            yield _Chunk(b"".join(data), sizes), np.cumsum([0, *sizes[:-1]]), ids, starts


def _keys(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Exchange part above 32 bits of the hash; a false match only leaves a string in that is found single later."""
    return ((hashes >> np.uint64(40)) % np.uint64(parts)) << np.uint64(32) | (hashes & np.uint64(0xFFFFFFFF))


def _sampled(block: _Block, parts: int) -> tuple[np.ndarray, np.ndarray]:
    found = [_keys(c.samples(), parts) for c, *_ in block.chunks()]
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))


def _table(rows: list[tuple], **kinds: pa.DataType) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.table({n: pa.array(c, type=t) for (n, t), c in zip(kinds.items(), columns)})


def _add(spans: list[tuple[int, int, int]], doc: int, start: int, end: int) -> None:
    """Append a range, or lengthen the last one if it touches it. Rows with one id touch; ``cover`` cuts at their borders."""
    if spans and spans[-1][0] == doc and spans[-1][1] <= start <= spans[-1][2]:
        spans[-1] = doc, spans[-1][1], max(end, spans[-1][2])
    else:
        spans.append((doc, start, end))


def _packed(spans: list[tuple[int, int, int]]) -> bytes:
    return np.array(spans, dtype="<i8").tobytes()


def _first_of(group: list, out: dict[int, list]) -> None:
    """Put the positions that are not the first of their string to ``out`` by block.

    group: [string, right length, [(doc, start, block), ...]] of all distinct runs with one minimizer.
    """
    seen: set[bytes] = set()
    group.sort(key=lambda g: min(g[2]))
    for s, right, where in group:
        where.sort()
        strings = len(s) - LENGTH + 1
        for doc, start, block in where[1:]:
            _add(out.setdefault(block, []), doc, start, start + len(s))
        if len(group) == 1:
            return
        doc, start, block = where[0]
        text = s[right:][::-1] + s[:right]
        for i in range(strings):
            w = text[i : i + LENGTH]
            if w in seen:
                _add(out.setdefault(block, []), doc, start + i, start + i + LENGTH)
            else:
                seen.add(w)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, spans, kept_sha256)`` for every row: which bytes are covered by a string of 100 bytes that
    also starts earlier (in a smaller id, or earlier in the same document).

    ``spans``: maximal removed byte ranges, array of (start, end). ``kept_sha256``: of the other bytes. Strings are
    judged on the input and never cross rows. Null texts are empty; texts of any length are read whole, in pieces.
    Rows with a null id come before all others; rows with one id count as one document, ordered by their text, so of
    repeated rows one is the first. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    total = text_bytes(docs, text_col)
    blocks = max(16, -(-total // BLOCK_BYTES))
    parts = max(64, blocks)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    i32, i64, raw = pa.int32(), pa.int64(), pa.binary()

    def sample(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, n = _sampled(_Block(table), parts)
        n = np.minimum(n, 255).astype(np.uint8)
        cut = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
        out = [(p, key[0].as_py(), keys[a:b].astype("<u4").tobytes(), n[a:b].tobytes()) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
        return _table(out, part=i32, block=i32, keys=raw, n=raw)

    def judge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(k, dtype="<u4") for k in table["keys"].to_pylist()]
        counts = np.concatenate([np.frombuffer(n, dtype=np.uint8) for n in table["n"].to_pylist()]).astype(np.int64)
        _, which = np.unique(np.concatenate(lists), return_inverse=True)
        seen = np.bincount(which, weights=counts)[which]
        code = np.where(seen > HOT, 2, np.where(seen > 1, 1, 0)).astype(np.uint8)
        cut = np.cumsum([0, *map(len, lists)])
        return _table([(b, key[0].as_py(), code[x:y].tobytes()) for b, x, y in zip(table["block"].to_pylist(), cut[:-1], cut[1:])], block=i32, part=i32, codes=raw)

    def send(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        block, number = _Block(left), key[0].as_py()
        keys, _ = _sampled(block, parts)
        answers = sorted(zip(right["part"].to_pylist(), right["codes"].to_pylist()))
        codes = np.frombuffer(b"".join(c for _, c in answers), dtype=np.uint8)
        if len(codes) != len(keys):
            raise ValueError("samples and answers differ")

        def code(hashes: np.ndarray) -> np.ndarray:
            return codes[np.minimum(np.searchsorted(keys, _keys(hashes, parts)), len(keys) - 1)]

        runs: dict[int, dict[tuple[bytes, int], tuple[int, int]]] = {}
        again: list[tuple[int, int, int]] = []
        for chunk, begin, ids, starts in block.chunks():
            first, last, anchor, kind = chunk.runs(code)
            piece = np.searchsorted(begin, first, side="right") - 1
            target = ((chunk.hash[anchor] >> np.uint64(20)) % np.uint64(parts)).tolist()
            data = chunk.data
            for a, z, m, k, i, to in zip(first.tolist(), last.tolist(), anchor.tolist(), kind.tolist(), piece.tolist(), target):
                doc, start = ids[i], starts[i] - int(begin[i])
                if k == 2:
                    for p in range(a, z + 1):
                        s = data[p : p + LENGTH]
                        known = runs.setdefault(zlib.crc32(s) % parts, {})
                        if (s, LENGTH) in known:
                            _add(again, doc, start + p, start + p + LENGTH)
                        else:
                            known[s, LENGTH] = doc, start + p
                    continue
                right_part = data[m : z + LENGTH]
                s = right_part + data[a:m][::-1]
                known = runs.setdefault(to, {})
                if (s, len(right_part)) in known:
                    _add(again, doc, start + a, start + z + LENGTH)
                else:
                    known[s, len(right_part)] = doc, start + a
        out = [(p, number, 0, front_coded([(s, r, d, x) for (s, r), (d, x) in known.items()])) for p, known in runs.items()]
        if again:
            out.append((number % parts, number, 1, _packed(again)))
        return _table(out, part=i32, block=i32, kind=i32, data=raw)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found: dict[int, list] = {}
        out, runs = [], []
        for b, kind, data in zip(table["block"].to_pylist(), table["kind"].to_pylist(), table["data"].to_pylist()):
            if kind:
                out.append((b, data))
            else:
                runs.append((b, data))
        group: list = []
        for s, right, block, doc, start, shared in merged(runs):
            if group and shared >= GRAM:
                if shared == len(s) == len(group[-1][0]) and right == group[-1][1]:
                    group[-1][2].append((doc, start, block))
                else:
                    group.append([s, right, [(doc, start, block)]])
                continue
            if group:
                _first_of(group, found)
            group = [[s, right, [(doc, start, block)]]]
        if group:
            _first_of(group, found)
        out += [(b, _packed(spans)) for b, spans in found.items()]
        return _table(out, block=i32, data=raw)

    def cover(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left)
        spans = np.concatenate([np.zeros((0, 3), dtype="<i8"), *(np.frombuffer(d, dtype="<i8").reshape(-1, 3) for d in right["data"].to_pylist())])
        spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
        low = np.searchsorted(spans[:, 0], np.array(block.ids, dtype=np.int64), side="left").tolist()
        high = np.searchsorted(spans[:, 0], np.array(block.ids, dtype=np.int64), side="right").tolist()
        out = []
        for i, at, t, lo, hi in zip(block.ids, block.offsets, block.texts, low, high):
            joined: list[list[int]] = []
            for _, a, z in spans[lo:hi].tolist():
                # a joined range may run over the border of two rows with one id
                a, z = max(a - at, 0), min(z - at, len(t))
                if a >= z:
                    continue
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], z)
                else:
                    joined.append([a, z])
            sha, x = hashlib.sha256(), 0
            for a, z in joined:
                sha.update(t[x:a])
                x = z
            sha.update(t[x:])
            out.append((None if i == _NULL else i, len(t), [{"start": a, "end": z} for a, z in joined], sha.hexdigest()))
        return _table(out, id=i64, n_bytes=i64, spans=pa.list_(pa.struct([("start", i64), ("end", i64)])), kept_sha256=pa.string())

    samples = dealt.groupBy("block").applyInArrow(sample, "part int, block int, keys binary, n binary")
    answers = samples.groupBy("part").applyInArrow(judge, "block int, part int, codes binary")
    sent = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send, "part int, block int, kind int, data binary")
    back = sent.groupBy("part").applyInArrow(merge, "block int, data binary")
    schema = "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    return dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(cover, schema).withColumnRenamed("id", id_col)
