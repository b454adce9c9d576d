"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into three segments of 22, 21 and 21 bits. If two fingerprints differ in at most four bits, the
differing bits of some segment number at most one, so the two agree on that segment with one bit left out. Each
distinct fingerprint is indexed under all its 64 one-wildcard segment variants, in one exchange of (variant, fingerprint);
equal variants come together and the full distance is verified.

Within a bucket no pairs of a group are listed: small buckets are compared by shifts, in larger ones a component is grown
from its first member, and each member is compared only with those not reached yet. Very large buckets are cut once
more: members that differ in at most four bits agree on one of five parts of the other bits. Only links that join
two components of what a task has seen leave it. All of this is exact for components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.llm.common import checkpointed, map_column, spread, stored
from docket.llm.components import components
from docket.llm.fingerprints import SHINGLE_WORDS, fingerprint

BITS = 4
#: (lowest bit, width) of the segments
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Buckets of up to so many members are compared by shifts, and of more than the second number are cut once more.
SHIFTED, CUT = 64, 1 << 13
#: Index rows in a task, about, and fingerprints whose components a task remembers.
_ROWS, _KNOWN = 4_000_000, 1 << 18


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, fp)`` of every row; a null text counts as empty, and an empty text has fingerprint zero."""

    def hashed():
        return lambda texts: [[f - (1 << 64) if f >> 63 else f for f in (fingerprint(t, width) for t in texts)]]

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_column(spread(rows), "text", "fp long", hashed).select("id", "fp")


def _variants(nodes: DataFrame) -> DataFrame:
    """A row for each of the 64 one-wildcard segment variants: key holds the wildcard's place and the kept bits."""
    keys = []
    for low, width in SEGMENTS:
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        for b in range(width):
            keys.append(part.bitwiseAND(F.lit(~(1 << b) & ((1 << width) - 1))).bitwiseOR(F.lit((low + b) << 22)).cast("int"))
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")


class _Forest:
    """Union-find over the links of a task: a link is new if it joins two components. It forgets when it grows too large,
    which lets links through that add nothing, and loses none."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def new(self, u: int, v: int) -> bool:
        if len(self.up) > _KNOWN:
            self.up.clear()
        x, y = self._root(u), self._root(v)
        self.up[max(x, y)] = min(x, y)
        return x != y

    def _root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x


def _grown(fps: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among some fingerprints: each is compared with those not reached yet."""
    left = fps
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= bits
            if near.any():
                hit = left[near]
                left = left[~near]
                reached.extend(hit)
                yield from ((int(x), int(y)) for y in hit)


def _bucket_links(fps: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Links that connect the components of a bucket."""
    if len(fps) <= CUT:
        yield from _grown(fps, bits)
        return
    for low in range(0, 64, 13):  # one of five parts is equal where at most four bits differ
        part = (fps >> np.uint64(low)) & np.uint64((1 << 13) - 1)
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.diff(part[order])) + 1
        for group in np.split(fps[order], cut):
            if len(group) > 1:
                yield from _grown(group, bits)


def _links(keys: np.ndarray, fps: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Links of whole buckets that lie one after another."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    small = np.repeat(sizes <= SHIFTED, sizes)
    k, f = keys[small], fps[small]
    for shift in range(1, int(sizes[sizes <= SHIFTED].max(initial=1))):
        near = (k[shift:] == k[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= bits)
        yield from zip(f[:-shift][near].tolist(), f[shift:][near].tolist())
    for at, n in zip(starts[sizes > SHIFTED].tolist(), sizes[sizes > SHIFTED].tolist()):
        yield from _bucket_links(fps[at : at + n], bits)


def linked(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """``nodes(fp)``, distinct, to ``(id, component)`` of all fingerprints that have a link: components are named by their
    smallest fingerprint."""
    if bits > BITS:
        raise ValueError(f"three segments with one wildcard each find up to {BITS} differing bits")
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-64 * nodes.count() // _ROWS))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held, size = _Forest(), [], 0

        def done(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            edges = [e for e in _links(keys, fps, bits) if forest.new(*e)] if len(keys) else []
            if edges:
                ends = np.array(edges, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)))
            size += b.num_rows
            if size < 1 << 18 or not b.num_rows:
                continue
            keys, fps = (np.concatenate(c) for c in zip(*held))
            whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            yield from done(keys[:whole], fps[:whole])
            held, size = [(keys[whole:], fps[whole:])], 0
        if held:
            yield from done(*(np.concatenate(c) for c in zip(*held)))

    rows = _variants(nodes).repartition(parts, "key").sortWithinPartitions("key")
    return components(rows.mapInArrow(found, "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, width: int = SHINGLE_WORDS) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint``: 16 lowercase hex digits. ``component_id``: the smallest id reachable over links of at most
    ``bits`` differing bits, the row's own included.

    Null texts count as empty; empty texts have fingerprint zero and link like any other. Very long texts are hashed
    in blocks. Repeated rows and ids give a row each. A null id gives a row with a null id and takes part only as a
    copy of the fingerprint of others (its class has a null component if no row of it has an id). Empty input gives
    no rows; extra columns are not read.
    """
    fps = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = checkpointed(fps.groupBy("fp").agg(F.min("id").alias("rep")))
    found = checkpointed(linked(nodes.where("rep is not null").select("fp"), bits).withColumnRenamed("id", "fp"))
    least = found.join(nodes, "fp").groupBy("component").agg(F.min("rep").alias("least"))
    of = nodes.join(found.join(least, "component").select("fp", "least"), "fp", "left").select("fp", F.coalesce("least", "rep").alias("component_id"))
    return fps.join(of, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
