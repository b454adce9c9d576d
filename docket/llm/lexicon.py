"""A minimal acyclic transducer: sorted words in, rows of an output table out.

States with equal futures are shared (Daciuk et al., 2000), so common suffixes are stored once. Every arc carries an
integer output; the outputs along the path of a word sum to its rank among the words, which addresses the ids it maps
to. The whole structure is one flat little-endian file that readers map into memory.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_MAGIC = 0x58454C44


def compile_lexicon(entries: Sequence[tuple[bytes, Sequence[int]]]) -> bytes:
    """``(word, ids)`` pairs with distinct non-empty words to the bytes of a transducer."""
    entries = sorted((bytes(w), list(ids)) for w, ids in entries)
    arcs: list[dict[int, int]] = [{}]  # arcs of a state by byte
    final = [False]
    register: dict[tuple, int] = {}
    free: list[int] = []

    def state() -> int:
        if free:
            return free.pop()
        arcs.append({})
        final.append(False)
        return len(arcs) - 1

    path: list[tuple[int, int, int]] = []  # (parent, byte, child) of the last word, not yet shared

    def share(down_to: int) -> None:
        while len(path) > down_to:
            parent, byte, child = path.pop()
            key = (final[child], *arcs[child].items())
            twin = register.setdefault(key, child)
            if twin != child:
                arcs[parent][byte] = twin
                arcs[child], final[child] = {}, False
                free.append(child)

    last = b""
    for word, _ in entries:
        common = 0
        for x, y in zip(word, last):
            if x != y:
                break
            common += 1
        share(common)
        at = path[-1][2] if path else 0
        for byte in word[common:]:
            child = state()
            arcs[at][byte] = child
            path.append((at, byte, child))
            at = child
        final[at] = True
        last = word
    share(0)

    # words below each state, children first; a state is numbered when all its children are
    below: dict[int, int] = {}
    order: list[int] = []
    stack = [(0, False)]
    while stack:
        s, done = stack.pop()
        if done:
            if s not in below:
                below[s] = final[s] + sum(below[c] for c in arcs[s].values())
                order.append(s)
        elif s not in below:
            stack.append((s, True))
            stack += [(c, False) for c in arcs[s].values() if c not in below]
    order.reverse()  # the root is state 0
    number = {s: i for i, s in enumerate(order)}
    keys, targets, outputs = [], [], []
    for s in order:
        rank = int(final[s])
        for byte in sorted(arcs[s]):
            child = arcs[s][byte]
            keys.append(number[s] << 8 | byte)
            targets.append(number[child])
            outputs.append(rank)
            rank += below[child]
    sizes = np.array([len(ids) for _, ids in entries], dtype="<i8")
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    flat = np.array([i for _, ids in entries for i in ids], dtype="<i4")
    head = np.array([_MAGIC, len(order), len(keys), len(entries), len(flat)], dtype="<i8")
    parts = [head, np.array(keys, dtype="<i8"), np.array(targets, dtype="<i8"), np.array(outputs, dtype="<i8"), np.array([final[s] for s in order], dtype="<i8"), starts, flat]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Reader over a memory-mapped file (or any array of bytes)."""

    def __init__(self, raw: np.ndarray) -> None:
        magic, states, arcs, words, flat = (int(x) for x in raw[:40].view("<i8"))
        if magic != _MAGIC:
            raise ValueError("not a lexicon")
        at = 40

        def take(n: int, kind: str = "<i8") -> np.ndarray:
            nonlocal at
            part = raw[at : at + n * int(kind[-1])].view(kind)
            at += n * int(kind[-1])
            return part

        self.keys, self.targets, self.outputs, self.final = take(arcs), take(arcs), take(arcs), take(states)
        self.starts, self.ids, self.words = take(words + 1), take(flat, "<i4"), words

    @classmethod
    def map(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, dtype=np.uint8, mode="r"))

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for words that are not in the lexicon; all words step along together."""
        n = len(words)
        out = np.full(n, -1, dtype=np.int64)
        if not n or not self.words:
            return out
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        begin = np.cumsum(sizes) - sizes
        live = np.flatnonzero(sizes > 0)
        state, rank, step = np.zeros(len(live), dtype=np.int64), np.zeros(len(live), dtype=np.int64), 0
        while len(live):
            key = state << 8 | data[begin[live] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            hit = self.keys[arc] == key
            live, arc = live[hit], arc[hit]
            state, rank = self.targets[arc], rank[hit] + self.outputs[arc]
            step += 1
            ends = sizes[live] == step
            done = ends & (self.final[state] == 1)
            out[live[done]] = rank[done]
            live, state, rank = live[~ends], state[~ends], rank[~ends]
        return out
