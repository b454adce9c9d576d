"""Front-coded sorted runs of suffix strings, and a loser tree that merges them without comparing known prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: (string, length of its part to the right of the anchor, doc, start)
Entry = tuple[bytes, int, int, int]


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that agree up to ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    low, high = start, n  # they agree before low and differ before high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low if a[low] != b[low] else high


def front_coded(entries: list[Entry]) -> bytes:
    """Sort entries by string and right length and drop from each what it shares with the one before."""
    entries = sorted(entries)
    prefix, tails = [], []
    last = b""
    for s, *_ in entries:
        n = common(last, s, 0)
        prefix.append(n)
        tails.append(s[n:])
        last = s
    numbers = np.array([(d, p) for _, _, d, p in entries], dtype="<i8").reshape(-1, 2)
    sizes = [np.array(x, dtype=np.uint8).tobytes() for x in (prefix, [len(t) for t in tails], [r for _, r, _, _ in entries])]
    return b"".join([len(entries).to_bytes(8, "little"), numbers.tobytes(), *sizes, *tails])


def decoded(blob: bytes) -> Iterator[tuple[bytes, int, int, int, int]]:
    """(string, right length, doc, start, prefix shared with the one before) of each entry of a run."""
    n = int.from_bytes(blob[:8], "little")
    numbers = np.frombuffer(blob, dtype="<i8", count=2 * n, offset=8).tolist()
    at = 8 + 16 * n
    prefix, size, right = (blob[at + i * n : at + (i + 1) * n] for i in range(3))
    at += 3 * n
    s = b""
    for i in range(n):
        s = s[: prefix[i]] + blob[at : at + size[i]]
        at += size[i]
        yield s, right[i], numbers[2 * i], numbers[2 * i + 1], prefix[i]


def merged(runs: list[tuple[int, bytes]]) -> Iterator[tuple[bytes, int, int, int, int, int]]:
    """Merge runs of (source, blob) to (string, right length, source, doc, start, prefix shared with the last output).

    Every loser remembers how long a prefix it shares with the string that beat it. Of two candidates the one that
    shares more with the last output is smaller; only if both share as much are characters compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    feeds = [decoded(b) for _, b in runs]
    heads: list[tuple | None] = [next(f, None) for f in feeds] + [None] * (k - len(runs))
    shared = [0] * k
    tree = [0] * k  # losers; tree[0] is the winner

    def beats(i: int, j: int) -> bool:
        """Whether head i comes before head j; notes what the loser shares with the winner."""
        a, b = heads[i], heads[j]
        if a is None or b is None:
            return b is None
        x, y = shared[i], shared[j]
        if x != y:
            return x > y
        s, t = a[0], b[0]
        n = common(s, t, x)
        if n < len(s) and n < len(t):
            first = s[n] < t[n]
        elif len(s) != len(t):
            first = len(s) < len(t)
        else:
            first = (a[1], i) < (b[1], j)
        shared[j if first else i] = n
        return first

    level = list(range(k))
    node = k
    while len(level) > 1:
        node //= 2
        up = []
        for p in range(0, len(level), 2):
            i, j = level[p], level[p + 1]
            if not beats(i, j):
                i, j = j, i
            tree[node + p // 2] = j
            up.append(i)
        level = up
    winner = level[0]
    while heads[winner] is not None:
        s, right, doc, start, _ = heads[winner]
        yield s, right, runs[winner][0], doc, start, shared[winner]
        head = heads[winner] = next(feeds[winner], None)
        shared[winner] = head[4] if head is not None else 0
        at = (winner + k) // 2
        while at:
            other = tree[at]
            if beats(other, winner):
                tree[at], winner = winner, other
            at //= 2
