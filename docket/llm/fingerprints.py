"""SimHash fingerprints of whole texts (pure Python and numpy, used inside Arrow batches)."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42
SHINGLE_WORDS = 4
#: Shingle hashes that are summed at a time; bounds memory for a very long text.
_BLOCK = 1 << 16


def shingles(text: str | None, width: int = SHINGLE_WORDS) -> list[bytes]:
    """Space-joined word shingles, repeats included; a shorter text is one shingle, an empty one none.

    Words are runs of anything but ASCII white space, A-Z in lower case: exactly what
    ``bytes.lower`` and ``bytes.split`` do.
    """
    words = (text or "").encode().lower().split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash: bit b is set if it is set in over half of the XXH64 values of the shingles."""
    parts = shingles(text, width)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(parts), _BLOCK):
        h = np.array([digest(p, SEED) for p in parts[at : at + _BLOCK]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(parts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])
