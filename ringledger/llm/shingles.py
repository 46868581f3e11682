"""Hashes of word shingles."""

from collections.abc import Iterator

import numpy as np
import xxhash

SEED = 42
# Shingles hashed at once; bounds the memory for one very long text.
BLOCK = 1 << 15


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, in blocks; of the whole sequence if it is shorter than one."""
    # bytes.lower changes A-Z only; bytes.split splits on blank and \x09 to \x0D only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle, len(words))
    pairs = list(zip(starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()))
    digest = xxhash.xxh64_intdigest
    for first in range(0, len(pairs), BLOCK):
        yield np.array(
            [digest(joined[a:b], SEED) for a, b in pairs[first : first + BLOCK]], dtype=np.uint64
        )
