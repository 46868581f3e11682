"""Burrows-Wheeler transforms of small shards and their merge by interleave refinement.

A collection of byte strings is cut into shards. Each shard's suffixes are sorted by
themselves; merging never sorts suffixes again. It keeps one interleave of the shards' orders
and refines it: if the interleave is right for the first ``h`` symbols, placing every entry's
predecessor by its preceding symbols, stably, makes it right for ``h + 2``. Blocks of entries
that agree so far are split on the way, so the round in which two neighbours part bounds their
common prefix, and blocks that are left after ``length / 2`` rounds are the repeated intervals
of strings of that length.

Symbols are taken in pairs. Every string is closed by two terminators; all terminators differ
from each other and from all symbols, so no match runs across strings.
"""

import numpy as np

SHARD_BYTES = 1 << 16
TERMINATORS = 2


def _joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (byte + 1; UTF-8 never uses 255) and the start of each string."""
    text = np.frombuffer(b"".join(s + b"\xff" * TERMINATORS for s in strings), dtype=np.uint8) + 1
    sizes = np.array([len(s) + TERMINATORS for s in strings], dtype=np.int64)
    return text, np.cumsum(sizes) - sizes


def shard_order(text: np.ndarray, length: int) -> np.ndarray:
    """Suffix order of one shard (terminators 0, ranked by place), exact for ``length`` symbols.

    Starts from eight symbols at once and doubles; only tied suffixes are sorted again.
    """
    n = len(text)
    ends = np.flatnonzero(text == 0)
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    first = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        first = (first << np.uint64(8)) | padded[k : k + n]
    # What follows a terminator does not count: it is cut off and the terminator's own
    # number decides, which is the distance to it plus the number.
    following = np.searchsorted(ends, np.arange(n))
    gap = np.append(ends, n + 8)[following] - np.arange(n)
    near = gap < 8
    first[near] &= ~((np.uint64(1) << ((np.uint64(8) - gap[near].astype(np.uint64)) * np.uint64(8)))
                     - np.uint64(1)) if near.any() else np.uint64(0)
    tie = np.where(near, following, -1)
    order = np.lexsort((tie, first))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (first[order][1:] != first[order][:-1]) | (tie[order][1:] != tie[order][:-1])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    step = 8
    while step < length:
        sizes = np.diff(np.flatnonzero(fresh), append=n)
        tied_slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(tied_slots):
            break
        tied = order[tied_slots]
        group, after = rank[tied], rank[np.minimum(tied + step, n - 1)]
        sort = np.argsort(group * n + after, kind="stable")
        tied, group, after = tied[sort], group[sort], after[sort]
        order[tied_slots] = tied
        split = np.ones(len(tied), dtype=bool)
        split[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        fresh[tied_slots] = split
        rank[tied] = tied_slots[np.maximum.accumulate(np.where(split, np.arange(len(tied)), 0))]
        step *= 2
    return order


def _transform(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row: the two symbols before the suffix (0 if they start with a terminator), and the
    row of the suffix two places earlier."""
    n = len(text)
    row = np.empty(n, dtype=np.int32)
    row[order] = np.arange(n, dtype=np.int32)
    before = order - 2
    symbols = text[before].astype(np.uint16) << np.uint16(8) | text[order - 1]
    symbols[text[before] == 0] = 0
    return symbols, row[before]


def repeated(strings: list[bytes], length: int, shard_bytes: int = SHARD_BYTES
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of every substring of ``length`` (even) that occurs twice or more in ``strings``.

    Returns ``block, string, offset``, sorted by block; equal substrings share a block.
    """
    shards, held, size = [], [], 0
    for k, string in enumerate(strings):
        held.append(k)
        size += len(string)
        if size >= shard_bytes:
            shards.append(held)
            held, size = [], 0
    if held:
        shards.append(held)
    symbols, rows, places, fixed, total = [], [], [], [], 0
    base = 0
    starts = []
    for shard in shards:
        text, begins = _joined([strings[k] for k in shard])
        order = shard_order(text, length)
        pairs, back = _transform(text, order)
        symbols.append(pairs)
        rows.append(back + total)
        places.append(order + base)
        # Terminator suffixes come first in every shard, in the order of their places.
        fixed.append(np.arange(int((text == 0).sum()), dtype=np.int32) + total)
        starts.append(begins + base)
        total += len(text)
        base += len(text)
    pairs, back = np.concatenate(symbols), np.concatenate(rows)
    place, ended = np.concatenate(places), np.concatenate(fixed)
    n, m = len(pairs), len(ended)
    # The interleave lists rows of all shards; a row's number is its shard's offset plus its
    # rank there. At first whole shards follow each other and nothing is told apart but second
    # terminators, which lead: a pair in front of one has a terminator in it.
    rest = np.ones(n, dtype=bool)
    rest[ended[1::TERMINATORS]] = False
    interleave = np.concatenate((ended[1::TERMINATORS], np.flatnonzero(rest).astype(np.int32)))
    block = np.minimum(np.arange(n, dtype=np.int32), m // TERMINATORS)
    for _ in range(length // 2):
        symbol = pairs[interleave]
        order = np.argsort(symbol, kind="stable")
        symbol, source = symbol[order], block[order]
        parted = np.ones(n, dtype=bool)
        np.not_equal(symbol[1:], symbol[:-1], out=parted[1:])
        parted[1:] |= source[1:] != source[:-1]
        interleave = back[interleave[order]]
        # Predecessors that are terminators: all distinct, in fixed order.
        interleave[:m] = ended
        parted[: m + 1] = True
        block = np.cumsum(parted, dtype=np.int32)
    sizes = np.bincount(block)
    kept = np.flatnonzero(sizes[block] > 1)
    at = place[interleave[kept]]
    begins = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    string = np.searchsorted(begins, at, side="right") - 1
    return block[kept], string, at - begins[string]
