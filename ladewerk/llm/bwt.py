"""Burrows-Wheeler transforms of many short byte strings, and their merge.

A string is read as ten interleaved strings of 10-byte symbols, one for each offset
modulo ten, so that a hundred bytes are ten symbols and every byte offset still starts
a suffix. The suffix at offset o is preceded by the symbol at o - 10; each of the ten
strings ends in one terminator row of symbol 0.
"""

from __future__ import annotations

import numpy as np

STEP = 10
SHARD_ROWS = 1 << 17


class Shard:
    """The transform of some strings: bwt (the preceding symbol of each sorted suffix)
    and where each sorted suffix starts."""

    def __init__(self, bwt: np.ndarray, string: np.ndarray, offset: np.ndarray):
        self.bwt, self.string, self.offset = bwt, string, offset


def stable_order(values: np.ndarray) -> np.ndarray:
    """Stable ascending order of non-negative integers; numpy sorts 16-bit ones by radix."""
    top = int(values.max()) if len(values) else 0
    if top < 1 << 8:
        return np.argsort(values.astype(np.uint8), kind="stable")
    if top < 1 << 16:
        return np.argsort(values.astype(np.uint16), kind="stable")
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    return order[stable_order((values >> 16)[order])]


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    ordered = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], (ordered[1:] != ordered[:-1]).astype(np.int64))))
    return rank


def symbols(data: np.ndarray) -> np.ndarray:
    """The rank, from 1, of the STEP bytes at each position of data (short at the end)."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(STEP, np.uint8)))
    eight = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
    rest = np.ndarray((n,), ">u2", padded[8:], strides=(1,)).astype(np.int64)
    return (_ranks((_ranks(eight) << 16) | rest) + 1).astype(np.uint32)


def build(symbol: np.ndarray, lengths: np.ndarray, first: int, depth: int) -> Shard:
    """Transform of the strings whose symbols (dense ranks from 1, one for each byte) lie
    one after another; sorted by prefix doubling to at least depth symbols. Each string
    is at least STEP bytes long."""
    n_strings = len(lengths)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    # A suffix row for each byte at which a whole symbol starts, then STEP end rows a string.
    string = np.repeat(np.arange(n_strings), lengths - (STEP - 1))
    offset = np.arange(len(string)) - np.repeat(np.cumsum(lengths - (STEP - 1)) - (lengths - (STEP - 1)), lengths - (STEP - 1))
    place = begins[string] + offset
    n = len(string)
    row_at = np.full(len(symbol) + 1, -1, np.int64)
    row_at[place] = np.arange(n)
    length = lengths[string]
    follows = offset + STEP <= length - STEP
    end_row = n + string * STEP + offset % STEP
    after = np.where(follows, row_at[np.minimum(place + STEP, len(symbol))], end_row)
    after = np.concatenate((after, np.arange(n, n + STEP * n_strings)))
    rank = np.concatenate((symbol[place].astype(np.int64), np.zeros(STEP * n_strings, np.int64)))
    rank = _ranks(rank)
    reached = 1
    while reached < depth and int(rank.max()) + 1 < len(rank):
        rank = _ranks(rank * (int(rank.max()) + 1) + rank[after])
        after = after[after]
        reached *= 2
    before = np.where(offset >= STEP, symbol[np.maximum(place - STEP, 0)], 0)
    tail = np.zeros(STEP * n_strings, symbol.dtype)
    last = ~follows
    tail[string[last] * STEP + offset[last] % STEP] = symbol[place[last]]
    order = np.argsort(rank, kind="stable")
    strings = np.concatenate((string, np.repeat(np.arange(n_strings), STEP))) + first
    offsets = np.concatenate((offset, np.full(STEP * n_strings, 1 << 30)))
    return Shard(np.concatenate((before, tail))[order], strings[order], offsets[order])


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave the sorted suffixes of all shards by their first depth symbols.

    Each round takes the interleave by h symbols to that by h + 1: every place reads the
    next preceding symbol of its shard, and a stable sort by that symbol moves the places.
    Two neighbours part in the round that first tells their symbols, or the blocks they
    come from, apart; those never parted share depth symbols. No suffix is sorted again.
    Returns for each place the block number, the string and the offset.
    """
    sizes = [len(s.bwt) for s in shards]
    width = np.uint8 if len(shards) < 256 else np.uint16
    source = np.repeat(np.arange(len(shards), dtype=width), sizes)
    bwt = np.concatenate([s.bwt for s in shards])
    if int(bwt.max(initial=0)) < 1 << 16:
        bwt = bwt.astype(np.uint16)
    block = np.zeros(len(source), np.int32)
    read = np.empty_like(bwt)
    for _ in range(depth):
        # The k-th place of a shard reads the k-th symbol of that shard's transform.
        read[np.argsort(source, kind="stable")] = bwt
        order = stable_order(read)
        source, came, symbol = source[order], block[order], read[order]
        parted = np.empty(len(order), bool)
        parted[:1] = False
        parted[1:] = (symbol[1:] != symbol[:-1]) | (came[1:] != came[:-1])
        block = np.cumsum(parted, dtype=np.int32)
    at = np.argsort(source, kind="stable")
    string = np.empty(len(source), np.int64)
    offset = np.empty(len(source), np.int64)
    string[at] = np.concatenate([s.string for s in shards])
    offset[at] = np.concatenate([s.offset for s in shards])
    return block, string, offset


def repeats(strings: list[bytes], starts: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """Whether each start of each string begins length bytes that also begin at a smaller
    position. strings[i] holds starts[i] starts; its first is at position[i], and positions
    of different strings keep their order when starts are added. Result: all starts, string
    by string."""
    depth = length // STEP
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    data = np.frombuffer(b"".join(strings), np.uint8)
    symbol = symbols(data)
    ends = np.cumsum(lengths)
    n_shards = max(2, -(-int(ends[-1]) // SHARD_ROWS)) if len(strings) > 1 else 1
    cuts = sorted({0, len(strings), *np.searchsorted(ends, np.arange(1, n_shards) * (ends[-1] / n_shards)).tolist()})
    shards = [
        build(symbol[(ends[i] - lengths[i]) : ends[j - 1]], lengths[i:j], i, depth)
        for i, j in zip(cuts[:-1], cuts[1:], strict=True)
    ]
    block, string, offset = merge(shards, depth)
    inside = offset < starts[string]
    block, string, offset = block[inside], string[inside], offset[inside]
    at = position[string] + offset
    smallest = np.full(int(block.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, block, at)
    bases = np.cumsum(starts) - starts
    found = np.zeros(int(starts.sum()), bool)
    found[bases[string] + offset] = smallest[block] < at
    return found
