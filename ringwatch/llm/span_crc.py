"""CRC-32 of many spans of one buffer at once, in numpy.

The checksum is linear over XOR but for a constant that depends on the length alone. So a
table gives what a byte value contributes at each distance from a span's end, the
contributions of a span are XORed by one ``reduceat``, and the constant of its length is
added. Spans longer than the table are folded block by block: the checksum so far goes
into the first four bytes of the next block.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np

#: Distances from a span's end that the table covers; also the length of a block.
REACH = 64
# Bytes whose contributions are looked up at once.
_BLOCK = 1 << 20


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """Entry ``256 * distance + byte``: what the byte adds to a checksum that starts from zero."""
    table = np.empty((REACH, 256), dtype=np.uint32)
    # With the constant of one byte taken away, the checksum of one byte is its contribution at the end.
    table[0] = [zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)]
    for distance in range(1, REACH):
        before = table[distance - 1]
        table[distance] = (before >> np.uint32(8)) ^ table[0][before & np.uint32(255)]
    return table.reshape(-1)


@lru_cache(maxsize=1 << 12)
def length_constant(length: int) -> int:
    """The checksum of so many zero bytes."""
    return zlib.crc32(bytes(length))


def _contributions(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The XORed contributions of spans of 1 to ``REACH`` bytes."""
    table = position_table()
    found = np.empty(len(start), dtype=np.uint32)
    upto = np.cumsum(length)
    first = 0
    while first < len(start):
        base = upto[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(upto, base + _BLOCK, "right")))
        sizes = length[first:stop]
        offsets = upto[first:stop] - sizes - base
        place = np.arange(int(upto[stop - 1] - base), dtype=np.int32)
        byte = data[place + np.repeat((start[first:stop] - offsets).astype(np.int32), sizes)]
        distance = np.repeat((offsets + sizes - 1).astype(np.int32), sizes) - place
        found[first:stop] = np.bitwise_xor.reduceat(table[(distance << 8) | byte], offsets)
        first = stop
    return found


def _folded(register: np.ndarray) -> np.ndarray:
    """Checksums so far, carried over the next block of ``REACH`` bytes."""
    table = position_table()
    moved = np.zeros_like(register)
    for k in range(4):
        byte = (register >> np.uint32(8 * k)) & np.uint32(255)
        moved ^= table[256 * (REACH - 1 - k) + byte]
    return moved


def span_crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span ``data[start : start + length]``, as ``zlib.crc32`` gives it.

    ``data`` has fewer than 2 ** 31 bytes; a span has one byte at least.
    """
    if not len(start):
        return np.zeros(0, dtype=np.uint32)
    # Of a long span first what is beyond whole blocks, then block after block.
    head = (length - 1) % REACH + 1
    register = _contributions(data, start, head)
    open_ = np.flatnonzero(length > head)
    at = start[open_] + head[open_]
    end = start[open_] + length[open_]
    while len(open_):
        block = _contributions(data, at, np.full(len(at), REACH, dtype=np.int64))
        register[open_] = _folded(register[open_]) ^ block
        at = at + REACH
        more = at < end
        open_, at, end = open_[more], at[more], end[more]
    lengths, which = np.unique(length, return_inverse=True)
    constants = np.array([length_constant(int(n)) for n in lengths], dtype=np.uint32)
    return register ^ constants[which]
