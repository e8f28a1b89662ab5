"""Canonical, length-limited Huffman coding of integer ids in numpy, in independent blocks with bit-offset checkpoints."""

from __future__ import annotations

import struct

import numpy as np

LIMIT = 18  # bits of the longest code, and of the index of the decoding table
CHECKPOINT = 256  # ids between two recorded bit offsets
BLOCK = 1 << 18  # ids of a block


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths (0: unused) of an optimal code whose words have at most ``limit`` bits, by package-merge.

    At every level the ids, lightest first, are merged with the pairs of the level before; of the last level the
    first 2n - 2 items count, and each id is as long as the number of levels that take it.
    """
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.int64)
    levels, pairs = [], weight[:0]
    for _ in range(limit):
        items = np.concatenate([weight, pairs])
        order = np.argsort(items, kind="stable")
        levels.append(order < len(used))
        items = items[order]
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(used) - 2
    for own in reversed(levels):
        n = int(own[:take].sum())
        lengths[used[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code word of each id, and the ids in order of their code words: by length, then by id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    if len(used):
        size = lengths[used].astype(np.uint64)
        top = np.uint64(LIMIT) - size
        codes[used] = np.concatenate([[0], np.cumsum(np.uint64(1) << top)[:-1]]).astype(np.uint64) >> top
    return codes, used


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and length of the code word that the next ``LIMIT`` bits start with."""
    _, used = canonical(lengths)
    times = np.int64(1) << (LIMIT - lengths[used].astype(np.int64))
    rest = (1 << LIMIT) - int(times.sum())
    ids = np.concatenate([np.repeat(used, times), np.zeros(rest, dtype=np.int64)])
    return ids.astype(np.uint32), lengths[ids].astype(np.int64)


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """Number of ids, of bytes, the bit offsets of every ``CHECKPOINT``-th id, and the bits, most significant first."""
    size = lengths[ids].astype(np.int64)
    if len(size) and not size.all():
        raise ValueError("an id has no code")
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    word, at = starts >> 6, (starts & 63).astype(np.uint64)
    code, size = codes[ids], size.astype(np.uint64)
    left = np.uint64(64) - at
    fits = size <= left
    # a code starts in one 64-bit word and may end in the next
    head = np.where(fits, code << np.where(fits, left - size, 0).astype(np.uint64), code >> np.where(fits, 0, size - left).astype(np.uint64))
    words = np.zeros(-(-total // 64) + 1, dtype=np.uint64)
    if len(ids):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.bitwise_or.reduceat(head, first)
        over = np.flatnonzero(~fits)
        words[word[over] + 1] |= code[over] << (np.uint64(64) - (size[over] - left[over]))
    bits = words.astype(">u8").tobytes()[: -(-total // 8)]
    marks = starts[::CHECKPOINT].astype("<u4").tobytes()
    return struct.pack("<II", len(ids), len(bits)) + marks + bits


def decode_block(data: bytes, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """All stretches between checkpoints advance together, one id at a time."""
    n, size = struct.unpack_from("<II", data)
    marks = -(-n // CHECKPOINT)
    at = np.frombuffer(data, "<u4", marks, 8).astype(np.int64)
    raw = np.zeros(size + 8, dtype=np.uint32)
    raw[:size] = np.frombuffer(data, np.uint8, size, 8 + 4 * marks)
    # the 32 bits that start at each byte hold a code of LIMIT bits from any of its 8 bits
    ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    ids, lengths = table
    out = np.empty((CHECKPOINT, marks), dtype=np.uint32)
    last = len(ahead) - 1
    for step in range(min(CHECKPOINT, n)):
        window = ahead[np.minimum(at >> 3, last)]
        key = ((window << (at & 7).astype(np.uint32)) & np.uint32(0xFFFFFFFF)) >> np.uint32(32 - LIMIT)
        out[step] = ids[key]
        at += lengths[key]
    return np.ascontiguousarray(out.T).reshape(-1)[:n]
