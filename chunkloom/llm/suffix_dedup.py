"""Suffix-array dedup over bytes by a depth-limited radix sort.

``repeats`` gathers in a shard all snippets that can share a window. Their suffixes are ordered by their first 400
bytes only, most significant digit first: the first digit is eight bytes wide, and the digit of each later pass is
the place, known from the pass before, of the bytes that follow, so that it is as wide as all digits before. Each
pass sorts only within groups that are still equal, by words that hold place, digit and index. Groups left after the
last pass are the repeated windows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Unit, repeated

WINDOW = 400
SHARD_BYTES = 1 << 17  # arrays of that length stay in the cache
DIGIT = 8
FIRST = (40, 24)  # bits of the first digit that one sort takes, so that key and index share a word


def _sorted(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``keys``, which have so many bits, and the keys in that order."""
    n = len(keys)
    index = np.uint64(n.bit_length())
    if bits + int(index) > 64:
        order = np.argsort(keys)
        return order, keys[order]
    # One word for key and index sorts several times faster than an indirect sort.
    words = (keys << index) | np.arange(n, dtype=np.uint64)
    words.sort()
    return (words & ((np.uint64(1) << index) - np.uint64(1))).view(np.int64), words >> index


def _refine(place: np.ndarray, at: np.ndarray, digit: np.ndarray, bits: int, first: bool = False) -> np.ndarray:
    """Sorts each group of suffixes at one place by a digit of so many bits; gives those that are still not alone.

    Places of a group move up by the place within it, so that order and gaps stay as they are.
    """
    if not len(at):
        return at
    width = np.uint64(bits)
    keys = (place[at].astype(np.uint64) << width) | digit
    order, keys = _sorted(keys, bits if first else len(place).bit_length() + bits)
    fresh = np.ones(len(at), bool)
    np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    starts = np.flatnonzero(fresh)
    sizes = np.diff(starts, append=len(at))
    group = (keys[starts] >> width).view(np.int64)
    heads = np.ones(len(starts), bool)
    np.not_equal(group[1:], group[:-1], out=heads[1:])
    group += starts - np.maximum.accumulate(np.where(heads, starts, 0))
    place[at[order]] = np.repeat(group, sizes)
    many = np.empty(len(at), bool)
    many[order] = np.repeat(sizes > 1, sizes)
    return at[many]


def equal_windows(buffer: np.ndarray, room: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes with ``depth`` bytes of room, and for each the place that it shares with those equal to that depth.

    ``room`` is the number of bytes from each position to the end of its snippet. A suffix that is alone in its group
    keeps its place, which stays its own.
    """
    n = len(buffer)
    place = np.zeros(n, np.int64)  # by the bytes sorted so far
    digits = np.zeros(n + DIGIT, np.uint64)
    digits[:n] = buffer
    for j in (1, 2, 4):
        digits[:-j] = (digits[:-j] << np.uint64(8 * j)) | digits[j:]
    at = np.flatnonzero(room >= DIGIT)
    left = 8 * DIGIT
    for part in FIRST:
        left -= part
        digit = (digits[at] >> np.uint64(left)) & np.uint64((1 << part) - 1)
        at = _refine(place, at, digit, part, left + part == 8 * DIGIT)
    width = DIGIT
    while width < depth:
        wider = min(2 * width, depth)
        at = at[room[at] >= wider]
        digit = place[at + (wider - width)].astype(np.uint64)
        at = _refine(place, at, digit, n.bit_length())
        width = wider
    at = np.flatnonzero(room >= depth)
    return at, place[at]


def match(shard: list[tuple[bytes, int]], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Runs of windows of each snippet that occur at least twice in the shard."""
    lengths = np.array([len(t) for t, _ in shard])
    begins = np.cumsum(lengths) - lengths
    buffer = np.frombuffer(b"".join(t for t, _ in shard), np.uint8)
    room = np.repeat(begins + lengths, lengths) - np.arange(len(buffer))
    weights = np.repeat(np.array([w for _, w in shard]), lengths)
    at, group = equal_windows(buffer, room, window)
    total = np.bincount(group, weights=weights[at], minlength=1) if len(at) else np.zeros(1)
    flags = np.zeros(len(buffer) + 1, np.int8)
    flags[at[total[group] >= 2]] = 1
    step = np.diff(np.concatenate([[0], flags]))
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    out: list[list[tuple[int, int]]] = [[] for _ in shard]
    # The last window of a snippet ends before its last byte, so no run reaches into the next snippet.
    for a, b, i in zip(starts.tolist(), stops.tolist(), (np.searchsorted(begins, starts, side="right") - 1).tolist()):
        out[i].append((a - int(begins[i]), b - int(begins[i])))
    return out


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, n (bytes), n_removed, n_spans, kept_sha256 of every row.

    A byte goes if a string of 400 bytes over it starts anywhere else as well, in another row or the same; all
    copies go. Null texts are empty; repeated rows repeat each other; further columns are ignored; an empty
    table gives no rows.
    """
    return repeated(docs, Unit(words=False, window=WINDOW, gram=64, longest=4096), match, SHARD_BYTES)
