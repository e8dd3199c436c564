"""Two-stage suffix sorting of many short byte strings at once, and what repeats among them."""

from __future__ import annotations

import numpy as np


def smaller_than_next(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each position's suffix within its string is smaller than the next position's.

    A run of equal bytes goes the way of the byte after it; a string's end counts as the smallest byte.
    """
    step = np.sign(data[1:].astype(np.int16) - data[:-1].astype(np.int16)).astype(np.int8)
    step = np.append(step, np.int8(-1))
    step[ends - 1] = -1
    decided = np.nonzero(step)[0]
    return step[decided[np.searchsorted(decided, np.arange(len(data)))]] > 0


def two_stage_order(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The first ``counts`` suffixes of every string data[starts:ends], ordered by their first ``length`` bytes.

    Only suffixes smaller than their successor are compared with each other. The others follow from one scan over
    the buckets of first bytes: whatever stands before an already placed suffix and is larger than it goes to the end
    of the first part of its own bucket. After the last wanted suffix each string keeps those up to the next one
    that is sorted directly, or up to its end.
    """
    size = len(data)
    small = smaller_than_next(data, ends)
    small_at = np.append(np.nonzero(small)[0], size)
    wanted_end = starts + counts  # exclusive
    stop = np.minimum(small_at[np.searchsorted(small_at, wanted_end - 1)], ends - 1)
    in_set = np.zeros(size + 1, np.int32)
    np.add.at(in_set, starts, 1)
    np.add.at(in_set, stop + 1, -1)
    in_set = np.cumsum(in_set[:-1]) > 0
    first = np.zeros(size, bool)
    first[starts] = True

    direct = np.nonzero(in_set & small)[0]
    padded = np.concatenate((data, np.zeros(length, np.uint8)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, length)
    direct = direct[np.argsort(np.ascontiguousarray(windows[direct]).view(f"S{length}").ravel(), kind="stable")]
    direct_from = np.searchsorted(data[direct], np.arange(257))

    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def place(found: np.ndarray, bucket: int) -> np.ndarray:
        """Append what stands before ``found`` to later buckets; what belongs to ``bucket`` itself is returned."""
        before = found[~first[found]] - 1
        before = before[~small[before]]
        letters = data[before]
        for letter in np.unique(letters).tolist():
            if letter > bucket:
                induced[letter].append(before[letters == letter])
        return before[letters == bucket] if bucket >= 0 else before[:0]

    # The ends of strings without a directly sorted suffix come after the empty suffix.
    tails = stop[~small[stop]]
    for letter in np.unique(data[tails]).tolist():
        induced[letter].append(tails[data[tails] == letter])
    order = []
    for bucket in range(256):
        front = np.concatenate(induced[bucket]) if induced[bucket] else direct[:0]
        while len(front):
            order.append(front)
            front = place(front, bucket)
        own = direct[direct_from[bucket] : direct_from[bucket + 1]]
        if len(own):
            order.append(own)
            place(own, bucket)
    ordered = np.concatenate(order) if order else direct[:0]
    string = np.searchsorted(starts, ordered, side="right") - 1
    return ordered[ordered < wanted_end[string]]


def common_to_next(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix but the last whether it shares ``length`` bytes with the next one in order."""
    left, right = order[:-1], order[1:]
    alike = np.ones(len(left), bool)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    at = np.arange(len(left))
    for offset in [*range(0, length - 7, 8), length - 8]:
        same = (words[left[at] + offset] == words[right[at] + offset]).all(axis=1)
        alike[at[~same]] = False
        at = at[same]
    return alike


def repeated_windows(
    strings: list[bytes], texts: np.ndarray, begins: np.ndarray, known: np.ndarray, length: int
) -> list[tuple[int, int, int]]:
    """``(string, from, to)`` in bytes of its text: unions of windows that occur at two places.

    Strings are cut out of texts (numbered by ``texts``) at ``begins``; strings marked ``known`` occur elsewhere as a
    whole, so each of their windows is a repeat of itself. The same place in two strings is one place.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    counts = sizes - length + 1
    use = np.nonzero(counts > 0)[0]
    if not len(use):
        return []
    data = np.frombuffer(b"".join(strings[i] for i in use.tolist()), np.uint8)
    ends = np.cumsum(sizes[use])
    starts = ends - sizes[use]
    order = two_stage_order(data, starts, ends, counts[use], length)
    string = np.searchsorted(starts, order, side="right") - 1
    place = order - starts[string] + begins[use][string]
    _, text = np.unique(texts[use], return_inverse=True)
    where = (text[string].astype(np.int64) << 32) + place
    head = np.concatenate(([0], np.nonzero(~common_to_next(data, order, length))[0] + 1))
    twice = np.minimum.reduceat(where, head) != np.maximum.reduceat(where, head)
    twice |= np.maximum.reduceat(known[use][string].astype(np.int8), head) > 0
    repeated = np.repeat(twice, np.diff(np.append(head, len(order))))
    hit = np.sort(order[repeated])
    if not len(hit):
        return []
    own = np.searchsorted(starts, hit, side="right") - 1
    new = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (own[1:] != own[:-1])))
    first, last = hit[new], np.append(hit[np.nonzero(new)[0][1:] - 1], hit[-1])
    own = own[new]
    begin = begins[use][own] + first - starts[own]
    return list(zip(use[own].tolist(), begin.tolist(), (begin + last - first + length).tolist()))
