"""Suffix arrays of one shard in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a byte array, sorted by their first ``depth`` bytes at least, and a number for each that suffixes of an equal beginning share.

    Larsson-Sadakane refinement: suffixes are grouped by their first eight bytes, and each step doubles the sorted
    length by ordering the members of a group by the group of the suffix that far behind. Only groups of more than
    one member take part in a step, so text that is unique is not touched again. The numbers are those of the last doubling that does not go
    beyond ``depth``: suffixes with different numbers differ within it.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    # Big-endian words at every byte; zeros stand for what is behind the end.
    key = np.ndarray((n,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
    sa = np.argsort(key).astype(np.int32)
    ordered = key[sa]
    head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    del key, ordered
    rank = np.empty(n + 1, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(1, n + 1, dtype=np.int32), 0))
    rank[n] = 0
    # Places in the array whose group has other members, and which of them begin a group.
    others = ~head | ~np.append(head[1:], True)
    several, head = np.flatnonzero(others).astype(np.int32), head[others]
    # Eight bytes are more than a smaller depth: then all begin alike.
    length, begins = 8, np.zeros(n + 1, np.int32) if depth < 8 else None
    while length < depth and len(several):
        if 2 * length > depth:
            begins = rank.copy()
        at = sa[several]
        behind = at + length
        # A suffix that ends inside its sorted part looked like zeros there: the shorter, the earlier.
        second = np.where(behind <= n, rank[np.minimum(behind, n)], n - behind) + length
        group = np.cumsum(head, dtype=np.int64)
        low, high = len(several).bit_length(), (n + length).bit_length()
        if int(group[-1]).bit_length() + high + low < 64:
            # Group, second and place share a number, so a plain sort brings the order with it.
            key = (((group << high) | second) << low) | np.arange(len(several))
            key.sort()
            order, key = key & ((1 << low) - 1), key >> low
        else:
            key = group * np.int64(n + 1 + length) + second
            order = np.argsort(key)
            key = key[order]
        at = at[order]
        sa[several] = at
        head = np.concatenate(([True], key[1:] != key[:-1]))
        rank[at] = np.maximum.accumulate(np.where(head, several + 1, 0))
        others = ~head | ~np.append(head[1:], True)
        several, head = several[others], head[others]
        length *= 2
    return sa, rank if begins is None else begins


def common_prefixes(data: np.ndarray, before: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """The common prefix, up to ``most``, of each suffix ``at`` (ascending) with the one ``before`` it in sorted order.

    Kasai's observation: while the text and the place before advance in step, a common prefix shrinks by one each
    time. So only the last suffix of such a run is compared byte by byte (eight at a time); the others follow from it.
    """
    n = len(at)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    padded = np.zeros(len(data) + most + 8, np.uint8)
    padded[: len(data)] = data
    words = np.ndarray((len(data) + most,), "<u8", padded.tobytes(), strides=(1,))
    step = np.append((np.diff(at) == 1) & (np.diff(before) == 1), False)
    last = np.flatnonzero(~step)
    # The run ends, compared in full.
    alive, done = last, 0
    while len(alive) and done < most:
        x = words[at[alive] + done] ^ words[before[alive] + done]
        differ = x != 0
        if differ.any():
            d = alive[differ]
            low = x[differ] & (~x[differ] + np.uint64(1))
            out[d] = done + (np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64)
        alive = alive[~differ]
        done += 8
    out[alive] = done
    # The others: up to the next byte that differs within the run, or on into the run's end.
    end = last[np.searchsorted(last, np.arange(n))]
    differ = data[at] != data[before]
    stop = np.where(differ | ~step, np.arange(n), n)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    inner = step
    out[inner] = np.where(stop[inner] < end[inner], stop[inner] - np.arange(n)[inner], end[inner] - np.arange(n)[inner] + out[end[inner]])
    return np.minimum(out, most)


def equal_groups(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A group number for each of the places ``starts`` (ascending): equal exactly if the next ``length`` bytes are."""
    sa, begins = suffix_array(data, length)
    index = np.full(len(data), -1, np.int32)
    index[starts] = np.arange(len(starts))
    order = index[sa]
    order = order[order >= 0]
    sorted_starts = starts[order]
    # Each start with the one before it in the sorted order, if both begin alike; in text order.
    number = begins[sorted_starts]
    alike = np.flatnonzero(number[1:] == number[:-1])
    back = alike[np.argsort(sorted_starts[1:][alike])]
    at, before = sorted_starts[1:][back], sorted_starts[:-1][back]
    equal = np.zeros(max(0, len(starts) - 1), bool)
    equal[back] = common_prefixes(data, before, at, length) >= length
    out = np.empty(len(starts), np.int64)
    out[order] = np.concatenate(([0], np.cumsum(~equal)))
    return out
