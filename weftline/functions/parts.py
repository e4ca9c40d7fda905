"""Signatures of sets of 64-bit hashes: sets that are alike agree in one of them."""

from __future__ import annotations

import math

import numpy as np


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted different entries. Sorting numbers is several times faster than the hash table of numpy's own unique."""
    s = np.sort(x)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def band_of(n: int, num: int, den: int) -> int:
    """Sets that can be linked differ by at most one band."""
    return int(math.log(n) / math.log(den / num) + 1e-9)


def _edge(band: int, num: int, den: int) -> int:
    """No set of this band is larger."""
    return int(math.exp((band + 1) * math.log(den / num)) + 1e-6) + 1


#: Below so many parts a set is too small to agree in several of them.
FEW = 8


def part_keys(s: np.ndarray, num: int, den: int, need: int = 1, weight: np.ndarray | None = None) -> np.ndarray:
    """Signatures of a sorted set: every linked pair shares need of them.

    Left out are the parts of least weight (of fewest entries, without weight). A part that two sets agree in has one weight in
    both, so any weight of the entries that is the same for all sets will do: it changes what strangers share, and no link.

    With need above 1 a signature's lowest bit tells that this one is enough (its sets differ in less than FEW entries).
    A set leaves out fewer of its parts then: of the spare + 1 or more that agree, need are left out by neither set.
    """
    out = []
    own = band_of(len(s), num, den)
    for tile in (own - 1, own):
        if tile < 0:
            continue
        # |a ^ b| = |a u b| - |a n b| <= (1 - t) |a u b| <= (1 - t) (|a| + |b|) / (1 + t)
        most = (den - num) * (_edge(tile, num, den) + _edge(tile + 1, num, den)) // (den + num)
        own_need = need if most >= FEW else 1
        spare = own_need + most // 2
        parts = most + 1 + spare
        which = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        size = np.bincount(which.astype(np.int64), minlength=parts)
        total = np.zeros(len(s) + 1, np.uint64)
        np.cumsum(s * np.uint64(0x9FB21C651E98DF25) ^ (s >> np.uint64(29)), out=total[1:])
        ends = np.cumsum(size)
        value = total[ends] - total[ends - size]
        label = np.arange(parts, dtype=np.uint64) + np.uint64(tile << 40)
        key = (value ^ (label * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xFF51AFD7ED558CCD)
        rank = size if weight is None else np.bincount(which.astype(np.int64), weight, parts)
        key = np.delete(key ^ (key >> np.uint64(33)), np.argsort(rank, kind="stable")[: spare - own_need + 1])
        out.append(key if need == 1 else key >> np.uint64(1) << np.uint64(1) | np.uint64(own_need == 1))
    return np.concatenate(out)


_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def deletion_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text and all texts one character shorter, each told by 96 bits of hash and its length; linear in the length, where
    the texts themselves (text.deletion_keys) take its square."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    n = len(c)
    both = []
    for base in _BASES:
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
        value = mix(c * base)
        head = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:n])])  # of the characters before i
        moved = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[1:] * power[: n - 1])]) if n else head  # the same, one place to the left
        cut = head[:n] + (moved[-1] - moved[:n]) if n else head[:0]
        both.append(mix(np.concatenate([head[-1:], cut])))
    length = np.concatenate([np.full(1, n, np.uint64), np.full(n, max(n - 1, 0), np.uint64)])
    first, second = both[0], both[1] >> np.uint64(32) << np.uint64(32) | length
    _, one = np.unique(first ^ mix(second), return_index=True)
    return first[one].view(np.int64), second[one].view(np.int64)


def deletion_hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What deletion_hashes gives for each text, in no order, one text after the other; and how many there are of each.

    All texts at once, as most of them are short. Deletions are equal where the characters are those of one run.
    """
    size = np.array([len(x) for x in texts], np.int64)
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    end = np.cumsum(size)
    start = end - size
    of = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(c)) - start[of]
    again = np.zeros(len(c), bool)
    again[1:] = (c[1:] == c[:-1]) & (place[1:] > 0)
    one = np.flatnonzero(~again)
    counts = np.bincount(of[one], minlength=len(size)) + 1
    order = np.argsort(np.concatenate([np.arange(len(size)), of[one]]), kind="stable")
    total = lambda x: np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
    both = []
    for base in _BASES:
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(size.max(initial=0)), base, np.uint64)]))
        value = mix(c * base)
        head, moved = total(value * power[place]), total(np.where(place > 0, value * power[np.maximum(place - 1, 0)], np.uint64(0)))
        cut = head[:-1] - head[start[of]] + (moved[end[of]] - moved[1:])
        both.append(mix(np.concatenate([head[end] - head[start], cut[one]])))
    length = np.concatenate([size, size[of[one]] - 1]).astype(np.uint64)
    second = both[1] >> np.uint64(32) << np.uint64(32) | length
    return both[0][order].view(np.int64), second[order].view(np.int64), counts
