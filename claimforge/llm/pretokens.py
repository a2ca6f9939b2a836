"""Pre-tokens of byte-level BPE for many texts at once, with numpy.

The pattern is the public GPT-2 one: contractions, then optional space + letters,
optional space + digits, optional space + other marks, then white space. Character
classes are looked up in one table and the boundaries follow from neighbouring
classes, so a batch of texts is cut without a Python loop over its words.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

# Code points with the Unicode property White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# What may follow an apostrophe as a contraction.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@functools.cache
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[list(WHITE_SPACE)] = SPACE
    return table


def code_points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)


def starts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in ``points``; ``texts`` are the places where texts begin."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    new = np.zeros(n + 1, bool)
    new[texts] = True
    start = new[:n].copy()
    start[0] = True
    start[1:] |= kind[1:] != kind[:-1]
    # The last character of white space that text follows stands apart; a blank joins what follows.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~new[1:n])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    for a in np.flatnonzero((points == 0x27) & start).tolist():
        if a + 1 < n and not new[a + 1] and kind[a + 1] == LETTER:
            first = chr(points[a + 1])
            second = chr(points[a + 2]) if a + 2 < n and not new[a + 2] else ""
            size = 2 if first in ONE_LETTER else 3 if first + second in TWO_LETTERS else 0
            if size:
                start[a + 1] = False
                if a + size < n:
                    start[a + size] = True
    return np.flatnonzero(start)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[first:end]`` for each span: a polynomial modulo 2**64, mixed."""
    n = len(values)
    up, down = _powers(1 << max(16, n.bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(0x51)) * up[:n], out=total[1:])
    return mix((total[end] - total[first]) * down[first] + (end - first).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def distinct(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For spans that tile ``points``: one span of each distinct content, and each span's place among those.

    Spans of equal hash are compared character by character, so the result is exact.
    """
    end = np.append(first[1:], len(points))
    _, one, group = np.unique(span_hashes(points, first, end), return_index=True, return_inverse=True)
    like = first[one][group]
    size = end - first
    same = bool((size == size[one][group]).all())
    if same:
        same = bool((points[np.arange(len(points)) + np.repeat(like - first, size)] == points).all())
    if not same:  # two contents with one hash: compare them as strings
        words = [points[a:b].tobytes() for a, b in zip(first.tolist(), end.tolist())]
        _, one, group = np.unique(np.array(words, object), return_index=True, return_inverse=True)
    return one, group


def counted(data: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], list[int]]:
    """Distinct pre-tokens of the texts in ``data`` and how often each occurs."""
    points = code_points(data)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    texts = np.searchsorted(lead, ends[:-1])
    first = starts(points, texts[texts < len(points)])
    if not len(first):
        return [], []
    one, group = distinct(points, first)
    byte_first, bounds, raw = np.append(lead, len(data)), np.append(first, len(points)), data.tobytes()
    words = [raw[a:b] for a, b in zip(byte_first[bounds[one]].tolist(), byte_first[bounds[one + 1]].tolist())]
    return words, np.bincount(group).tolist()


def encode(
    data: np.ndarray, ends: np.ndarray, special: dict[str, int], ids_of: Callable[[list[bytes]], list[bytes]]
) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in ``data`` (bounds ``ends``), and the n+1 bounds of each text's ids.

    ``special`` strings become their id wherever they occur; ``ids_of`` encodes
    distinct pre-tokens, each to little-endian 32-bit numbers. Empty texts have no ids.
    """
    texts = np.asarray(ends[:-1])
    raw = data.tobytes()
    found: list[tuple[int, int, int]] = []
    for word, number in special.items():
        mark, at = word.encode(), -1
        while (at := raw.find(mark, at + 1)) >= 0:
            k = int(np.searchsorted(ends, at, "right")) - 1
            if at + len(mark) <= ends[k + 1]:
                found.append((at, -at - len(mark), number))
    cuts: list[tuple[int, int, int]] = []
    for at, end, number in sorted(found):  # leftmost first, of those that begin together the longest
        if not cuts or at >= cuts[-1][1]:
            cuts.append((at, -end, number))
    points = code_points(data)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte place of each code point
    place = lambda b: np.searchsorted(lead, b)
    begin = [place(texts)]
    if cuts:
        cut_first, cut_end = place(np.array([c[0] for c in cuts])), place(np.array([c[1] for c in cuts]))
        begin += [cut_first, cut_end]
    first = starts(points, np.concatenate(begin))
    if cuts:  # a special string is one pre-token
        k = np.searchsorted(cut_first, first, "right") - 1
        inside = (k >= 0) & (first > cut_first[k]) & (first < cut_end[k])
        first = first[~inside]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    one, group = distinct(points, first)
    byte_first = np.append(lead, len(data))
    bounds = np.append(first, len(points))
    spans = zip(byte_first[bounds[one]].tolist(), byte_first[bounds[one + 1]].tolist())
    words = [raw[a:b] for a, b in spans]
    known = ids_of(words)
    if cuts:
        named = {w.encode(): number.to_bytes(4, "little") for w, number in special.items()}
        known = [named.get(w, ids) for w, ids in zip(words, known)]
    size = np.fromiter(map(len, known), np.int64, len(known)) // 4
    flat = np.frombuffer(b"".join(known), "<i4")
    base = np.cumsum(size) - size
    each = size[group]
    to = np.cumsum(each)
    ids = flat[np.arange(int(to[-1])) + np.repeat(base[group] - (to - each), each)]
    upto = np.append(0, to)
    return ids, upto[np.searchsorted(first, np.append(place(texts), len(points)))]
