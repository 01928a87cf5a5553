"""Suffix arrays by induced sorting, with queues and arrays that go to disk.

The suffixes that begin a rise after a fall are sorted by recursion on a shorter text of names; all others are induced
from them: a scan over the first characters upwards yields the suffixes followed by a smaller one, a scan downwards the
others. A scan takes suffixes from a priority queue ordered by first character, then by the order of insertion, which is
their rank; it never inserts before what it has taken, so the queue is one line a character. Each line keeps a block in
memory and the rest in a file. Texts and types of more than `memory` bytes are mapped from files too.
"""

from __future__ import annotations

import tempfile
from pathlib import Path

import numpy as np

#: A text of names of at most so many symbols ends the recursion: it is sorted in memory by doubling.
IN_MEMORY = 1 << 22
#: Values that a line of a queue keeps in memory before it writes them out.
BLOCK = 1 << 18


class Line:
    """First in, first out; blocks beyond the first go to a file."""

    def __init__(self, folder: str, name: str) -> None:
        self._path = Path(folder) / name
        self._held: list[np.ndarray] = []
        self._size = 0

    def add(self, values: np.ndarray) -> None:
        self._held.append(values)
        self._size += len(values)
        if self._size >= BLOCK:
            with self._path.open("ab") as out:
                for part in self._held:
                    part.astype(np.int64).tofile(out)
            self._held, self._size = [], 0

    def take(self) -> list[np.ndarray]:
        """All blocks, in order; the line is empty then."""
        parts = self._held
        if self._path.exists():
            written = np.memmap(self._path, dtype=np.int64, mode="r")
            parts = [written[i : i + BLOCK] for i in range(0, len(written), BLOCK)] + parts
            self._path.unlink()
        self._held, self._size = [], 0
        return parts


class Queue:
    """A monotone priority queue of suffixes: a line for each first character."""

    def __init__(self, folder: str, name: str) -> None:
        self._folder, self._name, self._lines = folder, name, {}

    def add(self, chars: np.ndarray, suffixes: np.ndarray) -> None:
        """Append suffixes, in order, to the lines of their characters."""
        if not len(suffixes):
            return
        order = np.argsort(chars, kind="stable")
        ordered, moved = chars[order], suffixes[order]
        cuts = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
        for char, part in zip(ordered[np.r_[0, cuts]].tolist(), np.split(moved, cuts), strict=True):
            if char not in self._lines:
                self._lines[char] = Line(self._folder, f"{self._name}-{char}")
            self._lines[char].add(part)

    def take(self, char: int) -> list[np.ndarray]:
        line = self._lines.get(char)
        return line.take() if line else []


def _array(folder: str, name: str, size: int, dtype, memory: int) -> np.ndarray:
    if size * np.dtype(dtype).itemsize <= memory:
        return np.empty(size, dtype=dtype)
    return np.memmap(Path(folder) / name, dtype=dtype, mode="w+", shape=(size,))


def suffix_array(text: np.ndarray, memory: int = 256 << 20) -> np.ndarray:
    """Starts of all suffixes in order. `text` holds values above 0; its end counts as smaller than all."""
    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        ended = _array(folder, "text", len(text) + 1, np.int64, memory)
        ended[:-1], ended[-1] = text, 0
        return np.array(_sort(ended, folder, memory, 0))[1:]


def _sort(text: np.ndarray, folder: str, memory: int, level: int) -> np.ndarray:
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    if level and n <= IN_MEMORY:
        return _doubled(text)
    rising = _array(folder, f"rising-{level}", n, bool, memory)
    rising[:] = _types(text)
    stars = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    # induced from the stars in any order, the stars' stretches come out sorted
    rough = _induce(text, rising, stars[np.argsort(text[stars], kind="stable")], folder, memory, f"{level}a")
    star = np.zeros(n, dtype=bool)
    star[stars] = True
    ordered = rough[star[rough]]
    names = _names(text, ordered, stars)
    if names[-1] + 1 < len(stars):
        place = np.empty(n, dtype=np.int64)
        place[ordered] = names
        shorter = _array(folder, f"text-{level + 1}", len(stars), np.int64, memory)
        shorter[:] = place[stars]
        ordered = stars[_sort(shorter, folder, memory, level + 1)]
    return _induce(text, rising, ordered, folder, memory, f"{level}b")


def _doubled(text: np.ndarray) -> np.ndarray:
    """All suffixes in order, by ranks of stretches of doubling length."""
    n = len(text)
    rank, width = np.asarray(text, dtype=np.int64) + 1, 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: max(n - width, 0)] = rank[width:]
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        new = np.cumsum(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        rank[order] = new
        if new[-1] == n:
            return order
        width *= 2


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the end counts as such."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    following = np.searchsorted(differs, np.arange(n - 1))  # where the text next changes
    change = differs[np.minimum(following, len(differs) - 1)]
    return np.r_[text[change] < text[change + 1], True]


def _names(text: np.ndarray, ordered: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Numbers of the stretches between stars, in order; equal stretches have one number."""
    ends = np.empty(len(stars), dtype=np.int64)
    ends[:-1], ends[-1] = stars[1:], stars[-1]
    sizes = (ends - stars + 1)[np.searchsorted(stars, ordered)]
    same = np.r_[False, sizes[1:] == sizes[:-1]]
    at = np.flatnonzero(same)
    for part in np.array_split(at, max(1, len(at) // 500_000)):
        size = sizes[part]
        before = np.cumsum(size) - size
        offset = np.arange(int(size.sum())) - np.repeat(before, size)
        equal = text[np.repeat(ordered[part], size) + offset] == text[np.repeat(ordered[part - 1], size) + offset]
        if len(part):
            same[part] = np.logical_and.reduceat(equal, before)
    return np.cumsum(~same) - 1


def _induce(text, rising, stars: np.ndarray, folder: str, memory: int, name: str) -> np.ndarray:
    """All suffixes in order, from the stars in order (their order decides)."""
    n = len(text)
    counts = np.bincount(text)
    first = np.cumsum(counts) - counts
    chars = np.flatnonzero(counts).tolist()
    out = _array(folder, f"out-{name}", n, np.int64, memory)
    seeds, falling = Queue(folder, f"s{name}"), Queue(folder, f"f{name}")
    seeds.add(text[stars], stars)
    n_falling = {}

    def before(part: np.ndarray, wanted: bool) -> np.ndarray:
        part = np.asarray(part)
        left = part[part > 0] - 1
        return left[rising[left] == wanted]

    for char in chars:  # upwards: the falling suffixes
        at = int(first[char])
        waiting = falling.take(char)
        while waiting:
            for part in waiting:
                out[at : at + len(part)] = part
                at += len(part)
                left = before(part, False)
                falling.add(text[left], left)
            waiting = falling.take(char)
        n_falling[char] = at - int(first[char])
        for part in seeds.take(char):
            left = before(part, False)
            falling.add(text[left], left)
    up = Queue(folder, f"r{name}")
    end = np.array([n - 1])
    for char in reversed(chars):  # downwards: the rising suffixes
        at = int(first[char] + counts[char])
        waiting = up.take(char)
        while waiting:
            for part in waiting:
                out[at - len(part) : at] = part[::-1]
                at -= len(part)
                left = before(part, True)
                up.add(text[left], left)
            waiting = up.take(char)
        if char == 0:
            out[0] = end[0]
        low = int(first[char])
        for stop in range(low + n_falling[char], low, -BLOCK):
            left = before(out[max(low, stop - BLOCK) : stop][::-1], True)
            up.add(text[left], left)
    return out
