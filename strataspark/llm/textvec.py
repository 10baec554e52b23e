"""Vectorised hashing of words and shingles for Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

R = np.uint64(0x9E3779B97F4A7C15 | 1)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
CHUNK = 1 << 20  # bytes hashed at once
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n + 1:
        size = max(n, CHUNK) + 1
        inverse = np.uint64(pow(int(R), -1, 1 << 64))
        for name, base in (("up", R), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=np.uint64)
    return _tables["up"], _tables["down"]


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of several texts in order, and where each text's words begin (one more at the end).

    A word's hash is a difference of running sums of byte * R**place, divided by R**start.
    """
    blob = b"\n".join(texts) + b"\n"
    a = np.frombuffer(blob, np.uint8)
    space = SPACE[a]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    up, down = _powers(len(a))
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    return words, np.searchsorted(starts, at)


def pieces(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``size`` bytes: (index of the first, encoded with A-Z lower-cased)."""
    first, run, n = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass").lower()
        if run and n + len(b) > size:
            yield first, run
            first, run, n = i, [], 0
        run.append(b)
        n += len(b)
    if run:
        yield first, run


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles (the whole text where it has fewer words)."""
    odd = [mix(np.arange(1, 2, dtype=np.uint64) + np.uint64(j))[0] | np.uint64(1) for j in range(k)]
    for _, run in pieces(texts):
        words, at = word_hashes(run)
        n = len(words)
        if n >= k:
            rolled = words[: n - k + 1] * odd[0]
            for j in range(1, k):
                rolled = rolled + words[j: n - k + 1 + j] * odd[j]
            rolled = mix(rolled)
        for i in range(len(run)):
            s, e = at[i], at[i + 1]
            if e - s >= k:
                yield np.unique(rolled[s: e - k + 1])
            elif e > s:
                with np.errstate(over="ignore"):
                    whole = sum((words[s + j] * odd[j] for j in range(e - s)), np.uint64(e - s))
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.empty(0, np.uint64)
