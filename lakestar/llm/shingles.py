"""Word and shingle hashes of whole texts in numpy, for code that runs inside tasks.

A word is a run of bytes other than space and 0x09-0x0D in the UTF-8 text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
#: Texts are hashed in steps of about this many bytes, whatever their length, to bound memory.
STEP = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, STEP + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), STEP + 1)
#: Odd multipliers for the places of a word in a run of words.
PLACE = np.random.RandomState(7).randint(0, 1 << 63, 64).astype(_U) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash (every bit in reaches every bit out)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _hash_step(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of some bytes, and where it starts."""
    space = _SPACE[raw]
    word = ~space
    starts = np.flatnonzero(word & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(word & np.concatenate((space[1:], [True]))) + 1
    power, inverse = _POWER, _INVERSE
    if len(raw) > STEP:  # a single word that is longer than a step
        power, inverse = _powers(_BASE, len(raw)), _powers(pow(_BASE, -1, 1 << 64), len(raw))
    sums = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum((raw.astype(_U) + _U(1)) * power[:len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U)), starts


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of a text's words, in order."""
    if not text:
        return np.zeros(0, dtype=_U)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if lower:
        raw = _LOWER[raw]
    if len(raw) <= STEP:
        return _hash_step(raw)[0]
    parts, at = [], 0
    while at < len(raw):
        end = min(at + STEP, len(raw))
        if end < len(raw):  # cut at a space
            gaps = np.flatnonzero(_SPACE[raw[at:end]])
            after = gaps if len(gaps) else (end - at) + np.flatnonzero(_SPACE[raw[end:]])[:1]
            end = at + int(after[-1]) + 1 if len(after) else len(raw)
        parts.append(_hash_step(raw[at:end])[0])
        at = end
    return np.concatenate(parts)


def word_hashes_of(texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The words of many texts, several short ones at a time: number of the first text, the words' hashes one text after
    the other, and where in these each text ends."""
    first, group, size = 0, [], 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if group and size + len(raw) >= STEP:
            yield first, *_hash_group(group)
            first, group, size = first + len(group), [], 0
        group.append(raw)
        size += len(raw) + 1
    if group:
        yield first, *_hash_group(group)


def _hash_group(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if len(group) == 1:
        words = word_hashes(group[0].decode("utf-8", "surrogatepass"))
        return words, np.array([len(words)])
    words, starts = _hash_step(np.frombuffer(b" ".join(group) + b" ", dtype=np.uint8))
    return words, np.searchsorted(starts, np.cumsum([len(x) + 1 for x in group]))


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, in order, with repeats."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = words[:n] * PLACE[0]
    for j in range(1, k):
        out = out + words[j:n + j] * PLACE[j]
    return mix(out)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased text's runs of ``k`` words; with fewer words, the whole sequence as one."""
    words = word_hashes(text, lower=True)
    if 0 < len(words) < k:
        return mix((words * PLACE[:len(words)]).sum(keepdims=True) + _U(len(words)))
    return np.unique(runs(words, k))
