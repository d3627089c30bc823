"""Fingerprints of word shingles, with numpy over many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at a time; a longer word is hashed whole.
SEGMENT = 1 << 20

_draw = np.random.default_rng(20240)
_BYTE = _draw.integers(0, 1 << 64, 256, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C17)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
MIX = np.uint64(0xBF58476D1CE4E5B9)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        for k, step in enumerate((_STEP, _BACK)):
            table = np.full(size, step, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * MIX
    return value ^ (value >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of UTF-8 bytes (A-Z lowered) and where they start.

    A word is a polynomial of its bytes' random values, taken as a difference of running
    sums, so that no word is looked at one by one.
    """
    found, places = [], []
    start = 0
    while start < len(data):
        stop = min(len(data), start + SEGMENT)
        while stop < len(data) and not _BLANK[data[stop]]:
            stop += 1
        part = np.frombuffer(data[start:stop].lower(), np.uint8)
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~_BLANK[part]
        edge = np.diff(inside)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        forth, back = _power_tables(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * forth[: len(part)], out=total[1:])
        found.append(mixed((total[last] - total[first]) * back[first] + (last - first).astype(np.uint64)))
        places.append(first + start)
        start = stop
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(places)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    hashes, places = word_hashes(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    stops = np.searchsorted(places, ends)
    starts = np.concatenate([[0], stops[:-1]])
    count = max(0, len(hashes) - width + 1)
    value = np.full(count, width, np.uint64)
    for k in range(width):
        value = mixed(value) + hashes[k : k + count]
    value = mixed(value)
    made = []
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        size = stop - start
        if size >= width:
            made.append(_distinct(value[start : stop - width + 1]))
        elif size:
            short = np.full(1, size, np.uint64)
            for k in range(start, stop):
                short = mixed(short) + hashes[k]
            made.append(mixed(short))
        else:
            made.append(np.empty(0, np.uint64))
    return made


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """For each text the ascending distinct fingerprints of its shingles.

    A text of fewer words is one shingle, a missing or empty one has none.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode()
        if held and size + len(data) > SEGMENT:
            yield from _sets(held, width)
            held, size = [], 0
        held.append(data)
        size += len(data)
    if held:
        yield from _sets(held, width)
