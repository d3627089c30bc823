"""Quality rules by compression bands.

A document is compressed as a whole and in fixed chunks; what is left after the last
full one is judged by a chunk of full size that ends with the text, and a text shorter
than a chunk is one chunk with the band of its length. Its ratio (compressed
bytes by raw bytes) must lie in a band that depends on its length, because a short text
pays for the frame and has little to refer back to: below the band the text repeats itself, above it the text is noise that no model of language
shortens. Word rules that cost nothing are measured in the same pass.

A task holds one Arrow batch; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from affinia.llm.common import BLANKS, map_texts

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEVEL = 3
CHUNK_BYTES = 4096

# At this many bytes: least and greatest ratio of a whole text at LEVEL, in between by
# the logarithm of the length; texts below the first length have a greatest ratio only,
# texts beyond the last have its band. The lower bounds lie a hundredth or so below
# the ratios of nearly all good texts among the labelled rows that are not held out
# (crc32 of doc_id mod 5 is not 0); the upper ones leave a tenth or more above them.
BANDS = (
    (128, 0.68, 1.02),
    (256, 0.585, 0.92),
    (512, 0.53, 0.80),
    (1024, 0.485, 0.70),
    (2048, 0.458, 0.64),
    (4096, 0.433, 0.60),
    (8192, 0.415, 0.58),
    (16384, 0.403, 0.56),
    (131072, 0.38, 0.56),
)
MOST_SHORT = 1.30
# Band of one chunk of full size, and the share of bytes in chunks outside it that rejects.
CHUNK_BAND = (0.433, 0.60)
BAD_CHUNKS = 0.25

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, ratio double, "
    "low_chunks long, high_chunks long, n_chunks long"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur again.

    Windows are renumbered exactly by doubling: two windows have one number only
    where all their words agree.
    """
    count = len(words)
    if count <= window:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, count)
    if len(numbers) == count:
        return 0
    width = 1
    while width < window:
        joined = codes[:-width] * (int(codes.max()) + 1) + codes[width:]
        values, codes = np.unique(joined, return_inverse=True)
        if len(values) == len(codes):
            return 0
        width *= 2
    starts = np.flatnonzero(np.bincount(codes)[codes] > 1)
    edges = np.zeros(count + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return repeats


def band(size: int) -> tuple[float, float]:
    """Least and greatest ratio of a whole text of so many bytes."""
    if size < BANDS[0][0]:
        return 0.0, MOST_SHORT
    lengths, least, most = (np.array(column) for column in zip(*BANDS, strict=True))
    place = np.log2(size)
    return float(np.interp(place, np.log2(lengths), least)), float(np.interp(place, np.log2(lengths), most))


def band_verdict(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, int, bool]:
    """Ratio, chunks below and above their band, chunks, and whether all holds.

    The last chunk reaches back into the one before it, but weighs only its new bytes.
    """
    if not data:
        return 0.0, 0, 0, 0, False
    size = len(data)
    ratio = len(compressor.compress(data)) / size
    least, most = band(size)
    if size < CHUNK_BYTES:
        return ratio, int(ratio < least), int(ratio > most), 1, least <= ratio <= most
    low = high = bad = count = 0
    for start in range(0, size, CHUNK_BYTES):
        end = min(start + CHUNK_BYTES, size)
        part = len(compressor.compress(data[end - CHUNK_BYTES : end])) / CHUNK_BYTES
        low += part < CHUNK_BAND[0]
        high += part > CHUNK_BAND[1]
        bad += 0 if CHUNK_BAND[0] <= part <= CHUNK_BAND[1] else end - start
        count += 1
    good = least <= ratio <= most and bad <= BAD_CHUNKS * size
    return ratio, low, high, count, good


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every document, one row each.

    A missing or empty text has no words, fails the word rule and is not kept.
    Long texts are read whole. Equal rows give equal results; an empty table gives
    an empty result; columns besides ``doc_id`` and ``text`` are not looked at.
    """

    def work(ids: list, texts: list) -> dict[str, list]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        out: dict[str, list] = {name.split()[0]: [] for name in SCHEMA.split(", ")}
        for doc_id, text in zip(ids, texts, strict=True):
            text = text or ""
            data = text.encode()
            words = data.split()
            repeats = repeated_words(words)
            failed = len(words) < 20 or 100 * repeats > 30 * len(words)
            ratio, low, high, count, good = band_verdict(data, compressor)
            row = (
                doc_id,
                len(words),
                len(text) - sum(map(text.count, BLANKS)),
                sum(map(text.count, SYMBOLS)),
                repeated_lines(text),
                repeats,
                failed,
                good and not failed,
                ratio,
                low,
                high,
                count,
            )
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        return out

    return map_texts(docs, work, SCHEMA)
