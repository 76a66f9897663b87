"""Sets of word shingles as sorted 64-bit hashes, computed on whole Arrow batches of texts.

Words are runs of bytes other than space and the controls 9 to 13; A-Z count as a-z. The bytes of
a batch are hashed in windows, so memory beyond the words themselves does not grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20
# Odd multipliers of the hashes and of the 64-bit finaliser.
WORD_BASE, SHINGLE_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
FINAL_1, FINAL_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[ord("A") : ord("Z") + 1] += np.uint64(32)
_VALUE[_SPACE] = 0


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(FINAL_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(FINAL_2)
    return x ^ (x >> np.uint64(31))


def _placed(values: np.ndarray, position: np.ndarray) -> np.ndarray:
    """A number for every byte by its value and its position in its word, 0 for bytes between words.

    Each is mixed by itself before a word's numbers are added up, as sums of powers are the same
    for some pairs of words, whatever the base.
    """
    own = mixed((values + (position.astype(np.uint64) << np.uint64(9))) * np.uint64(WORD_BASE))
    own[values == 0] = 0
    return own


def _windows(space: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about ``WINDOW`` bytes that end behind a space or at the end of a text."""
    start, size = 0, len(space)
    while start < size:
        end = min(size, start + WINDOW)
        if end < size:
            after = np.flatnonzero(space[start:end])
            before = breaks[np.searchsorted(breaks, end, "right") - 1]
            cut = max(start + int(after[-1]) + 1 if len(after) else start, int(before))
            while cut <= start:  # a word longer than a window
                more = np.flatnonzero(space[end : end + WINDOW])
                nearest = breaks[np.searchsorted(breaks, start, "right")]
                cut = min(end + int(more[0]) + 1 if len(more) else size, int(nearest))
                if not len(more) and cut > end + WINDOW:
                    end, cut = end + WINDOW, start
            end = cut
        yield start, end
        start = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a column of texts, and the row of each."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    everything = everything[offsets[0] : offsets[-1]]
    breaks = offsets - offsets[0]
    space = _SPACE[everything]
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for start, end in _windows(space, breaks):
        inside = ~space[start:end]
        fresh = np.ones(len(inside), bool)
        fresh[1:] = ~inside[:-1]
        own = breaks[np.searchsorted(breaks, start) : np.searchsorted(breaks, end)]
        fresh[own - start] = True
        begins = np.flatnonzero(inside & fresh)
        if not len(begins):
            continue
        # Position of every byte within its word; bytes between words have the value 0.
        lengths = np.diff(np.append(begins, len(inside)))
        position = np.arange(begins[0], len(inside)) - np.repeat(begins, lengths)
        values = _placed(_VALUE[everything[start + begins[0] : end]], position)
        hashes.append(mixed(np.add.reduceat(values, begins - begins[0])))
        places.append(begins + start)
    place = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(breaks, place, "right") - 1


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted. A text of fewer words is one shingle of all
    of them; one without words, like a null one, has none."""
    hashes, rows = word_hashes(texts)
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
    base = np.uint64(SHINGLE_BASE)
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        rolled = rolled * base + hashes[i : i + len(rolled)]
    rolled = mixed(rolled)
    for first, last in zip(bounds[:-1], bounds[1:]):
        n = last - first
        if n >= words:
            own = np.sort(rolled[first : last - words + 1])
            yield own[np.append(True, own[1:] != own[:-1])]
        elif n:
            whole = np.full(1, n, np.uint64)
            for word in hashes[first:last]:
                whole = whole * base + word
            yield mixed(whole)
        else:
            yield np.zeros(0, np.uint64)
