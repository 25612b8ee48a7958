"""A compressed set of offsets with fast selection: containers of 65,536 offsets, each stored in its shortest form."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPAN_BITS = 16
SPAN = 1 << SPAN_BITS
WORD_BITS = 64
#: Bytes of each form: two per value, one bit per offset of the span, four per run.
BITMAP_BYTES = SPAN // 8


@dataclass
class ArrayContainer:
    values: np.ndarray

    def select(self, rank: int) -> int:
        return int(self.values[rank])


@dataclass
class RunContainer:
    """Runs of consecutive offsets: their first offsets, and how many offsets lie before each."""

    first: np.ndarray
    before: np.ndarray

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, "right")) - 1
        return int(self.first[run]) + rank - int(self.before[run])


@dataclass
class BitmapContainer:
    """One bit per offset, and how many are set before each word."""

    words: np.ndarray
    before: np.ndarray

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, "right")) - 1
        bits = int(self.words[word])
        for _ in range(rank - int(self.before[word])):
            bits &= bits - 1  # drops the lowest bit
        return word * WORD_BITS + (bits & -bits).bit_length() - 1


Container = ArrayContainer | RunContainer | BitmapContainer


def container(values: np.ndarray) -> Container:
    """The shortest form of ascending offsets below ``SPAN``."""
    breaks = np.flatnonzero(np.diff(values) != 1) + 1
    runs = len(breaks) + 1
    sizes = (2 * len(values), 4 * runs, BITMAP_BYTES)
    if sizes[1] < min(sizes[0], sizes[2]):
        before = np.concatenate(([0], breaks))
        return RunContainer(values[before].astype("uint16"), before.astype("int32"))
    if sizes[0] <= sizes[2]:
        return ArrayContainer(values.astype("uint16"))
    bits = np.zeros(SPAN, bool)
    bits[values] = True
    words = np.packbits(bits, bitorder="little").view("<u8")
    counts = np.bitwise_count(words).astype("int32")
    return BitmapContainer(words, np.cumsum(counts) - counts)


class BoundarySet:
    """Ascending distinct offsets from 0, in containers by their high bits, with cumulative cardinalities."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> SPAN_BITS
        starts = np.concatenate(([0], np.flatnonzero(np.diff(high)) + 1))
        self.cumulative = np.append(starts, len(offsets))
        self.high = high[starts]
        self.containers = [container(offsets[a:b] & (SPAN - 1)) for a, b in zip(self.cumulative[:-1], self.cumulative[1:])]

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, rank: int) -> int:
        """The offset that has ``rank`` offsets before it."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.cumulative, rank, "right")) - 1
        return (int(self.high[at]) << SPAN_BITS) + self.containers[at].select(rank - int(self.cumulative[at]))
