"""Sorted 64-bit numbers in few bytes: Elias-Fano runs for the shuffle, and tables that are searched where they lie.

Both part a number below a high part, of which only the steps are kept, and a low part. A run has its
high parts in unary and its low parts bit by bit: two bits more than the information in a random set.
A table has the low parts in whole bytes, and in place of the unary code a directory of where each
high part begins, so a mapped file is searched without decoding it.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

from daybridge.llm.common import map_shared, write_shared

# Numbers whose low bits are spread out at a time.
CHUNK = 1 << 16

# Counts up to this fit a byte; it marks those kept apart.
APART = 255

# Mapped files a process holds at a time: the least recently used goes.
MAPPED = 8192


def low_bits(count: int, span: int) -> int:
    return max(0, (span // max(1, count)).bit_length() - 1)


def pack_run(keys: np.ndarray, first: int, span: int) -> bytes:
    """Ascending different numbers from ``first`` to below ``first + span``."""
    count, bits = len(keys), low_bits(len(keys), span)
    keys = keys - np.uint64(first)
    steps = np.zeros(count + (int(keys[-1]) >> bits) + 1 if count else 0, np.uint8)
    steps[(keys >> np.uint64(bits)).astype(np.int64) + np.arange(count)] = 1
    parts = [np.uint64(count).tobytes(), np.uint64(len(steps)).tobytes(), np.packbits(steps).tobytes()]
    for at in range(0, count if bits else 0, CHUNK):
        spread = np.unpackbits(keys[at:at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - bits:]
        parts.append(np.packbits(spread.ravel()).tobytes())
    return b"".join(parts)


def unpack_run(data: bytes, first: int, span: int) -> np.ndarray:
    count, steps = np.frombuffer(data, "<u8", 2).astype(np.int64).tolist()
    bits, at = low_bits(count, span), 16 + -(-steps // 8)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, at - 16, 16), count=steps)) - np.arange(count)
    low = np.zeros(count, np.uint64)
    for i in range(0, count if bits else 0, CHUNK):
        n = min(CHUNK, count - i)
        size = -(-n * bits // 8)
        spread = np.zeros((n, 64), np.uint8)
        spread[:, 64 - bits:] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * bits).reshape(n, bits)
        low[i:i + n] = np.packbits(spread, axis=1).view(">u8")[:, 0]
        at += size
    return (high.astype(np.uint64) << np.uint64(bits) | low) + np.uint64(first)


def pack_counts(counts: np.ndarray) -> bytes:
    """Whole numbers from 0, a byte each; larger ones stand before these, with their places."""
    large = np.flatnonzero(counts >= APART)
    return b"".join([np.uint64(len(large)).tobytes(), large.astype("<u8").tobytes(), counts[large].astype("<u8").tobytes(),
                     np.minimum(counts, APART).astype(np.uint8).tobytes()])


@dataclass
class Counts:
    """Packed counts, looked up by place."""

    places: np.ndarray
    large: np.ndarray
    small: np.ndarray

    def at(self, place: np.ndarray) -> np.ndarray:
        found = self.small[place].astype(np.int64)
        apart = np.flatnonzero(found == APART)
        if len(apart):
            found[apart] = self.large[np.searchsorted(self.places, place[apart].astype(np.uint64))]
        return found

    def all(self) -> np.ndarray:
        found = self.small.astype(np.int64)
        found[self.places.astype(np.int64)] = self.large
        return found


def counts_of(data: np.ndarray) -> Counts:
    """Of the bytes of packed counts, mapped or not."""
    n = int(data[:8].view("<u8")[0])
    return Counts(data[8:8 + 8 * n].view("<u8"), data[8 + 8 * n:8 + 16 * n].view("<u8"), data[8 + 16 * n:])


def unpack_counts(data: bytes) -> np.ndarray:
    return counts_of(np.frombuffer(data, np.uint8)).all()


def _planes(width: int) -> list[int]:
    """The low bytes as planes of 4, 2 and 1 bytes, which add up to the width."""
    return [4, 4] if width == 8 else [w for w in (4, 2, 1) if width & w]


def pack_table(keys: np.ndarray, first: int, span: int) -> bytes:
    """A searchable table of ascending different numbers from ``first`` to below ``first + span``."""
    keys = keys - np.uint64(first)
    width = min(range(1, 9), key=lambda w: len(keys) * w + 4 * ((span - 1 >> 8 * w) + 2))
    buckets = (span - 1 >> 8 * width) + 1
    high = (keys >> np.uint64(8 * width)).astype(np.int64) if width < 8 else np.zeros(len(keys), np.int64)
    edges = np.searchsorted(high, np.arange(buckets + 1)).astype("<u4")
    parts = [np.array([len(keys), width, buckets, 0], "<u8").tobytes(), edges.tobytes(), bytes(-edges.nbytes % 8)]
    shift = 0
    for plane in _planes(width):
        part = (keys >> np.uint64(shift)).astype(f"<u{plane}")
        parts += [part.tobytes(), bytes(-part.nbytes % 8)]
        shift += 8 * plane
    return b"".join(parts)


class Table:
    """A packed table over its bytes, which may be a mapped file."""

    def __init__(self, data: np.ndarray, first: int):
        self.first = first
        self.count, self.width, buckets, _ = data[:32].view("<u8").astype(np.int64).tolist()
        at, self.planes, shift = 32, [], 0
        self.edges = data[at:at + 4 * (buckets + 1)].view("<u4")
        at += -(-4 * (buckets + 1) // 8) * 8
        for plane in _planes(self.width):
            self.planes.append((np.uint64(shift), data[at:at + plane * self.count].view(f"<u{plane}")))
            at += -(-plane * self.count // 8) * 8
            shift += 8 * plane

    def _low(self, place: np.ndarray) -> np.ndarray:
        found = np.zeros(len(place), np.uint64)
        for shift, plane in self.planes:
            found |= plane[place].astype(np.uint64) << shift
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is not: a binary search of all at once within their buckets."""
        keys = keys - np.uint64(self.first)
        bits = np.uint64(8 * self.width)
        bucket = (keys >> bits).astype(np.int64) if self.width < 8 else np.zeros(len(keys), np.int64)
        low = keys & np.uint64((1 << 8 * self.width) - 1)
        left, right = self.edges[bucket].astype(np.int64), self.edges[bucket + 1].astype(np.int64)
        ends = right
        for _ in range(int((right - left).max(initial=0)).bit_length()):
            middle = left + right >> 1
            below = (left < right) & (self._low(np.minimum(middle, self.count - 1)) < low)
            left, right = np.where(below, middle + 1, left), np.where(below, right, np.maximum(middle, left))
        hit = left < ends
        hit[hit] = self._low(left[hit]) == low[hit]
        return np.where(hit, left, -1)

    def keys(self, place: np.ndarray | None = None) -> np.ndarray:
        """The keys at places, or all of them."""
        place = np.arange(self.count) if place is None else place
        found = self._low(place)
        if self.width < 8:
            bucket = np.searchsorted(self.edges, place, "right") - 1
            found |= bucket.astype(np.uint64) << np.uint64(8 * self.width)
        return found + np.uint64(self.first)


class Maps:
    """Mapped files by name, at most ``MAPPED`` at a time: a model of any size is scored in bounded mappings."""

    def __init__(self):
        self.held: OrderedDict = OrderedDict()

    def __reduce__(self):
        return Maps, ()

    def get(self, key, make: Callable):
        if key in self.held:
            self.held.move_to_end(key)
        else:
            while len(self.held) >= MAPPED:
                self.held.popitem(last=False)
            self.held[key] = make()
        return self.held[key]


@dataclass
class ShardedTable:
    """Sorted numbers of ``bits`` bits with counts, cut into equal ranges that are files."""

    folder: str
    name: str
    bits: int
    sizes: list[int]
    maps: Maps = field(default_factory=Maps, repr=False)

    @property
    def shards(self) -> int:
        return len(self.sizes)

    @property
    def starts(self) -> np.ndarray:
        """The place of each shard's first number in the whole array, and past the last."""
        return np.r_[0, np.cumsum(np.array(self.sizes, np.int64))]

    def table(self, shard: int) -> Table:
        return self.maps.get((self.name, shard), lambda: Table(
            map_shared(f"{self.folder}/{self.name}-{shard}.keys", np.uint8), range_of(shard, self.shards, self.bits)[0]))

    def counts(self, shard: int) -> Counts:
        return self.maps.get((self.name, shard, "counts"), lambda: counts_of(
            map_shared(f"{self.folder}/{self.name}-{shard}.counts", np.uint8)))

    def find(self, keys: np.ndarray, counted: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Place in the whole array (-1 if absent) and, if ``counted``, count (0 if absent) of ascending numbers."""
        place, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        if not len(keys):
            return place, count
        starts, shards = self.starts, shard_of(keys, self.shards, self.bits)
        edges = np.searchsorted(shards, np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            if self.sizes[s]:
                a, b = edges[s], edges[s + 1]
                at = self.table(s).find(keys[a:b])
                hit = np.flatnonzero(at >= 0)
                place[a + hit] = starts[s] + at[hit]
                if counted:
                    count[a + hit] = self.counts(s).at(at[hit])
        return place, count

    def write_keys(self, shard: int, keys: np.ndarray) -> None:
        first, span = range_of(shard, self.shards, self.bits)
        write_shared(f"{self.folder}/{self.name}-{shard}.keys", pack_table(keys, first, span))

    def write_counts(self, shard: int, counts: np.ndarray) -> None:
        write_shared(f"{self.folder}/{self.name}-{shard}.counts", pack_counts(counts))


def shard_of(key: np.ndarray, shards: int, bits: int = 64) -> np.ndarray:
    """Equal ranges of the numbers below ``2 ** bits``, in order."""
    top = min(bits, 32)
    return ((key >> np.uint64(bits - top)) * np.uint64(shards) >> np.uint64(top)).astype(np.int64)


def range_of(shard: int, shards: int, bits: int) -> tuple[int, int]:
    """The first number of a shard, and how many numbers it covers."""
    top = min(bits, 32)
    first, after = (-(-(s << top) // shards) << bits - top for s in (shard, shard + 1))
    return first, max(1, after - first)
