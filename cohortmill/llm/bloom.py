"""A pair of Bloom filters over 64-bit hashes: seen once, and seen at least twice.

Every task fills a pair of its own; pairs are merged by

    once = once1 | once2        twice = twice1 | twice2 | (once1 & once2)

A hash that two tasks saw has all its bits in both ``once`` filters, so none is missed. Bits that
two different hashes set add false alarms only, which the caller settles by an exact check.

The size is fixed (``BITS``, 8 MB a filter, in memory too), so the merged filter may be broadcast
whatever the input. Beyond some 20 million distinct hashes it fills up and more rows go to the exact
check: slower, never wrong. A chunk of a filter that is mostly empty travels as a list of positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_slices

BITS = 26
PROBES = 3
CHUNK = 16
_PACKED = (1 << CHUNK) // 8  # bytes of a chunk, eight bits in each
_BIT = np.uint8(128) >> np.arange(8, dtype=np.uint8)  # in the order of packbits
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _places(hashes: np.ndarray) -> list[np.ndarray]:
    return [((hashes * odd) >> np.uint64(64 - BITS)).astype(np.int64) for odd in _ODD[:PROBES]]


def _held(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] & _BIT[place & 7]) != 0


def _mark(bits: np.ndarray, place: np.ndarray) -> None:
    np.bitwise_or.at(bits, place >> 3, _BIT[place & 7])


class Pair:
    def __init__(self) -> None:
        self.once = np.zeros((1 << BITS) // 8, dtype=np.uint8)
        self.twice = np.zeros((1 << BITS) // 8, dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Hashes as unsigned 64-bit; one that occurs in two calls, or twice in one, is twice seen."""
        values, counts = np.unique(hashes, return_counts=True)
        places = _places(values)
        again = counts > 1
        known = np.ones(len(values), dtype=bool)
        for place in places:
            known &= _held(self.once, place)
        for place in places:
            _mark(self.twice, place[again | known])
            _mark(self.once, place)

    def chunks(self) -> Iterator[tuple[int, bytes, bytes]]:
        for chunk in range(1 << (BITS - CHUNK)):
            part = slice(chunk * _PACKED, (chunk + 1) * _PACKED)
            if self.once[part].any():
                yield chunk, _pack(self.once[part]), _pack(self.twice[part])


def _pack(bits: np.ndarray) -> bytes:
    places = np.flatnonzero(np.unpackbits(bits)).astype(np.uint16)
    return places.tobytes() if places.nbytes < _PACKED else bits.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if len(data) == _PACKED:
        return np.frombuffer(data, np.uint8).copy()
    bits = np.zeros(1 << CHUNK, dtype=bool)
    bits[np.frombuffer(data, np.uint16)] = True
    return np.packbits(bits)


def twice_seen(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], times: int = 2) -> Seen:
    """The filter of hashes that occur at least twice over all rows, or with ``times=1`` once.

    ``hashes`` turns a batch of rows into hashes; only filters leave the task.
    """
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = None
        for batch in in_slices(batches):
            found = hashes(batch)
            if len(found):
                pair = pair or Pair()
                pair.add(found)
        if pair is None:
            return
        # Some chunks at a time: the packed filters are never held as a whole.
        held: list[tuple[int, bytes, bytes]] = []
        for row in pair.chunks():
            held.append(row)
            if len(held) == 128:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    def _batch(held: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        chunk, once, twice = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(chunk, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
            names=["chunk", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by chunk; one chunk is held at a time."""
        current, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            bits = _pack(twice if times == 2 else once)
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([bits], pa.binary())], names=["chunk", "bits"])

        for batch in in_slices(batches):
            for row in batch.to_pylist():
                if row["chunk"] != current:
                    if current is not None:
                        yield done()
                    current = row["chunk"]
                    once, twice = _unpack(row["once"]), _unpack(row["twice"])
                else:
                    more = _unpack(row["once"])
                    twice |= _unpack(row["twice"]) | (once & more)
                    once |= more
        if current is not None:
            yield done()

    parts = rows.mapInArrow(fill, "chunk int, once binary, twice binary")
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk int, bits binary")
    bits = np.zeros((1 << BITS) // 8, dtype=np.uint8)
    for row in merged.collect():  # 8 MB in all, by construction
        bits[row["chunk"] * _PACKED:(row["chunk"] + 1) * _PACKED] = _unpack(row["bits"])
    return Seen(rows, bits.tobytes())


class Seen:
    """The merged filter, shared with all tasks; workers read its bits where they lie."""

    def __init__(self, rows: DataFrame, bits: bytes):
        self._shared = rows.sparkSession.sparkContext.broadcast(bits)
        self._bits: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"_shared": self._shared, "_bits": None}

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes may have been seen often enough; all that were are among them."""
        if self._bits is None:
            self._bits = np.frombuffer(self._shared.value, np.uint8)
        out = np.ones(len(hashes), dtype=bool)
        for place in _places(hashes):
            out &= _held(self._bits, place)
        return out
