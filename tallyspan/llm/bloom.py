"""A Bloom filter of fixed size, built by Spark and read in tasks: a broadcast that cannot grow with the data.

It only thins rows ahead of an exact join. When it fills up, more rows pass and the join does more work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyspan.llm.words import U64, mix

BITS = 26  # log2 of the number of bits: 8 MiB
_STEPS = tuple(U64(x) for x in (0x632BE59BD9B4E019, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    keys = keys.astype(np.int64, copy=False).view(U64) if keys.dtype != U64 else keys
    return [mix(keys ^ s) >> U64(64 - bits) for s in _STEPS]


def build(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """The filter of a one-column DataFrame of longs, as bytes. Tasks set bits, the driver merges bitmaps.

    Each task of the second stage owns one slice of the bit array, so what reaches the driver is the
    bit array once, whatever the number of keys.
    """
    slices = 8
    width = 1 << (bits - 3)

    def positions(batches):
        for b in batches:
            keys = b.column(0).drop_null().to_numpy(zero_copy_only=False)
            if len(keys):
                at = np.unique(np.concatenate(_places(keys, bits)))
                owner = (at >> U64(bits - 3)).astype(np.int64)
                for s in np.unique(owner):
                    yield pa.RecordBatch.from_pydict(
                        {"owner": pa.array([int(s)], pa.int32()), "at": [(at[owner == s] & U64(width - 1)).astype(np.uint32).tobytes()]}
                    )

    def merge(batches):
        maps = {}
        for b in batches:
            for s, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                bitmap = maps.setdefault(s, np.zeros(width, bool))
                bitmap[np.frombuffer(at, np.uint32)] = True
        for s, bitmap in maps.items():
            yield pa.RecordBatch.from_pydict({"owner": pa.array([s], pa.int32()), "bits": [np.packbits(bitmap).tobytes()]})

    rows = (
        keys.mapInArrow(positions, "owner int, at binary")
        .repartition(slices, "owner")
        .mapInArrow(merge, "owner int, bits binary")
        .collect()
    )
    out = np.zeros((slices, width // 8), np.uint8)
    for r in rows:
        out[r["owner"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False for keys that are certainly absent."""
    bits = (len(bitmap) * 8).bit_length() - 1
    out = None
    for at in _places(keys, bits):
        hit = (bitmap[(at >> U64(3)).astype(np.int64)] >> (U64(7) - (at & U64(7))).astype(np.uint8)) & 1
        out = hit if out is None else out & hit
    return out.astype(bool) if out is not None else np.zeros(0, bool)
