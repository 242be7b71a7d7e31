"""A membership filter of fixed size over a distributed set of numbers.

It only spares work: rows that it lets through wrongly meet an exact join afterwards. Its size is fixed, so it may be
broadcast whatever the set's size; past its capacity it lets ever more rows through and the join does all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame

from hoopline.llm.blocks import mix

BITS = 26
SLICES = 64
#: The bits of a byte, first one highest.
_BIT = np.array([128 >> k for k in range(8)], np.uint8)


def _places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scrambled = mix(values.view(np.uint64))
    mask = np.uint64((1 << BITS) - 1)
    return (scrambled & mask).astype(np.int64), (scrambled >> np.uint64(BITS) & mask).astype(np.int64)


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros((1 << BITS) // 8, np.uint8)
    for batch in batches:
        for places in _places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)):
            np.bitwise_or.at(bits, places >> 3, _BIT[places & 7])
    parts = bits.reshape(SLICES, -1)
    some = [k for k in range(SLICES) if parts[k].any()]
    packed = [zstandard.compress(parts[k].tobytes(), 1) for k in some]
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary())], ["slice", "bits"])


def _join_bits(group: pa.Table) -> pa.Table:
    parts = [np.frombuffer(zstandard.decompress(b.as_py()), np.uint8) for b in group.column("bits")]
    bits = zstandard.compress(np.bitwise_or.reduce(parts).tobytes(), 1)
    return pa.table({"slice": group.column("slice").slice(0, 1), "bits": pa.array([bits], pa.binary())})


def membership(numbers: DataFrame) -> Broadcast:
    """The filter for the single column of ``numbers`` (long, without nulls)."""
    schema = "slice int, bits binary"
    rows = numbers.mapInArrow(_set_bits, schema).groupBy("slice").applyInArrow(_join_bits, schema).collect()
    bits = np.zeros((SLICES, (1 << BITS) // 8 // SLICES), np.uint8)
    for row in rows:
        bits[row["slice"]] = np.frombuffer(zstandard.decompress(bytes(row["bits"])), np.uint8)
    return numbers.sparkSession.sparkContext.broadcast(bits.tobytes())


def may_contain(bits: bytes, values: np.ndarray) -> np.ndarray:
    held, out = np.frombuffer(bits, np.uint8), np.ones(len(values), bool)
    for places in _places(values.astype(np.int64)):
        out &= (held[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)
    return out
