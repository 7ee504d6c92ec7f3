"""A Bloom filter of fixed size, built by Spark and tested in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.llm.hashing import WIDE, mix

#: The broadcast is 4 MB whatever is put in. Many more values than bits only let more rows pass.
BITS = 1 << 25
PROBES = 3


def _slots(values: np.ndarray, probe: int) -> np.ndarray:
    return (mix(values.view(WIDE) + WIDE(probe * 0x9E3779B97F4A7C15 % (1 << 64))) & WIDE(BITS - 1)).astype(np.int64)


def build(values: DataFrame) -> Broadcast:
    """Filter of the one bigint column of ``values``. Bits are set in tasks and merged by position."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).drop_null().to_numpy().astype(np.int64)
            # Spark numbers bits from 1
            found = np.unique(np.concatenate([_slots(own, p) for p in range(PROBES)])) + 1
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["slot"])

    packed = (
        values.mapInArrow(slots, "slot bigint")
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    )
    whole = bytearray(BITS // 8)
    for row in packed:
        start = (row.bucket - 1) * len(row.bits)
        whole[start:start + len(row.bits)] = row.bits
    return values.sparkSession.sparkContext.broadcast(bytes(whole))


def contains(filter_: Broadcast, values: np.ndarray) -> np.ndarray:
    """Whether each 64-bit value may be in the filter; never false for one that is."""
    bits = np.frombuffer(filter_.value, np.uint8)
    at = np.arange(len(values))
    for probe in range(PROBES):
        slot = _slots(values[at], probe)
        at = at[((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)]
    out = np.zeros(len(values), bool)
    out[at] = True
    return out
