"""Bloom filters of bounded size over 64-bit hashes, built and probed by partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, StructField, StructType

from tierflow.llm.common import arrow_batch, mix64

PROBES = 4
SEGMENT = 1 << 16  # bytes of the filter that travel as one row
_PARTIAL = pa.schema([("segment", pa.int32()), ("seen", pa.binary()), ("again", pa.binary())])


def filter_bits(keys: int, bits_per_key: int = 16, max_bits: int = 1 << 28) -> int:
    """Bits for so many keys: a power of two, never above ``max_bits``.

    Beyond the bound the filter lets more keys through, so more rows take the shuffle;
    what is decided there stays exact.
    """
    bits = SEGMENT * 8
    while bits < min(keys * bits_per_key, max_bits):
        bits *= 2
    return bits


def _bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The positions of each hash, one row per probe."""
    h = mix64(hashes.view(np.uint64))
    step = (h >> np.uint64(33)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)])


def contains(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    hit = np.ones(len(hashes), dtype=bool)
    for at in _bits(hashes, bits):
        hit &= (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit


def _insert(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> None:
    for at in _bits(hashes, bits):
        np.bitwise_or.at(bitmap, (at >> np.uint64(3)).astype(np.int64),
                         np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _partials(batches, bits):
    """First pass of a task: what it has seen, and what it has seen again."""
    seen, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for batch in batches:
        hashes, counts = np.unique(batch.column(0).drop_null().to_numpy(zero_copy_only=False), return_counts=True)
        if len(hashes):
            _insert(again, hashes[(counts > 1) | contains(seen, hashes, bits)], bits)
            _insert(seen, hashes, bits)
    for segment in range(bits // 8 // SEGMENT):
        part = slice(segment * SEGMENT, (segment + 1) * SEGMENT)
        if seen[part].any():
            yield arrow_batch(_PARTIAL, [segment], [seen[part].tobytes()], [again[part].tobytes()])


def _merged(batches):
    """What two tasks have both seen has been seen again."""
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for segment, seen, again in zip(*(c.to_pylist() for c in batch.columns)):
            seen, again = np.frombuffer(seen, np.uint8), np.frombuffer(again, np.uint8)
            if segment in kept:
                before, twice = kept[segment]
                seen, again = before | seen, twice | again | (before & seen)
            kept[segment] = seen, again
    for segment, (seen, again) in kept.items():
        yield arrow_batch(_PARTIAL, [segment], [seen.tobytes()], [again.tobytes()])


def build(hashes: DataFrame, bits: int) -> tuple[bytes, bytes]:
    """Filters of the hashes seen and of those seen again, from one column of longs.

    The driver holds two filters of ``bits`` bits, which ``filter_bits`` bounds.
    """
    kind = "segment int, seen binary, again binary"
    segments = (
        hashes.mapInArrow(lambda batches: _partials(batches, bits), kind)
        .repartition("segment")
        .mapInArrow(_merged, kind)
    )
    seen, again = bytearray(bits // 8), bytearray(bits // 8)
    for row in segments.toLocalIterator():
        at = row.segment * SEGMENT
        seen[at:at + SEGMENT], again[at:at + SEGMENT] = row.seen, row.again
    return bytes(seen), bytes(again)


def probed(df: DataFrame, column: str, bitmap: bytes, bits: int, name: str) -> DataFrame:
    """``df`` with a boolean: may the long in ``column`` be in the filter? Null: no."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)
    at = df.columns.index(column)

    def run(batches):
        held = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            values = batch.column(at)
            hit = contains(held, values.fill_null(0).to_numpy(zero_copy_only=False), bits)
            hit &= values.is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], [*batch.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, BooleanType())]))
