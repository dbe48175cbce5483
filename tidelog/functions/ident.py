"""Identifiers: signed xxh3-64 over a frame of length-prefixed parts, computed over Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

NIL = 0


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def hash_bytes(data: bytes) -> int:
    return signed(xxhash.xxh3_64_intdigest(data))


def part_bytes(part) -> bytes | None:
    """Text as UTF-8, numbers as their eight little-endian bytes, booleans as one."""
    if part is None:
        return None
    if isinstance(part, str):
        return part.encode()
    if isinstance(part, (bytes, bytearray, memoryview)):
        return bytes(part)
    if isinstance(part, bool):
        return bytes([part])
    if isinstance(part, float):
        return struct.pack("<d", part)
    if isinstance(part, int):
        return struct.pack("<q", part) if -(1 << 63) <= part < 1 << 63 else str(part).encode()
    return str(part).encode()


def hash_of(*parts) -> int:
    """The identifier of some parts; an absent one is not an empty one."""
    if not parts:
        raise TypeError("an identifier needs at least one part")
    frame = b""
    for p in parts:
        b = part_bytes(p)
        frame += struct.pack("<q", -1) if b is None else struct.pack("<q", len(b)) + b
    return hash_bytes(frame)


def _hashes(data: memoryview, ends: np.ndarray) -> pa.Array:
    """The hash of each stretch of ``data``; ``ends`` begins with 0."""
    digest, at = xxhash.xxh3_64_intdigest, ends.tolist()
    return pa.array(np.fromiter((digest(data[a:b]) for a, b in zip(at, at[1:])), np.uint64, len(at) - 1).view(np.int64))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a column one after the other, how many each value has, and which are null (with none)."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = pc.fill_null(column.cast(pa.binary()), b"")
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if column.buffers()[2] is not None else np.zeros(0, np.uint8)
        return data, np.diff(ends).astype(np.int64), null
    kind = np.uint8 if pa.types.is_boolean(column.type) else "<f8" if pa.types.is_floating(column.type) else "<i8"
    there = column.drop_null().to_numpy(zero_copy_only=False).astype(kind)
    return there.view(np.uint8), np.where(null, 0, there.itemsize), null


def framed(columns: list[pa.Array]) -> pa.Array:
    """:func:`hash_of` for whole columns: the frames of all rows are laid out at once, then hashed where they lie."""
    parts = [_bytes_of(c) for c in columns]
    ends = np.concatenate([[0], np.cumsum(sum(n for _, n, _ in parts) + 8 * len(parts))])
    out, at = np.zeros(int(ends[-1]), np.uint8), ends[:-1].copy()
    for data, n, null in parts:
        said = np.where(null, -1, n).astype("<i8")
        out[at[:, None] + np.arange(8)] = said.view(np.uint8).reshape(-1, 8)
        at += 8
        out[np.repeat(at - np.cumsum(n) + n, n) + np.arange(len(data))] = data
        at += n
    return _hashes(memoryview(out), ends)


@F.arrow_udf(LongType())
def _digest(data: pa.Array) -> pa.Array:
    raw, n, null = _bytes_of(data)
    found = _hashes(memoryview(np.ascontiguousarray(raw)), np.concatenate([[0], np.cumsum(n)]))
    return pc.if_else(pa.array(null), pa.scalar(None, pa.int64()), found)


def digest(data: Column) -> Column:
    """The hash of whole bytes or text, null for null."""
    return _digest(data.cast("binary"))


def ident(*parts: Column | str | int, kinds: Sequence[str] = ()) -> Column:
    """The identifier of some columns (or constants). ``kinds`` names the columns that are ``double``; integers of any width count as
    64-bit, so give codes and ids as they are."""
    frame = []
    for i, p in enumerate(parts):
        c = p if isinstance(p, Column) else F.lit(p)
        frame.append((c, kinds[i] if i < len(kinds) else ("string" if isinstance(p, str) else "long")))

    @F.arrow_udf(LongType())
    def of_columns(*cols: pa.Array) -> pa.Array:
        return framed(list(cols))

    return of_columns(*[c.cast(k) for c, k in frame])
