"""Token ids packed into a binary column: 4 bytes an id, little endian.

Long id lists move through files and shuffles as plain bytes, several times faster than as
arrays, and are cut and joined by byte position. Arrays come back at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corploom.functions.batches  # noqa: F401  (workers give memory back)

ID_BYTES = 4
BLOCK_IDS = 1 << 20  # ids looked at together; arrays of eight bytes an id are made of those only
# Fixed value: bytes of a JSON line with three empty lists,
# {"input_ids":[],"token_type_ids":[],"attention_mask":[]} and the line end.
_EMPTY_LINE = 57
_SIZE_BYTES = 8  # before a compressed row: its size without compression
_DECIMAL_STEPS = 10 ** np.arange(1, 10)


def packed_array(ids: np.ndarray, row_ends: np.ndarray, valid: pa.Buffer | None = None) -> pa.Array:
    """Binary array of rows `ids[row_ends[i]:row_ends[i + 1]]`."""
    offsets = pa.py_buffer(np.asarray(row_ends, np.int64) * ID_BYTES)
    data = pa.py_buffer(np.ascontiguousarray(ids, "<i4"))
    rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row_ends) - 1, [valid, offsets, data])
    return rows.cast(pa.binary())


def packed_ids(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a packed array, and where each row starts and ends among them."""
    rows = rows.cast(pa.large_binary())
    _, offsets, data = rows.buffers()
    offsets = np.frombuffer(offsets, np.int64)[rows.offset : rows.offset + len(rows) + 1] // ID_BYTES
    ids = np.frombuffer(data, "<i4") if data is not None else np.empty(0, np.int32)
    return ids[offsets[0] : offsets[-1]], offsets - offsets[0]


def sums_at(ends: np.ndarray, values: Iterator[np.ndarray]) -> np.ndarray:
    """Sums of all values before each of the places `ends`; values come in blocks, one after the other."""
    sums, at, before = np.zeros(len(ends), np.int64), 0, 0
    for block in values:
        if len(block):
            so_far = np.cumsum(block, dtype=np.int64)
            a, b = np.searchsorted(ends, [at, at + len(block)], side="right")
            sums[a:b] = before + so_far[ends[a:b] - at - 1]
            at, before = at + len(block), before + int(so_far[-1])
    return sums


def id_blocks(ids: np.ndarray) -> Iterator[np.ndarray]:
    return (ids[at : at + BLOCK_IDS] for at in range(0, len(ids), BLOCK_IDS))


def as_lists(rows: pa.Array) -> pa.Array:
    """The same rows as list<int32>."""
    ids, ends = packed_ids(rows)
    mask = rows.is_null() if rows.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=mask)


@F.arrow_udf(T.BinaryType())
def _pack(lists: pa.Array) -> pa.Array:
    ends = lists.offsets.to_numpy()
    ids = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    valid = lists.is_valid().buffers()[1] if lists.null_count else None
    return packed_array(ids, ends - ends[0], valid)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _unpack(rows: pa.Array) -> pa.Array:
    return as_lists(rows)


@F.arrow_udf(T.BinaryType())
def _squeeze(rows: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    small = [
        None if r is None else len(r).to_bytes(_SIZE_BYTES, "little") + codec.compress(r, asbytes=True)
        for r in rows.to_pylist()
    ]
    return pa.array(small, pa.binary())


@F.arrow_udf(T.BinaryType())
def _unsqueeze(rows: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    whole = [
        None if r is None else codec.decompress(r[_SIZE_BYTES:], int.from_bytes(r[:_SIZE_BYTES], "little"), asbytes=True)
        for r in rows.to_pylist()
    ]
    return pa.array(whole, pa.binary())


@F.arrow_udf(T.LongType())
def _line_bytes(rows: pa.Array, n_real: pa.Array) -> pa.Array:
    ids, ends = packed_ids(rows)
    digits = sums_at(ends, (np.searchsorted(_DECIMAL_STEPS, block, "right") + 1 for block in id_blocks(ids)))
    size, real = np.diff(ends), n_real.to_numpy()
    commas = np.maximum(size - 1, 0)
    flags = np.maximum(2 * size - 1, 0) + np.maximum(2 * real - 1, 0)
    return pa.array(np.diff(digits) + commas + flags + _EMPTY_LINE)


def pack_ids(ids: Column | str) -> Column:
    """array<int> -> binary."""
    return _pack(ids)


def unpack_ids(tokens: Column | str) -> Column:
    """binary -> array<int>."""
    return _unpack(tokens)


def moved_small(df: DataFrame, move: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `move` makes of the rows, with packed `tokens` compressed on the way: three bytes of four
    are zero mostly, and shuffles by themselves take twice the size of the text. `move` must
    not look at the tokens. Where nobody reads them, nothing is compressed."""
    if "tokens" not in df.columns:
        return move(df)
    moved = move(df.withColumn("tokens", _squeeze("tokens")))
    return moved.withColumn("tokens", _unsqueeze("tokens"))


def id_count(tokens: Column | str) -> Column:
    return F.shiftright(F.octet_length(tokens), 2)


def line_bytes(tokens: Column | str = "tokens", n_real: Column | str | None = None) -> Column:
    """Byte length of a row as a JSON line of ids, token types and mask, without making the line.

    `n_real` is the count of unpadded ids in packed rows: token types cover only those.
    """
    return _line_bytes(tokens, id_count(tokens) if n_real is None else n_real)
