"""Base58 (Bitcoin alphabet) text of binary keys.

The one Python function on data.  It is an Arrow UDF: the key column arrives
as an Arrow binary array, keys of one length are viewed as an ``(n, L)``
uint8 matrix straight from the Arrow data buffer, converted to 32-bit limbs
and divided by 58^5 limb-wise for all rows at once (five digits per pass);
the text is assembled into an Arrow string array from buffers.  Each leading
zero byte becomes one ``1``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the Bitcoin base58 alphabet.
ALPHABET = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_ALPHA = np.frombuffer(ALPHABET, dtype=np.uint8)
_LOG58_256 = np.log(256) / np.log(58)
_B5 = np.uint64(58 ** 5)          # rem * 2^32 + limb < 58^5 * 2^32 < 2^64
_SHIFT = np.uint64(32)


def _digits(mat: np.ndarray) -> tuple[np.ndarray, int]:
    """Base-58 digits (most significant first) of an (n, L) uint8 key matrix."""
    n, length = mat.shape
    pad = (-length) % 4
    if pad:
        mat = np.concatenate([np.zeros((n, pad), dtype=np.uint8), mat], axis=1)
    b = mat.astype(np.uint64).reshape(n, -1, 4)
    limbs = (b[:, :, 0] << np.uint64(24)) | (b[:, :, 1] << np.uint64(16)) | (b[:, :, 2] << np.uint64(8)) | b[:, :, 3]
    n_chunks = int(np.ceil((int(np.ceil(length * _LOG58_256)) + 1) / 5))
    digits = np.zeros((n, n_chunks * 5), dtype=np.uint8)
    first = 0                                       # limbs before this are zero in every row
    m = limbs.shape[1]
    for c in range(n_chunks - 1, -1, -1):           # least significant chunk first
        rem = np.zeros(n, dtype=np.uint64)
        for j in range(first, m):
            cur = (rem << _SHIFT) | limbs[:, j]
            q = cur // _B5
            rem = cur - q * _B5
            limbs[:, j] = q
        for k in range(4, -1, -1):
            digits[:, c * 5 + k] = rem % np.uint64(58)
            rem //= np.uint64(58)
        while first < m and not limbs[:, first].any():
            first += 1
    return digits, pad


def _render(mat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Right-aligned char matrix and per-row start of the text for one length group."""
    n, length = mat.shape
    if length == 0:
        return np.zeros((n, 0), dtype=np.uint8), np.zeros(n, dtype=np.int64)
    digits, _ = _digits(mat)
    width = digits.shape[1]
    nonzero_byte = mat != 0
    lead_bytes = np.where(nonzero_byte.any(axis=1), nonzero_byte.argmax(axis=1), length)
    nonzero_digit = digits != 0
    lead_digits = np.where(nonzero_digit.any(axis=1), nonzero_digit.argmax(axis=1), width)
    return _ALPHA[digits], (lead_digits - lead_bytes).astype(np.int64)   # leading zero digits render as '1'


def encode_arrow(arr: pa.Array) -> pa.Array:
    """Base58 of every value of an Arrow binary array (nulls stay null)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.large_binary())
    n = len(arr)
    if n == 0:
        return pa.array([], pa.string())
    _, off_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64, count=arr.offset + n + 1)[arr.offset:]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    valid = ~np.asarray(arr.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    lengths = np.where(valid, lengths, -1)
    groups = np.unique(lengths[lengths >= 0])
    width = max([int(np.ceil((int(np.ceil(g * _LOG58_256)) + 1) / 5)) * 5 for g in groups] + [0])
    chars = np.zeros((n, width), dtype=np.uint8)
    start = np.full(n, width, dtype=np.int64)
    for g in groups:
        rows = np.nonzero(lengths == g)[0]
        if g and len(rows) == n and np.all(np.diff(offsets) == g):
            mat = data[offsets[0]:offsets[0] + n * g].reshape(n, g)      # zero-copy: one length
        else:
            mat = data[offsets[rows][:, None] + np.arange(g)[None, :]] if g else np.zeros((len(rows), 0), np.uint8)
        c, s = _render(mat)
        chars[rows, width - c.shape[1]:] = c
        start[rows] = s + (width - c.shape[1])
    keep = np.arange(width)[None, :] >= start[:, None]
    out_data = chars[keep]
    out_off = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(width - start, out=out_off[1:])
    out = pa.StringArray.from_buffers(n, pa.py_buffer(out_off.tobytes()), pa.py_buffer(out_data.tobytes()))
    if not valid.all():
        out = pc.if_else(pa.array(valid), out, pa.scalar(None, pa.string()))
    return out


def encode_many(values) -> list:
    """Encode a sequence of bytes-like values (``None`` stays ``None``)."""
    return encode_arrow(pa.array(list(values), pa.large_binary())).to_pylist()


def b58encode(value: bytes) -> str:
    return encode_many([value])[0]


@F.arrow_udf(T.StringType())
def _b58_udf(keys: pa.Array) -> pa.Array:
    return encode_arrow(keys)


def base58(col: Column | str) -> Column:
    """Column expression: base58 text of a BINARY column."""
    return _b58_udf(F.col(col) if isinstance(col, str) else col)


def encode_nested_keys(arr: pa.Array) -> pa.Array:
    """``list<struct<...>>`` with every binary field replaced by its base58 text
    (other fields, nulls and list offsets unchanged)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    offsets = arr.offsets
    start = offsets[0].as_py() if len(offsets) else 0
    values = arr.values.slice(start, (offsets[-1].as_py() - start) if len(offsets) else 0)
    rel = pc.subtract(offsets, pa.scalar(start, offsets.type))
    children, names = [], []
    for i, f in enumerate(values.type):
        child = values.field(i)
        if pa.types.is_binary(f.type) or pa.types.is_large_binary(f.type):
            child = encode_arrow(child)
        children.append(child)
        names.append(f.name)
    struct = pa.StructArray.from_arrays(children, names=names, mask=values.is_null() if values.null_count else None)
    return pa.ListArray.from_arrays(rel, struct, mask=arr.is_null() if arr.null_count else None)


def nested_base58(col: Column, out_type: T.DataType) -> Column:
    """Arrow UDF over an array of structs: binary fields become base58 text."""
    return F.arrow_udf(encode_nested_keys, out_type)(col)
