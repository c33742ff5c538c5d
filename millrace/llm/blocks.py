"""Arrays in the workers: slices of a batch, and arrays that travel between blocks and shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pack(values: np.ndarray) -> bytes:
    """A 64-bit array, compressed byte plane by byte plane."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes, dtype=np.int64) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], 8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(dtype).ravel()


def split_by(keys: np.ndarray, *arrays: np.ndarray):
    """(key, parts of the arrays) for each distinct key; the order within a key stays."""
    order = np.argsort(keys, kind="stable")
    found, starts = np.unique(keys[order], return_index=True)
    ends = np.r_[starts[1:], len(keys)]
    for k, a, b in zip(found.tolist(), starts.tolist(), ends.tolist()):
        yield k, *[x[order[a:b]] for x in arrays]


def slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """The texts in runs of about so many bytes, so that a worker holds few of them as strings."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= most or i + 1 == len(texts):
            yield texts.slice(start, i + 1 - start)
            start, size = i + 1, 0


def release() -> None:
    """Gives memory that Arrow holds for later batches back, at the end of a task."""
    pa.default_memory_pool().release_unused()
