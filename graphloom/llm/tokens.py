"""Whole-text word splitting for Arrow batches (used inside mapInArrow tasks)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20  # text handled at once inside a task


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text (one
    row at least), which bounds a task's memory whatever the batch size."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def lower_ascii(texts: pa.Array) -> pa.Array:
    """Null texts become empty; A-Z become a-z and nothing else changes."""
    return pc.ascii_lower(pc.fill_null(texts, ""))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text as (distinct words, index of
    every word into them, start of each text's words; one more entry at the end)."""
    lists = pc.ascii_split_whitespace(texts)
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64, copy=False)
    keep = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
    if not keep.all():  # empty pieces stand at the ends of texts
        kept = keep[index]
        before = np.concatenate(([0], np.cumsum(kept)))
        starts, index = before[starts], index[kept]
    return coded.dictionary, index, starts


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_strings(values: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit xxHash of each string."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(v, seed) for v in values.cast(pa.binary()).to_pylist()), np.uint64, len(values))
