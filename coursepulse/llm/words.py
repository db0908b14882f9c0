"""Vectorised text helpers used inside Arrow tasks.

Words are maximal runs of characters other than ``[\\x20\\x09-\\x0D]``. All helpers take a
``pyarrow`` string array (null counts as the empty text) and work on whole columns at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text bytes handled at once: bounds the memory of a task


def text_array(column) -> pa.Array:
    """One contiguous string array without nulls and with offsets that start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = pc.fill_null(column.cast(pa.string()), "")
    return pa.concat_arrays([a]) if a.offset else a


def offsets_and_bytes(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets (n + 1) and the UTF-8 bytes of a string or binary array, rebased to 0."""
    _, off, data = a.buffers()
    offs = np.frombuffer(off, dtype=np.int32, count=len(a) + 1, offset=4 * a.offset).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offs - offs[0], raw[offs[0]:offs[-1]]


def sliced(batches, column: str | int, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        col = batch.column(column) if isinstance(column, int) else batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, n = 0, batch.num_rows
        ends = np.cumsum(sizes)
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to
            pa.default_memory_pool().release_unused()


def split_words(a: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``(ids, distinct words, offsets)``: word ids of all rows one after another."""
    lists = pc.ascii_split_whitespace(a)
    flat = lists.flatten()
    offs = np.asarray(lists.offsets).astype(np.int64)
    offs = offs - offs[0]
    full = np.asarray(pc.not_equal(flat, ""))
    if not full.all():  # leading or trailing white space gives empty strings
        flat = flat.filter(pa.array(full))
        offs = np.concatenate([[0], np.cumsum(full)])[offs]
    d = flat.dictionary_encode()
    return np.asarray(d.indices).astype(np.int64), d.dictionary, offs


def rows_of(offs: np.ndarray) -> np.ndarray:
    """Row number of every element."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def per_row(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of ``values`` by row."""
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[offs[1:]] - c[offs[:-1]]


def _dense(a: np.ndarray) -> tuple[np.ndarray, int]:
    codes, seen = pd.factorize(a)
    return codes.astype(np.int64), max(1, len(seen))


def window_codes(ids: np.ndarray, width: int) -> np.ndarray:
    """Dense codes of all ``width``-element windows: equal codes if and only if equal windows
    (pairs of dense codes are renumbered step by step, so nothing is hashed away)."""
    if len(ids) < width:
        return np.zeros(0, np.int64)
    one, n_one = _dense(ids)
    out, n, have = one, n_one, 1
    while have < width:
        step = min(have, width - have)
        if step == have:
            right, n_right = out[step:], n
        else:
            right, n_right = window_codes(one, step)[have:], None
            n_right = int(right.max(initial=0)) + 1
        left = out[: len(right)]
        out, n = _dense(left * n_right + right)
        have += step
    return out


def regex_count(a: pa.Array, pattern: str) -> np.ndarray:
    return np.asarray(pc.count_substring_regex(a, pattern)).astype(np.int64)
