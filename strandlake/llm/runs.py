"""Streaming over Arrow batches."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def give_back() -> None:
    """Returns the memory that this process has freed, but its allocators keep, to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def tidy(task):
    """A mapInArrow function that gives freed memory back when its task ends. Workers are used again by later stages: what each keeps
    would lie beside the executor's heap from then on."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def runs(batches, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows with equal keys, which lie side by side in the sorted batches, as one batch each; keys hold no nulls.

    Binary and string columns of a run of 2 GiB or more come as their large types.
    """
    held: list[pa.RecordBatch] = []
    last = None

    def joined() -> pa.RecordBatch:
        if len(held) == 1:
            return held[0]
        table = pa.Table.from_batches(held)
        if table.nbytes >= 2**31:  # more than 32-bit offsets reach in one chunk
            wide = {pa.binary(): pa.large_binary(), pa.string(): pa.large_string()}
            table = table.cast(pa.schema([f.with_type(wide.get(f.type, f.type)) for f in table.schema]))
        whole = table.combine_chunks().to_batches()
        if len(whole) != 1:
            raise RuntimeError(f"a run of {table.num_rows} rows came out in {len(whole)} batches")
        return whole[0]

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(n, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield joined()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield joined()
