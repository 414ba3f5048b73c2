"""Keys shuffled in bins: one row per bin and batch, not one per key.

Tens of millions of (key, class) rows cost more to convert, compare and sort
one by one than to move. The upper bits of a key name its bin; a batch's keys
of one bin travel as one binary value with the columns beside them. Spark
deals the bins over the tasks and sorts by bin; a task takes one bin after the
other and keeps no more than that in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PACK_ROWS = 400_000


def bin_bits(spark: SparkSession) -> int:
    """Bins are named by 8 to 15 bits; some 32 for each shuffle partition."""
    return min(15, max(8, (32 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length()))


def pack(bits: int, key: np.ndarray, *columns: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Bins and, for each, its 64-bit keys and the columns beside them, one
    after the other. The key's upper byte is left out, as the bin tells it."""
    key = key.view(np.uint64)
    bins = (key >> np.uint64(64 - bits)).astype(np.uint16)
    order = np.argsort(bins, kind="stable")
    bins, key, columns = bins[order], key[order].view(np.uint8).reshape(-1, 8)[:, :7], [c[order] for c in columns]
    cuts = np.append(np.flatnonzero(np.append(True, bins[1:] != bins[:-1])), len(bins)).tolist()
    # the keys' bytes by place: those that are alike stand together and compress
    data = [b"".join([key[a:b].T.tobytes(), *(c[a:b].tobytes() for c in columns)])
            for a, b in zip(cuts, cuts[1:], strict=False)]
    return bins[cuts[:-1]].tolist(), data


def unpack(bits: int, which: int, data: list[bytes], *kinds) -> list[np.ndarray]:
    """The keys (unsigned) of bin ``which`` and the columns beside them."""
    kinds = [np.dtype(k) for k in kinds]
    counts = [len(d) // (7 + sum(k.itemsize for k in kinds)) for d in data]
    key = np.empty((sum(counts), 8), np.uint8)
    key[:, 7] = which >> (bits - 8)
    columns, at = [[] for _ in kinds], 0
    for d, n in zip(data, counts, strict=True):
        key[at:at + n, :7] = np.frombuffer(d, np.uint8, 7 * n).reshape(7, n).T
        at, place = at + n, 7 * n
        for k, c in zip(kinds, columns, strict=True):
            c.append(np.frombuffer(d, k, n, place))
            place += n * k.itemsize
    return [key.view(np.uint64).ravel(), *(np.concatenate(c) for c in columns)]


def bins_of(bins: pa.Array, data: pa.Array, open_bin: list) -> Iterator[tuple[int, list[bytes]]]:
    """Whole bins of a batch sorted by bin; the last one waits in ``open_bin``
    (number, data) for the next batch."""
    for lo in range(0, len(bins), 1000):
        for which, d in zip(bins.slice(lo, 1000).to_pylist(), data.slice(lo, 1000).to_pylist(), strict=True):
            if open_bin and open_bin[0] != which:
                yield open_bin[0], open_bin[1]
                open_bin.clear()
            if not open_bin:
                open_bin += [which, []]
            open_bin[1].append(d)
