"""Hashes of many texts, counted over distinct texts in buckets of the hash range.

A task sends, for each batch and bucket, one row of packed arrays: sorted hashes, whose they are, and 16-byte keys of
the owners.  Owners with the same key are one; within a batch only the first of them is sent.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import map_arrow, map_groups, texts_of

POSTINGS = 2_000_000  # in a bucket, about 150 MB in a task
LEAST_BUCKETS = 64
_FLUSH = 1_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def how_many(total: int) -> int:
    return max(LEAST_BUCKETS, -(-total // POSTINGS))


def _packed(sorted_hashes: np.ndarray) -> bytes:
    """Sorted integers as differences, byte plane by byte plane: the high planes are zeros, which compress."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _rows(keys: dict[bytes, int], sets: list[np.ndarray], n_buckets: int) -> dict[str, list]:
    hashes = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
    order = np.argsort(hashes)
    hashes, owners = hashes[order], owners[order]
    edges = np.searchsorted(bucket_of(hashes, n_buckets), np.arange(n_buckets + 1, dtype=np.uint64))
    names = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
    out: dict[str, list] = {"bucket": [], "hashes": [], "owners": [], "keys": []}
    for b in np.flatnonzero(np.diff(edges)):
        low, high = edges[b], edges[b + 1]
        own, places = np.unique(owners[low:high], return_inverse=True)
        out["bucket"].append(int(b))
        out["hashes"].append(_packed(hashes[low:high]))
        out["owners"].append(places.astype("<u2" if len(own) < 65536 else "<u4").tobytes())
        out["keys"].append(names[own].tobytes())
    return out


def _shared(group: pa.Table) -> pa.Table:
    """Of one bucket: for each owner its hashes that another owner has too, with the number of owners."""
    hashes, owners, keys = [], [], []
    for row in zip(*(group.column(c) for c in ("hashes", "owners", "keys"))):
        packed, places, own = (x.as_buffer() for x in row)  # not copied
        values = _unpacked(packed)
        hashes.append(values)
        owners.append(np.frombuffer(places, "<u2" if places.size == 2 * len(values) else "<u4"))
        keys.append(np.frombuffer(own, np.dtype("V16")))
    names, ranks = np.unique(np.concatenate(keys), return_inverse=True)
    ranks = np.split(ranks.ravel().astype(np.uint32), np.cumsum([len(k) for k in keys])[:-1])
    h, c = np.concatenate(hashes), np.concatenate([r[o] for r, o in zip(ranks, owners)])
    del hashes, owners, keys, ranks
    order = np.lexsort((c, h))
    h, c = h[order], c[order]
    del order
    new = np.ones(len(h), bool)  # an owner that several batches sent counts once
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    h, c = h[new], c[new]
    counts = np.diff(np.r_[np.flatnonzero(np.r_[True, h[1:] != h[:-1]]), len(h)]).astype("<u4")
    df = np.repeat(counts, counts)
    more = df > 1
    h, c, df = h[more], c[more], df[more]
    order = np.argsort(c, kind="stable")
    h, c, df = h[order], c[order], df[order]
    edges = np.r_[np.flatnonzero(np.r_[True, c[1:] != c[:-1]]), len(c)] if len(c) else np.zeros(1, int)
    spans = list(zip(edges[:-1], edges[1:]))
    return pa.table(
        {
            "key": pa.array([names[c[a]].tobytes() for a, _ in spans], pa.binary()),
            "shared": pa.array([int(b - a) for a, b in spans], pa.int64()),
            "hashes": pa.array([h[a:b].tobytes() for a, b in spans], pa.binary()),
            "counts": pa.array([df[a:b].tobytes() for a, b in spans], pa.binary()),
        }
    )


def shared_hashes(
    texts: DataFrame, hashes_of: Callable[[str], np.ndarray], key_of: Callable[[str, np.ndarray], bytes], n_buckets: int
) -> DataFrame:
    """key, shared, hashes, counts: for each bucket and owner the hashes that other owners have too (little-endian
    unsigned 64-bit, ascending) and how many owners have each (unsigned 32-bit).  `texts` has a column text;
    `hashes_of` gives sorted distinct hashes, none for texts that take no part."""

    def of(batch: pa.RecordBatch):
        keys: dict[bytes, int] = {}
        sets: list[np.ndarray] = []
        size = 0
        for text in texts_of(batch):
            made = hashes_of(text)
            if len(made) and (key := key_of(text, made)) not in keys:
                keys[key] = len(sets)
                sets.append(made)
                size += len(made)
                if size > _FLUSH:
                    yield _rows(keys, sets, n_buckets)
                    keys, sets, size = {}, [], 0
        if sets:
            yield _rows(keys, sets, n_buckets)

    posted = map_arrow(texts.select(F.col("text")), "bucket int, hashes binary, owners binary, keys binary", of)
    return map_groups(posted, ["bucket"], "key binary, shared long, hashes binary, counts binary", _shared)
