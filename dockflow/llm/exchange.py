"""Moving 64-bit keys between tasks in packed groups.

A batch of documents makes hundreds of thousands of keys.  They leave the task as one row for each key range (bucket): the keys,
and the documents they belong to with a count each.  Spark shuffles the rows by bucket; each bucket is then looked at as arrays. The
number of buckets follows the input, so a bucket stays at a few megabytes and one hot key adds to one bucket only
what it has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PACKED = "bucket int, keys binary, extra binary, owners binary, counts binary, info binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("extra", pa.binary()), ("owners", pa.binary()), ("counts", pa.binary()), ("info", pa.binary())])
#: Keys of a bucket, about.
BUCKET_KEYS = 600_000


def buckets_for(keys: float) -> int:
    return int(min(1 << 20, max(8, keys / BUCKET_KEYS)))


def pack(keys: np.ndarray, row: np.ndarray, owners: np.ndarray, buckets: int, extra: np.ndarray | None = None, info: np.ndarray | None = None) -> pa.RecordBatch:
    """``keys`` (uint64) of rows ``row`` (ascending) with the rows' ``owners`` (int64); ``extra``: an array beside the
    keys; ``info``: an array beside the owners."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    turn = np.argsort(bucket, kind="stable")
    b, k, r = bucket[turn].astype(np.int64), keys[turn], row[turn]
    e = extra[turn] if extra is not None else None
    new = np.ones(len(b), bool)
    new[1:] = (b[1:] != b[:-1]) | (r[1:] != r[:-1])
    lead = np.flatnonzero(new)
    counts = np.diff(np.append(lead, len(b))).astype(np.uint32)
    owner = owners[r[lead]]
    used, at = np.unique(b, return_index=True)
    ends = np.append(at[1:], len(b))
    run = np.append(np.searchsorted(lead, at), len(lead))
    told = info[r[lead]] if info is not None else None
    cols: list[list] = [[], [], [], [], [], []]
    for i, x in enumerate(used.tolist()):
        s, t = slice(at[i], ends[i]), slice(run[i], run[i + 1])
        for c, v in zip(cols, (x, k[s].tobytes(), b"" if e is None else e[s].tobytes(), owner[t].tobytes(), counts[t].tobytes(), b"" if told is None else told[t].tobytes()), strict=True):
            c.append(v)
    return pa.RecordBatch.from_pydict(dict(zip(_ARROW.names, cols, strict=True)), schema=_ARROW)


def column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners of a bucket's rows, one after another."""
    return column(table, "keys", np.uint64), np.repeat(column(table, "owners", np.int64), column(table, "counts", np.uint32))
