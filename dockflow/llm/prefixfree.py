"""Operator 9: repeated passages by prefix-free parsing.

Every string of ``LENGTH`` bytes holds a trigger: among its strings of ``TRIGGER`` bytes, the first with the lowest rolling hash.
The trigger depends on the string's own bytes alone, so equal strings have equal triggers at equal places, wherever they stand.
The starts of strings that share a trigger make one phrase of the parse.  The dictionary of the parse is the set of distinct phrases,
each with the bytes that its strings cover.  Order is needed only as far as ``LENGTH`` bytes, and only within a trigger, so dictionary
and parse are sorted trigger by trigger:

1. The parse: occurrences of a trigger's phrases, sorted by phrase and then in corpus order.  A phrase that stood earlier as a whole
   begins only strings that were there before; the only phrase of its trigger begins none.  Both are settled without looking at single strings.
2. The dictionary: the bytes of what is left (a phrase that is new though its trigger isn't, as at the edge of an edit) go to the trigger's
   bucket, where the suffix array of all of them is built by prefix doubling to ``LENGTH`` bytes.  Suffixes of equal rank are equal strings, byte by byte; the
   parse says which of them stands first in the corpus.

The phrases of a very common trigger (more than ``HOT_PHRASES`` distinct ones) would meet in one task. Their strings are sorted instead by a
hash of 128 bits each, which spreads them over all buckets.  Keys travel packed by bucket; within a batch only the first of equal
phrases (or strings) does, so a very common passage sends a bucket one key for each batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exchange, store
from . import kernel as K

LENGTH = 100
TRIGGER = 32
_REACH = LENGTH - TRIGGER + 1
#: Positions that are parsed at a time; the low bits of a hash make way for the position.
CHUNK = 1 << 19
_LOW = K.U64((1 << 20) - 1)

_PACKED = "bucket int, keys binary, blocks binary, owners binary, counts binary, at binary, n binary"
_ARROW = pa.schema([("bucket", pa.int32()), *((x, pa.binary()) for x in ("keys", "blocks", "owners", "counts", "at", "n"))])
#: What is known of documents: runs of string starts (first, number) that are repeats, or are to be settled string by string;
#: packed by a hash of the owner on the way, then one row for each owner.
_SENT = "part int, owners binary, counts binary, state binary, runs binary"
_RUNS = "owner long, repeats binary, open binary, hot binary"
_REPEAT, _OPEN, _HOT = 0, 1, 2
#: Distinct phrases of a trigger that are sorted in one task, at most.
HOT_PHRASES = 4096

#: Dictionary phrases on their way to the bucket of their trigger.
_PHRASES = "bucket int, phrases binary, owners binary, counts binary, at binary, n binary"
_PHRASE_ARROW = pa.schema([("bucket", pa.int32()), *((x, pa.binary()) for x in ("phrases", "owners", "counts", "at", "n"))])


def _wide(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of 128 bits, as two columns."""
    return np.stack([K.range_hashes(data, starts, ends), K.range_hashes(data, starts, ends, K.OTHER_BASE)], axis=1)


def _triggers(data: np.ndarray, offsets: np.ndarray, with_blocks: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of a batch: first string start, number of starts, hash of the trigger, hash of the covered bytes."""
    firsts, counts, keys, blocks = [], [], [], []
    valid_end = np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])  # string starts of a row end here
    lo = 0
    total = len(data)
    while lo + LENGTH <= total:
        hi = min(lo + CHUNK, total - LENGTH + 1)
        top = min(hi + _REACH - 1, total - TRIGGER + 1)
        at = np.arange(lo, top)
        gram = K.range_hashes(data, at, at + TRIGGER)
        low = (gram & ~_LOW) | (at - lo).astype(np.uint64)
        span = 1
        while span * 2 <= _REACH:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[: len(low) - (_REACH - span)], low[_REACH - span :])[: hi - lo]
        row = np.searchsorted(offsets, np.arange(lo, hi), "right") - 1
        own = (low & _LOW).astype(np.int64)
        ok = np.arange(lo, hi) < valid_end[row]
        new = np.ones(hi - lo, bool)
        new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1]) | ~ok[:-1]
        lead = np.flatnonzero(new & ok)
        if len(lead):
            stop = np.append(np.flatnonzero(new | ~ok), hi - lo)
            size = stop[np.searchsorted(stop, lead, "right")] - lead
            firsts.append(lead + lo)
            counts.append(size)
            keys.append(gram[own[lead]])
            blocks.append(_wide(data, lead + lo, lead + lo + size + LENGTH - 1) if with_blocks else np.zeros((0, 2), np.uint64))
        lo = hi
    if not firsts:
        z = np.zeros(0, np.int64)
        return z, z, z.view(np.uint64), np.zeros((0, 2), np.uint64)
    return tuple(np.concatenate(x) for x in (firsts, counts, keys, blocks))


def _pack(keys, blocks, row, owners, at, n, buckets, by=None):
    bucket = (((keys if by is None else by) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    turn = np.lexsort((at, row, bucket))
    bucket, row = bucket[turn], row[turn]
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (row[1:] != row[:-1])
    lead = np.flatnonzero(new)
    many = np.diff(np.append(lead, len(bucket))).astype(np.uint32)
    owner = owners[row[lead]]
    used, first = np.unique(bucket, return_index=True)
    last, run = np.append(first[1:], len(bucket)), np.append(np.searchsorted(lead, first), len(lead))
    keys, blocks, at, n = keys[turn], blocks[turn] if len(blocks) else blocks, at[turn].astype(np.uint32), n[turn].astype(np.uint32)
    cols = [[] for _ in _ARROW.names]
    for i, b in enumerate(used.tolist()):
        s, t = slice(first[i], last[i]), slice(run[i], run[i + 1])
        for c, v in zip(cols, (b, keys[s].tobytes(), blocks[s].tobytes() if len(blocks) else b"", owner[t].tobytes(), many[t].tobytes(), at[s].tobytes(), n[s].tobytes()), strict=True):
            c.append(v)
    return pa.RecordBatch.from_pydict(dict(zip(_ARROW.names, cols, strict=True)), schema=_ARROW)


def _local_repeats(row, owners, at, n, buckets) -> pa.RecordBatch:
    """Repeats that a batch settles by itself, as rows without keys; they are spread by owner."""
    b = _pack(np.zeros(len(row), np.uint64), np.zeros(0, np.uint64), row, owners, at, n, buckets, by=K.mix(owners[row].view(np.uint64)))
    return b.set_column(1, "keys", pa.array([b""] * b.num_rows, pa.binary()))


def _later(key: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether an equal key (a number, or a row of two) stands earlier (smaller owner, or same owner and smaller place)."""
    key = key.reshape(len(owner), -1)
    turn = np.lexsort((at, owner, *key.T[::-1]))
    out = np.zeros(len(key), bool)
    k = key[turn]
    out[turn[1:]] = (k[1:] == k[:-1]).all(axis=1)
    return out


def _column(t: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)


def _run_rows(owner, at, n, state, parts) -> pa.Table:
    part = (K.mix(owner.view(np.uint64)) % K.U64(parts)).astype(np.int64)
    turn = np.lexsort((at, owner, part))
    part, owner, state = part[turn], owner[turn], state[turn].astype(np.uint8)
    runs = np.stack([at, n], axis=1).astype(np.uint32)[turn]
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    lead = np.flatnonzero(new)
    counts = np.diff(np.append(lead, len(owner))).astype(np.uint32)
    used, first = np.unique(part, return_index=True)
    last = np.append(first[1:], len(part))[: len(first)]
    run, stop = np.searchsorted(lead, first), np.searchsorted(lead, last)
    cut = [(slice(a, b), slice(c, d)) for a, b, c, d in zip(first.tolist(), last.tolist(), run.tolist(), stop.tolist(), strict=True)]
    columns = {"owners": [owner[lead[t]].tobytes() for _, t in cut], "counts": [counts[t].tobytes() for _, t in cut], "state": [state[s].tobytes() for s, _ in cut], "runs": [runs[s].tobytes() for s, _ in cut]}
    return pa.table({"part": pa.array(used, pa.int32())} | {k: pa.array(v, pa.binary()) for k, v in columns.items()})


def _gather(t: pa.Table) -> pa.Table:
    """All that was sent about the owners of a part, one row for each owner."""
    owner = np.repeat(_column(t, "owners", np.int64), _column(t, "counts", np.uint32))
    state, runs = _column(t, "state", np.uint8), _column(t, "runs", np.uint32).reshape(-1, 2)
    turn = np.lexsort((state, owner))
    owner, state, runs = owner[turn], state[turn], runs[turn]
    known, first = np.unique(owner, return_index=True)
    cuts = [first, *(first + np.add.reduceat((state <= k).astype(np.int64), first) if len(first) else first for k in (_REPEAT, _OPEN, _HOT))]
    columns = [pa.array([runs[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary()) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"owner": pa.array(known, pa.int64()), "repeats": columns[0], "open": columns[1], "hot": columns[2]})


def _settle(t: pa.Table, part_count: int, hot: int | None) -> pa.Table:
    """A bucket's phrases or strings to runs: a key that stood earlier is a repeat; of phrases (whose ``keys`` are their triggers; ``hot`` is
    given), a new one of a trigger that has others stays open, or is hot if the trigger has more than ``hot``."""
    done = t.filter(pc.equal(pc.binary_length(t["keys"]), 0))
    t = t.filter(pc.greater(pc.binary_length(t["keys"]), 0))
    parts = []
    if done.num_rows:
        owner = np.repeat(_column(done, "owners", np.int64), _column(done, "counts", np.uint32))
        parts.append(_run_rows(owner, _column(done, "at", np.uint32), _column(done, "n", np.uint32), np.zeros(len(owner), bool), part_count))
    if t.num_rows:
        key, block = _column(t, "keys", np.uint64), _column(t, "blocks", np.uint64).reshape(-1, 2)
        owner = np.repeat(_column(t, "owners", np.int64), _column(t, "counts", np.uint32))
        at, n = _column(t, "at", np.uint32), _column(t, "n", np.uint32)
        repeat = _later(block, owner, at)
        state = np.full(len(key), _REPEAT)
        if hot is not None:
            kinds, of = np.unique(key, return_inverse=True)
            many = np.bincount(of, ~repeat, len(kinds))[of]
            state[~repeat] = np.where(many > hot, _HOT, _OPEN)[~repeat]
            tell = repeat | (many > 1)
        else:
            tell = repeat
        parts.append(_run_rows(owner[tell], at[tell], n[tell], state[tell], part_count))
    return pa.concat_tables(parts)


def _phrase_keys(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owners = b.column(0).to_numpy(zero_copy_only=False)
            data, offsets = K.text_bytes(b.column(1))
            got = []
            for lo, hi in K.slices(offsets):
                off = offsets[lo : hi + 1] - offsets[lo]
                at, n, key, block = _triggers(data[offsets[lo] : offsets[hi]], off)
                row = np.searchsorted(off, at, "right") - 1
                got.append((row + lo, at - off[row], n, key, block))
            row, at, n, key, block = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.int64),) * 5
            if not len(row):
                continue
            again = _later(block, owners[row], at)
            if again.any():
                yield _local_repeats(row[again], owners, at[again], n[again], buckets)
            yield _pack(key[~again], block[~again], row[~again], owners, at[~again], n[~again], buckets)

    return docs.select("owner", "text").where("text is not null").mapInArrow(run, _PACKED)


def _runs(packed: bytes) -> np.ndarray:
    runs = np.frombuffer(packed, np.uint32).reshape(-1, 2).astype(np.int64)
    return runs[np.argsort(runs[:, 0])]


def _spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each of some runs."""
    return np.repeat(first - np.concatenate([[0], np.cumsum(many[:-1])]), many) + np.arange(many.sum())


def suffix_ranks(data: np.ndarray) -> np.ndarray:
    """Rank of every suffix by its first LENGTH bytes (of those that have so many): prefix doubling, so equal ranks are equal bytes."""
    n, span = len(data), 8
    wide = np.zeros(n + LENGTH, np.uint8)
    wide[:n] = data
    key = np.zeros(n, np.uint64)
    for j in range(span):
        key |= wide[j : n + j].astype(np.uint64) << np.uint64(8 * (span - 1 - j))
    rank = np.unique(key, return_inverse=True)[1]
    while span < LENGTH:
        step = min(span, LENGTH - span)  # the last step overlaps
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - step)] = rank[step:]
        rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1]
        span += step
    return rank


def _phrase_bytes(docs_with_runs: DataFrame, buckets: int) -> DataFrame:
    """The bytes of open phrases, packed by the bucket of their trigger."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owners = b.column(0).to_numpy(zero_copy_only=False)
            data, offsets = K.text_bytes(b.column(1))
            lists = [_runs(x) for x in b.column(2).to_pylist()]
            if not lists:
                continue
            row, runs = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists)
            at, n = runs[:, 0], runs[:, 1]
            size = n + LENGTH - 1
            held = data[_spread(offsets[row] + at, size)]
            begin = np.concatenate([[0], np.cumsum(size)])
            first, _, key, _ = _triggers(held, begin, with_blocks=False)
            bucket = ((key[np.searchsorted(first, begin[:-1])] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            turn = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.concatenate([[True], np.diff(bucket[turn]) != 0]))
            for lo, hi in zip(cut, np.append(cut[1:], len(turn)), strict=True):
                k = turn[lo:hi]
                who, many = np.unique(row[k], return_counts=True)
                cols = (int(bucket[k[0]]), held[_spread(begin[k], size[k])].tobytes(), owners[who].tobytes(), many.astype(np.uint32).tobytes(), at[k].astype(np.uint32).tobytes(), n[k].astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_pydict(dict(zip(_PHRASE_ARROW.names, ([c] for c in cols), strict=True)), schema=_PHRASE_ARROW)

    return docs_with_runs.mapInArrow(run, _PHRASES)


def _settle_dictionary(t: pa.Table, part_count: int) -> pa.Table:
    """A bucket's dictionary, sorted: runs of string starts whose string stands earlier in the corpus."""
    data, n, at = _column(t, "phrases", np.uint8), _column(t, "n", np.uint32).astype(np.int64), _column(t, "at", np.uint32).astype(np.int64)
    owner = np.repeat(_column(t, "owners", np.int64), _column(t, "counts", np.uint32))
    size = n + LENGTH - 1
    rank = suffix_ranks(data)[_spread(np.cumsum(size) - size, n)]
    phrase, place = np.repeat(np.arange(len(n)), n), _spread(at, n)
    again = np.flatnonzero(_later(rank, owner[phrase], place))
    lead = np.flatnonzero(np.concatenate([[True], (np.diff(again) > 1) | (np.diff(phrase[again]) > 0)])[: len(again)])
    many = np.diff(np.append(lead, len(again)))
    return _run_rows(owner[phrase[again[lead]]], place[again[lead]], many, np.full(len(lead), _REPEAT), part_count)


def _string_keys(docs_with_runs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owners = b.column(0).to_numpy(zero_copy_only=False)
            data, offsets = K.text_bytes(b.column(1))
            got = []
            for i, packed in enumerate(b.column(2).to_pylist()):
                runs = _runs(packed)
                at = _spread(runs[:, 0], runs[:, 1])
                got.append((np.full(len(at), i), at, _wide(data[offsets[i] : offsets[i + 1]], at, at + LENGTH)))
            if not got:
                continue
            row, at, key = (np.concatenate(x) for x in zip(*got, strict=True))
            again = _later(key, owners[row], at)
            one = np.ones(len(at), np.int64)
            if again.any():
                yield _local_repeats(row[again], owners, at[again], one[again], buckets)
            yield _pack(key[~again, 0], key[~again], row[~again], owners, at[~again], one[~again], buckets)

    return docs_with_runs.mapInArrow(run, _PACKED)


def _cleaned(docs_with_runs: DataFrame, texts: bool) -> DataFrame:
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans array<struct<start:long,end:long>>" if texts else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            out = [[], [], [], [], []]
            for i, lists in enumerate(b.column(2).to_pylist()):
                own = data[offsets[i] : offsets[i + 1]]
                runs = np.frombuffer(b"".join(lists or []), np.uint32).reshape(-1, 2).astype(np.int64)
                edge = np.zeros(len(own) + 1, np.int64)
                np.add.at(edge, runs[:, 0], 1)
                np.add.at(edge, runs[:, 0] + runs[:, 1] + LENGTH - 1, -1)
                gone = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
                turn = np.flatnonzero(gone[1:] != gone[:-1])
                for c, v in zip(out, (len(own), int(gone.sum()), len(turn) // 2, hashlib.sha256(own[~gone[1:-1]].tobytes()).hexdigest(), [{"start": s, "end": e} for s, e in turn.reshape(-1, 2).tolist()]), strict=True):
                    c.append(v)
            cols = [b.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if texts:
                cols.append(pa.array(out[4], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs_with_runs.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, spans: bool = False, hot_phrases: int = HOT_PHRASES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row (``spans``: and the removed byte ranges).

    A byte goes if a string of 100 bytes that covers it also starts earlier in the corpus, judged on the input. Documents stand in
    order of doc_id (null first); rows that share a doc_id stand in order of text, as documents of their own. Null texts are empty;
    texts under 100 bytes keep every byte; other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count():
        docs = store.written(docs.orderBy(F.asc_nulls_first("doc_id"), "text").withColumn("owner", F.monotonically_increasing_id()), "ordered")
    else:
        docs = docs.withColumn("owner", F.col("doc_id"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = exchange.buckets_for(size / 100)

    def gathered(sent: DataFrame, name: str) -> DataFrame:
        return store.written(sent.groupBy("part").applyInArrow(_gather, _RUNS), name)

    def settled(keys: DataFrame, hot: int | None) -> DataFrame:
        return keys.groupBy("bucket").applyInArrow(lambda t: _settle(t, parts, hot), _SENT)

    phrases = gathered(settled(_phrase_keys(docs, exchange.buckets_for(size / 35)), hot_phrases), "phrases")
    held = lambda c: F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    count, opened, hot = phrases.where("octet_length(open) > 0 or octet_length(hot) > 0").agg(F.count("*"), held("open"), held("hot")).first()
    sent = []
    for column, size_of in (("open", opened), ("hot", hot)):
        if not size_of:
            continue
        left = phrases.where(F.octet_length(column) > 0).select("owner", F.col(column).alias("runs"))
        near = docs.join(F.broadcast(left.select("owner")), "owner", "left_semi") if count <= store.BROADCAST_IDS else docs
        of = near.join(left.hint("shuffle_hash"), "owner").select("owner", "text", "runs")
        if column == "open":
            # about 130 bytes a phrase, 8 bytes of which say where it is
            sent.append(_phrase_bytes(of, exchange.buckets_for(size_of * 16)).groupBy("bucket").applyInArrow(lambda t: _settle_dictionary(t, parts), _SENT))
        else:
            sent.append(settled(_string_keys(of, exchange.buckets_for(size_of * 4)), None))
    more = [gathered(reduce(DataFrame.union, sent), "strings").select("owner", "repeats")] if sent else []
    found = reduce(DataFrame.union, [phrases.select("owner", "repeats"), *more]).where(F.octet_length("repeats") > 0).groupBy("owner").agg(F.collect_list("repeats").alias("runs"))
    return _cleaned(docs.join(found.hint("shuffle_hash"), "owner", "left").select("doc_id", "text", "runs"), spans)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``; for nulls, repeats and empty tables see ``remove_repeats``."""
    return remove_repeats(store.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits, strlen(coalesce(text, '')) AS n_bytes FROM documents
), strings AS MATERIALIZED (
  SELECT doc_id, i, md5_number(substr(digits, 2 * i + 1, 200)) AS string FROM d, unnest(range(0, n_bytes - 99)) AS u(i)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY string ORDER BY doc_id, i) AS k FROM strings) WHERE k > 1
), edges AS (
  SELECT doc_id, i, i - 100 > lag(i, 1, -200) OVER (PARTITION BY doc_id ORDER BY i) AS opens FROM later
), spans AS MATERIALIZED (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges) GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, -1, 0 FROM d)
), kept AS (
  SELECT doc_id, string_agg(substr(digits, 2 * a + 1, 2 * (coalesce(b, n_bytes) - a)), '' ORDER BY a) AS digits FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
), gone AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.digits)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""
