"""Operator 4: n-gram Jaccard join by parity sketches.

Two sets link when their Jaccard similarity is at least 75 %, so their symmetric difference is at most
(|A| + |B|) / 7.  In a size band every shingle falls into one part of a sketch; a part's sketch is the exclusive or of
the hashes of its shingles.  One shingle of the symmetric difference changes one part, so the parts that differ (the
Hamming distance of the sketches, part by part) are at most the symmetric difference: of any D + 1 parts of a set, D = (n + 4n/3) / 7, taken in
one global order, linked sets share at least one.  Those parts are the join keys; empty parts are never keys.  Keys that are
common go last in the global order (an order from a bounded sample; any order is right, this one keeps candidates few).

With SPARE more keys linked sets share SPARE + 1 of them, which few other pairs do. Candidates are then held against a dense
sketch of a power of two of bits (at least 2n): the Hamming distance of two, the longer folded to the length of the
shorter, is again at most the symmetric difference.

Copies are one node: a node is the 64-bit fingerprint of a set (two different sets share one with a chance of
2**-64).  Keys travel packed by bucket, a node's once from each task.  A key group that is too large for all its pairs is a cluster: its
members meet in blocks of bounded size, block by block, and those of different components that sizes and sketches allow are
compared.  Sets are read again for candidates alone, and every candidate is verified by counting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exchange, graph, store
from . import kernel as K

WORDS = 5
PERCENT = 75
BAND = 32
LEAST_PARTS = 1 << 16
#: Documents that the order of keys is taken from, and shingles whose frequency there counts, at most.
ORDER_DOCS = 20_000
ORDER_SHINGLES = 1_000_000
#: Key groups up to this size make all their pairs at once.
SMALL_GROUP = 16
#: Members of a block of a cluster, and shingles of them, about.
SALT_FROM = 2048
BLOCK_SHINGLES = 1 << 20
BITMAP_BITS = 24
ROW_KEY = "_row_key"
#: Keys beyond the D + 1 that a set must send: linked sets then share as many more (SPARE + 1, if they have so many).
SPARE = 3


def sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a batch's texts and their rows."""
    h, first, _ = K.words(data, offsets)
    return K.distinct(*K.shingles(h, first, WORDS))


def _sizes_and_prints(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(rows, minlength=n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(K.mix(values))])
    ends = np.cumsum(size)
    return size, K.mix((sums[ends] - sums[ends - size]) ^ (size.astype(np.uint64) << K.U64(40)))


def _sketches(values: np.ndarray, rows: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Dense parity sketches: bit (hash mod width) is the parity of the shingles that fall on it."""
    width = 1 << np.ceil(np.log2(np.maximum(2 * size, 256))).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(width)])
    bit = base[rows] + (K.mix(values ^ K.U64(0xA24BAED4963EE407)) & (width[rows] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(bit, minlength=base[-1]) & 1).astype(np.uint8), bitorder="little")
    return [packed[a >> 3 : b >> 3].tobytes() for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def shingle_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node (the fingerprint of the set) and dense sketch of every row; null texts are empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            size, node, sketch = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.uint64), []
            for lo, hi in K.slices(offsets):
                v, r = sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                size[lo:hi], node[lo:hi] = _sizes_and_prints(v, r, hi - lo)
                sketch += _sketches(v, r, size[lo:hi])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(node.view(np.int64)), pa.array(sketch, pa.binary())], ["doc_id", "n_shingles", "node", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, node long, sketch binary")


def _common(docs: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a bounded sample hold, sorted, and the logarithm of how many."""
    share = min(1.0, ORDER_DOCS / max(1, total))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            values = []
            for lo, hi in K.slices(offsets):
                values.append(sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])[0])
            v, n = np.unique(np.concatenate(values) if values else np.zeros(0, np.uint64), return_counts=True)
            if len(v):
                yield exchange.pack(v, np.zeros(len(v), np.int64), np.zeros(1, np.int64), 16, n.astype(np.uint32))

    def count(t: pa.Table) -> pa.Table:
        v, n = exchange.column(t, "keys", np.uint64), exchange.column(t, "extra", np.uint32)
        u, at = np.unique(v, return_inverse=True)
        times = np.bincount(at, n)
        keep = times >= 2
        u, times = u[keep], times[keep]
        top = np.argsort(-times, kind="stable")[: ORDER_SHINGLES // 16]
        return pa.table({"values": [u[top].tobytes()], "times": [times[top].astype(np.uint32).tobytes()]})

    got = sample.mapInArrow(run, exchange.PACKED).groupBy("bucket").applyInArrow(count, "values binary, times binary").toPandas()
    v, n = np.frombuffer(b"".join(got["values"]), np.uint64), np.frombuffer(b"".join(got["times"]), np.uint32)
    turn = np.argsort(v)
    return v[turn], (1 + np.log2(np.maximum(n[turn], 1))).astype(np.uint8)


def part_keys(values: np.ndarray, rows: np.ndarray, size: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join keys of every set of a batch, their rows (ascending), and how many keys (1 to SPARE + 1) a row surely shares with a
    linked one. ``size``: of every row's set."""
    need = np.full(len(size), SPARE + 1)
    level = np.zeros(len(values), np.uint8)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], values), len(common[0]) - 1)
        level = np.where(common[0][at] == values, common[1][at], 0).astype(np.uint8)
    n = np.maximum(size, 1)
    own = np.floor(np.log(n) / np.log(BAND) + 1e-12).astype(np.int64)
    out, to = [], []
    for up in (0, 1):
        band = own + up
        # the next band as well, where a set up to a third larger reaches into it
        use = np.flatnonzero(size > 0) if not up else np.flatnonzero((size > 0) & (size * 4 // 3 >= float(BAND) ** band))
        if not len(use):
            continue
        chosen = np.zeros(len(size), bool)
        chosen[use] = True
        pick = chosen[rows]
        v, r, lv = values[pick], rows[pick], level[pick]
        parts = np.maximum(LEAST_PARTS, 4 * float(BAND) ** (band[r] + 1)).astype(np.uint64)
        part = (K.mix(v ^ K.U64(0x5851F42D4C957F2D)) >> K.U64(8)) % parts
        turn = np.lexsort((part, r))
        v, r, lv, part = v[turn], r[turn], lv[turn], part[turn]
        new = np.ones(len(v), bool)
        new[1:] = (part[1:] != part[:-1]) | (r[1:] != r[:-1])
        lead = np.flatnonzero(new)
        if not len(lead):
            continue
        sketch = np.bitwise_xor.reduceat(K.mix(v), lead)
        rank = np.minimum.reduceat(lv, lead)
        r, part = r[lead], part[lead]
        key = K.mix(sketch ^ K.mix(part * K.U64(0x9E3779B97F4A7C15) + band[r].astype(np.uint64)))
        full = sketch != 0
        key, r, rank = key[full], r[full], rank[full]
        turn = np.lexsort((key, rank, r))
        key, r = key[turn], r[turn]
        first = np.searchsorted(r, np.arange(len(size)))
        most = (size + size * 4 // 3) // 7
        keep = np.arange(len(r)) - first[r] <= most[r] + SPARE
        need[use] = np.minimum(need[use], np.maximum(1, np.bincount(r, minlength=len(size))[use] - most[use]))
        out.append(key[keep])
        to.append(r[keep])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), need
    key, row = np.concatenate(out), np.concatenate(to)
    turn = np.argsort(row, kind="stable")
    return key[turn], row[turn], need


def _pairs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs within small groups."""
    a, b = [], []
    size = ends - starts
    for n in np.unique(size):
        i, j = np.triu_indices(int(n), 1)
        at = starts[size == n][:, None]
        a.append((at + i).ravel())
        b.append((at + j).ravel())
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def _unique_pairs(a: np.ndarray, b: np.ndarray, shared: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Pairs without order, once each; ``shared`` is summed."""
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    turn = np.lexsort((hi, lo))
    lo, hi = lo[turn], hi[turn]
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    lead = np.flatnonzero(new)
    out = {"u": lo[lead], "v": hi[lead]}
    if shared is not None:
        out["shared"] = np.add.reduceat(shared[turn], lead) if len(lead) else shared[:0]
    keep = out["u"] != out["v"]
    return {k: x[keep] for k, x in out.items()}


def _candidates(t: pa.Table, parts: int) -> pa.Table:
    """Pairs of a bucket with the share of the keys that they need, packed by a hash of the pair. A group that is too large
    for all its pairs joins the cluster of its lead (the member of the lowest hash), which comes out in ``members``."""
    key, owner = exchange.unpack(t)
    info = np.repeat(exchange.column(t, "info", np.uint32), exchange.column(t, "counts", np.uint32))
    turn = np.lexsort((owner, key))
    key, owner, info = key[turn], owner[turn], info[turn]
    once = np.ones(len(key), bool)
    once[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner, info = key[once], owner[once], info[once]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(key))[: len(starts)]
    size = ends - starts
    few = (size > 1) & (size <= SMALL_GROUP)
    i, j = _pairs(starts[few], ends[few])
    x, y = (info[i] >> 3).astype(np.int64), (info[j] >> 3).astype(np.int64)
    fit = 4 * np.minimum(x, y) >= 3 * np.maximum(x, y)
    i, j = i[fit], j[fit]
    pairs = _unique_pairs(owner[i], owner[j], 1.0 / np.minimum(info[i] & 7, info[j] & 7))
    part = (K.mix(pairs["u"].view(np.uint64) ^ K.mix(pairs["v"].view(np.uint64))) % K.U64(parts)).astype(np.int64)
    turn = np.argsort(part, kind="stable")
    used, at = np.unique(part[turn], return_index=True)
    cut = list(zip(at.tolist(), np.append(at[1:], len(part)).tolist(), strict=True)) if len(used) else []
    clusters: dict[int, list[np.ndarray]] = {}
    for g in np.flatnonzero(size > SMALL_GROUP):
        m = owner[starts[g] : ends[g]]
        clusters.setdefault(int(m[np.argmin(K.mix(m.view(np.uint64)))]), []).append(m)
    lead, members = list(clusters), [np.unique(np.concatenate(lists)).tobytes() for lists in clusters.values()]
    none, n = [None] * len(lead), len(cut)
    packed = {k: pa.array([pairs[k][turn[a:b]].tobytes() for a, b in cut] + none, pa.binary()) for k in ("u", "v", "shared")}
    return pa.table({"part": pa.array(used.tolist() + none, pa.int32())} | packed | {"lead": pa.array([None] * n + lead, pa.int64()), "members": pa.array([None] * n + members, pa.binary())})


_CANDIDATES = "part int, u binary, v binary, shared binary, lead long, members binary"


def _likely_pairs(packed: DataFrame) -> DataFrame:
    """Pairs that share the keys they need: their shares add up to one."""
    def add_up(t: pa.Table) -> pa.Table:
        p = _unique_pairs(*(exchange.column(t, c, k) for c, k in (("u", np.int64), ("v", np.int64), ("shared", np.float64))))
        keep = p["shared"] > 0.999
        return pa.table({"u": p["u"][keep], "v": p["v"][keep]})

    return packed.where("part is not null").select("part", "u", "v", "shared").groupBy("part").applyInArrow(add_up, "u long, v long")


def _clusters(packed: DataFrame) -> DataFrame:
    """(lead, node) of the clusters of large groups, each node once in a cluster."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                m = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), c)), pa.array(m)], ["lead", "node"])

    return packed.where("members is not null").select("lead", "members").mapInArrow(spread, "lead long, node long").distinct()


_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)
_ONES16 = (_ONES[:, None] + _ONES[None, :]).ravel().astype(np.uint8)


def _sketched(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sketches are near enough: none of the others can link."""
    def side(at: str, mark: str) -> DataFrame:
        return nodes.select(F.col("node").alias(at), F.col("n").alias(f"n{mark}"), F.col("sketch").alias(f"s{mark}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for i, (na, a, nb, b) in enumerate(zip(*(t.column(c).to_pylist() for c in range(2, 6)), strict=True)):
                x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if len(x) > len(y):
                    x, y = y, x
                while len(y) > len(x):
                    y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                if 4 * min(na, nb) >= 3 * max(na, nb) and 7 * _ONES[x ^ y].sum() <= na + nb:
                    keep.append(i)
            if keep:
                yield pa.RecordBatch.from_arrays([c.take(pa.array(keep)) for c in t.columns[:2]], ["u", "v"])

    return pairs.join(side("u", "a"), "u").join(side("v", "b"), "v").select("u", "v", "na", "sa", "nb", "sb").mapInArrow(run, "u long, v long")


def _candidate_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and packed set of ``wanted`` (node, lowest: a doc_id). While the ids are few they are broadcast; else a bitmap of fixed
    size thins the texts and the join does the rest."""
    ids = wanted.select(F.col("lowest").alias("doc_id"))
    few = ids.count() <= store.BROADCAST_IDS
    held = docs.sparkSession.sparkContext.broadcast(None if few else store.bitmap_of(wanted, "lowest", BITMAP_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(1)
            if held.value is not None:
                text = text.take(pa.array(np.flatnonzero(store.look_up(held.value, b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)))))
            data, offsets = K.text_bytes(text)
            for lo, hi in K.slices(offsets):
                v, r = sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                size, node = _sizes_and_prints(v, r, hi - lo)
                ends = np.cumsum(size)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array([v[e - s : e].tobytes() for e, s in zip(ends, size, strict=True)], pa.binary())], ["node", "held"])

    near = docs.where("text is not null")
    if few:
        near = near.join(F.broadcast(ids), "doc_id", "left_semi")
    made = near.select(store.in_bitmap("doc_id", BITMAP_BITS).alias("at"), "text").mapInArrow(run, "node long, held binary")
    return made.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("held").alias("held"))


def _verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs whose sets are similar enough, counted exactly."""
    left, right = members.select(F.col("node").alias("u"), F.col("held").alias("a")), members.select(F.col("node").alias("v"), F.col("held").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for i, (x, y) in enumerate(zip(t.column(2).to_pylist(), t.column(3).to_pylist(), strict=True)):
                n = (len(x) + len(y)) // 8
                both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= PERCENT * (n - shared):
                    keep.append(i)
            if keep:
                yield pa.RecordBatch.from_arrays([c.take(pa.array(keep)) for c in t.columns[:2]], ["u", "v"])

    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _links(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Verified links of a written frame of pairs; only the sets that the pairs name are shuffled."""
    named = store.checked(pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct(), "named")
    return store.written(_verified(pairs, members.join(named, "node", "left_semi")), "links")


def _near(i: int, n: np.ndarray, width: np.ndarray, grids: dict[int, np.ndarray], rest: np.ndarray) -> np.ndarray:
    """Which of ``rest`` are near enough to member i by size and sketch."""
    rest = rest[4 * np.minimum(n[i], n[rest]) >= 3 * np.maximum(n[i], n[rest])]
    out = []
    for w in np.unique(width[rest]):
        j = rest[width[rest] == w]
        low = min(int(w), int(width[i]))
        far = _ONES16[grids[low][i] ^ grids[low][j]].sum(axis=1)
        out.append(j[7 * far <= n[i] + n[j]])
    return np.concatenate(out) if out else rest


def _blocks(clusters: DataFrame, label: DataFrame, nodes: DataFrame, how: str) -> DataFrame:
    """(lead, a, b, salt, node, n, component): members of pairs of blocks that ``how`` looks at, of clusters with several components.
    Clusters of one block are looked at ``inside`` alone.

    A block holds about SALT_FROM members and BLOCK_SHINGLES shingles of them at most, whatever the size of its cluster. ``inside``: each block
    with itself. ``all``: the members outside the largest component make blocks of their own (negative salts), and these meet each other
    and the blocks of the largest component, which needn't meet each other. ``heads``: the same for one member of each component and block."""
    of = clusters.join(label.withColumnRenamed("node", "l"), F.col("node") == F.col("l"), "left").select("lead", "node", F.coalesce("component", "node").alias("component")).join(nodes.select("node", "n"), "node")
    spot = F.xxhash64("node", F.lit(3))

    def weight(count: F.Column, shingles: F.Column) -> F.Column:
        return F.greatest(count / SALT_FROM, shingles / BLOCK_SHINGLES)

    def with_sizes(members: DataFrame) -> DataFrame:
        size = members.groupBy("lead", "component").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
        leads = size.groupBy("lead").agg(F.sum("members").alias("members"), F.sum("shingles").alias("shingles"), F.max(F.struct("members", "shingles", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
        total, most = weight(F.col("members"), F.col("shingles")), weight(F.col("main.members"), F.col("main.shingles"))
        rest = weight(F.col("members") - F.col("main.members"), F.col("shingles") - F.col("main.shingles"))
        return members.join(store.checked(leads.select("lead", total.alias("total"), most.alias("most"), rest.alias("rest"), F.col("main.component").alias("main")), "leads"), "lead")

    def blocks(weight: F.Column) -> F.Column:
        return F.greatest(F.lit(1), F.ceil(weight)).cast("int")

    sized = with_sizes(of)
    if how != "inside":
        sized = sized.where("total > 1")
    if how == "heads":
        # one member of each component in each block of the round before
        heads = sized.groupBy("lead", "component", F.pmod(spot, blocks(F.col("total"))).alias("block")).agg(F.min(F.struct("node", "n")).alias("head"))
        sized = with_sizes(heads.select("lead", "component", "head.node", "head.n"))
    if how == "inside":
        salt = F.pmod(spot, blocks(F.col("total"))).cast("int")
        return sized.select("lead", salt.alias("a"), salt.alias("b"), salt.alias("salt"), "node", "n", "component")
    inner, outer = blocks(F.col("most")), blocks(F.col("rest"))
    first = F.col("component") == F.col("main")
    salt = F.when(first, F.pmod(spot, inner).cast("int")).otherwise(-1 - F.pmod(spot, outer).cast("int"))
    others = F.sequence(-outer, F.lit(-1))
    met = F.when(first, others).otherwise(F.concat(others, F.sequence(F.lit(0), inner - 1)))
    dealt = sized.select("lead", salt.alias("salt"), "node", "n", "component", F.explode(met).alias("other"))
    return dealt.select("lead", F.least("salt", "other").alias("a"), F.greatest("salt", "other").alias("b"), "salt", "node", "n", "component")


def _grids(raw: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Widths of sketches, and every sketch folded to each width up to its own."""
    width, grids = np.array([len(x) for x in raw]), {}
    for w in np.unique(width):
        g = np.zeros((len(raw), int(w)), np.uint8)
        for i, x in enumerate(raw):
            x = np.frombuffer(x, np.uint8)
            if len(x) < w:
                continue
            while len(x) > w:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            g[i] = x
        grids[int(w)] = g.view(np.uint16)
    return width, grids


def _open_pairs(t: pa.Table, comp: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Members of a pair of blocks, each with the later ones of other components that sizes and sketches allow. ``comp`` may change
    on the way."""
    n, salt = t["n"].to_numpy(), t["salt"].to_numpy()
    if len(n) < 2 or (comp == comp[0]).all():
        return
    across = t["a"][0].as_py() != t["b"][0].as_py()
    width, grids = _grids(t["sketch"].to_pylist())
    for i in range(len(n)):
        rest = i + 1 + np.flatnonzero((comp[i + 1 :] != comp[i]) & ((salt[i + 1 :] != salt[i]) | (not across)))
        yield i, _near(i, n, width, grids, rest)


def _cluster_links(clusters: DataFrame, label: DataFrame, nodes: DataFrame, sets_of: DataFrame, how: str) -> DataFrame:
    """Links that join the components of a cluster's members, of all pairs of members that ``how`` looks at. Every pair of blocks is looked
    at once, in a task of its own: first by sizes and sketches, and what these leave open by the sets, but for pairs that are joined by then."""
    sketches = nodes.select("node", "sketch")

    def leave_open(t: pa.Table) -> pa.Table:
        live = np.zeros(t.num_rows, bool)
        for i, near in _open_pairs(t, t["component"].to_numpy()):
            if len(near):
                live[i] = live[near] = True
        return t.select(["lead", "a", "b", "salt", "node", "n", "component"]).filter(pa.array(live))

    def verify(t: pa.Table) -> pa.Table:
        node, comp = t["node"].to_numpy(), t["component"].to_numpy().copy()
        held, u, v = [np.frombuffer(x, np.uint64) for x in t["held"].to_pylist()], [], []
        for i, near in _open_pairs(t, comp):
            for j in near.tolist():
                if comp[j] == comp[i]:
                    continue
                a, b = (held[i], held[j]) if len(held[i]) <= len(held[j]) else (held[j], held[i])
                shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                if 100 * shared >= PERCENT * (len(a) + len(b) - shared):
                    u.append(node[i])
                    v.append(node[j])
                    comp[comp == comp[j]] = comp[i]
        return pa.table(_unique_pairs(np.array(u, np.int64), np.array(v, np.int64)))

    blocks = _blocks(clusters, label, nodes, how)
    schema = "lead long, a int, b int, salt int, node long, n long, component long"
    left = store.written(blocks.join(sketches, "node").select(*blocks.columns, "sketch").groupBy("lead", "a", "b").applyInArrow(leave_open, schema), "open")
    named = store.checked(left.select("node").distinct(), "open-nodes")
    keyed = left.join(sketches.join(sets_of, "node").join(named, "node", "left_semi"), "node")
    return keyed.groupBy("lead", "a", "b").applyInArrow(verify, "u long, v long")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    def at(side: str) -> DataFrame:
        return label.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))

    return pairs.join(at("u"), "u", "left").join(at("v"), "v", "left").where(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v")


def _relabelled(label: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only the graph of the components that they join is solved."""
    def at(side: str) -> DataFrame:
        return label.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))

    joined = links.join(at("u"), "u", "left").join(at("v"), "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    merged = store.written(graph.components(joined), "merged")
    moved = label.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return moved.union(merged.join(label.select("node"), "node", "left_anti").select("node", "component"))


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach, itself included) of every row.

    Null or empty texts, and texts without words, have no shingles and link with nothing; texts of fewer than five words are one
    shingle; copies link with each other; rows with one doc_id are rows of their own; other columns are ignored; an empty table
    gives no rows."""
    spark = docs.sparkSession
    table = store.written(shingle_table(docs), "shingles")
    total, shingles = table.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    common = spark.sparkContext.broadcast(_common(docs, total))
    buckets = exchange.buckets_for(0.35 * shingles)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for b in batches:
            data, offsets = K.text_bytes(b.column(0))
            found, owners, info = [], np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.uint32)
            for lo, hi in K.slices(offsets):
                v, r = sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                size, node = _sizes_and_prints(v, r, hi - lo)
                owners[lo:hi] = node.view(np.int64)
                new = np.array([x not in sent and not sent.add(x) for x in node.tolist()], bool)  # a copy's keys are sent once
                v, r = v[new[r]], r[new[r]]
                size = np.where(new, size, 0)
                key, row, need = part_keys(v, r, size, common.value)
                info[lo:hi] = size * 8 + need
                found.append((key, row + lo))
            key, row = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            if len(key):
                yield exchange.pack(key, row, owners, buckets, info=info)

    parts = exchange.buckets_for(shingles / 50)
    candidates = store.written(docs.select("text").where("text is not null").mapInArrow(keys, exchange.PACKED).groupBy("bucket").applyInArrow(lambda t: _candidates(t, parts), _CANDIDATES), "candidates")
    nodes = store.written(table.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("lowest"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    pairs = store.written(_sketched(_likely_pairs(candidates), nodes), "pairs")
    clusters = store.written(_clusters(candidates), "clusters")
    known = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).union(clusters.select("node")).distinct()
    wanted = store.written(known.join(nodes, "node").select("node", "lowest"), "wanted")
    sets_of = store.written(_candidate_sets(docs, wanted), "sets")
    first = store.written(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "first")  # one pair a node; most of the others then lie in one component
    label = store.written(graph.components(_links(first, sets_of)), "labels")
    rest = store.written(_apart(pairs.join(first, ["u", "v"], "left_anti"), label), "rest")
    if rest.limit(1).count():
        label = store.written(_relabelled(label, _links(rest, sets_of)), "labels")
    size = clusters.join(nodes.select("node", "n"), "node").groupBy("lead").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    members, held = size.agg(F.max("members"), F.max("shingles")).first()
    # in clusters of several blocks most members join within their block and by its heads, and few are left for all pairs of blocks
    rounds = [] if not members else ["inside", "heads", "all"] if members > SALT_FROM or held > BLOCK_SHINGLES else ["inside"]
    for how in rounds:
        more = store.written(_cluster_links(clusters, label, nodes, sets_of, how), "cluster-links")
        if more.limit(1).count():
            label = store.written(_relabelled(label, more), "labels")
    lowest = nodes.join(label, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "lowest")
    final = lowest.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_node = lowest.join(final, "component").select("node", "component_id")
    return table.join(of_node, "node", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``; for nulls, repeats and empty tables see ``similar_components``."""
    return similar_components(store.table(spark, sf_dir, "documents"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest doc_id stays (null ids last, then the first row). Rows are told
    apart by a key of their own, so rows that share a doc_id, or have none, go only as copies."""
    keyed = store.written(docs.withColumn(ROW_KEY, F.monotonically_increasing_id()), "keyed")
    found = store.written(similar_components(keyed.select(F.col(ROW_KEY).alias("doc_id"), "text")), "components")
    others = found.where("doc_id <> component_id").select(F.col("doc_id").alias(ROW_KEY), "component_id")
    leads = others.select(F.col("component_id").alias(ROW_KEY), "component_id").distinct()
    members = store.written(others.union(leads).join(keyed.select(ROW_KEY, "doc_id"), ROW_KEY), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW_KEY)).alias("first")).select(F.col(f"first.{ROW_KEY}").alias(ROW_KEY))
    gone = members.select(ROW_KEY).join(first, ROW_KEY, "left_anti")
    return keyed.join(store.checked(gone, "copies"), ROW_KEY, "left_anti").select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle FROM d, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS u(i)
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), linked AS (
  SELECT x, y FROM met JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 75 * (a.size + b.size - shared)
), ways AS MATERIALIZED (
  SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked
), reach(doc_id, seen) AS (
  SELECT x, x FROM ways UNION SELECT reach.doc_id, ways.y FROM reach JOIN ways ON ways.x = reach.seen
), least_seen AS (
  SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(size, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least_seen USING (doc_id)
"""
