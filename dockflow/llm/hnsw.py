"""Operator 7: near-duplicate embeddings with one hierarchical navigable small-world graph for each shard.

Equal vectors are one node first.  Nodes are dealt to shards by a hash; each shard's graph is built in one task of bounded
size and nodes query the shards, streamed past the graph in blocks: of two shards one queries the other, so every pair of
nodes is looked for once.  Searches run side by side on arrays, beam by
beam.  The first queries of a shard, in an order of chance, are compared with every node, and so are planted ones, which are nodes that were
moved to a cosine of PLANTED; the beam widens until it finds their links again, and only where none does all queries are compared with every node.  For a single
query the beam also widens as long as its whole beam is within the threshold; a query in a crowd that would fill a large beam is
compared with every node.  Found pairs are verified by cosine in double precision.

A task doesn't send its links out one by one: it sums them up as numbers of links by node and as a spanning forest, so what a
crowd of m near copies sends grows with m and not with its square.  Forests are joined into components.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import graph, store
from . import kernel as K

THRESHOLD = 0.9
#: Nodes of a shard, at most, and bytes of its vectors.
SHARD_NODES = 1 << 15
SHARD_BYTES = 64 << 20
QUERY_NODES = 65536
BLOCK = 1024
DEGREE, UPPER_DEGREE = 24, 12
BUILD_BEAM, FIRST_BEAM = 40, 32
#: Queries of a shard's audit, and the share of their true neighbours that must be found.
AUDIT, AUDIT_RECALL = 128, 0.99
#: Cosine of a planted query to the node it was made from: a link, but nearer to the threshold than most.
PLANTED = 0.92
#: The widest beam is this share of a shard, or WIDEST_BEAM if that is more: beyond it a walk costs more than comparing all nodes.
WIDEST_SHARE, WIDEST_BEAM = 128, 256
#: Cosines of unit vectors in single precision are off by less.
SLACK = 1e-3


def _diverse(sim: np.ndarray, ids: np.ndarray, vectors: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (sorted by falling similarity, -1 padded), those nearer to the row than to any chosen one;
    then the nearest of the rest."""
    n, c = ids.shape
    v = vectors[np.maximum(ids, 0)]
    near = np.einsum("ncd,nkd->nck", v, v)
    taken, count = np.zeros((n, c), bool), np.zeros(n, np.int64)
    for j in range(c):
        close = np.where(taken, near[:, j, :], -2.0).max(axis=1) if j else np.full(n, -2.0)
        ok = (ids[:, j] >= 0) & (count < degree) & (close < sim[:, j])
        taken[:, j] = ok
        count += ok
    rank = np.argsort(np.where(taken, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")
    out = np.take_along_axis(ids, rank, axis=1)[:, :degree]
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


class Layer:
    """Neighbours of the nodes of one layer, -1 padded; nodes are numbers into the shard's vectors."""

    def __init__(self, n: int, degree: int):
        self.links = np.full((n, degree), -1, np.int32)

    def search(self, vectors: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities (falling) of the best nodes for each query from its entry points (-1 padded)."""
        q, n = len(queries), len(vectors)
        seen = np.zeros((q, n + 1), bool)
        rows = np.arange(q)[:, None]
        ids = np.full((q, beam), -1, np.int32)
        sims = np.full((q, beam), -2.0, np.float32)
        w = min(beam, entry.shape[1])
        ids[:, :w] = entry[:, :w]
        seen[rows, ids] = True
        sims[:, :w] = np.where(ids[:, :w] >= 0, np.einsum("qed,qd->qe", vectors[np.maximum(ids[:, :w], 0)], queries), -2.0)
        open_ = ids >= 0
        live = np.arange(q)
        while len(live):
            best = np.argmax(np.where(open_[live], sims[live], -3.0), axis=1)
            has = open_[live, best]
            live, best = live[has], best[has]
            if not len(live):
                break
            open_[live, best] = False
            near = self.links[ids[live, best]]
            fresh = (near >= 0) & ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            s = np.where(fresh, np.einsum("qed,qd->qe", vectors[np.maximum(near, 0)], queries[live]), -2.0).astype(np.float32)
            all_ids, all_sims = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1), np.concatenate([sims[live], s], axis=1)
            all_open = np.concatenate([open_[live], fresh], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live], sims[live], open_[live] = (np.take_along_axis(x, top, axis=1) for x in (all_ids, all_sims, all_open))
        turn = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, turn, axis=1), np.take_along_axis(sims, turn, axis=1)

    def insert(self, vectors: np.ndarray, nodes: np.ndarray, inside: np.ndarray, entry: np.ndarray) -> None:
        """Link ``nodes`` to the layer, whose members so far are ``inside``; ``entry``: entry points of each."""
        degree = self.links.shape[1]
        own = vectors[nodes] @ vectors[nodes].T
        np.fill_diagonal(own, -2.0)
        k = min(BUILD_BEAM, len(nodes))
        mates = np.argsort(-own, axis=1)[:, :k]
        ids, sims = nodes[mates].astype(np.int32), np.take_along_axis(own, mates, axis=1)
        ids = np.where(sims > -2, ids, -1)
        if len(inside):
            i2, s2 = self.search(vectors, vectors[nodes], entry, BUILD_BEAM)
            ids, sims = np.concatenate([i2, ids], axis=1), np.concatenate([s2, sims], axis=1)
        turn = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
        ids, sims = np.take_along_axis(ids, turn, axis=1), np.take_along_axis(sims, turn, axis=1)
        chosen = _diverse(sims, ids, vectors, degree)
        self.links[nodes] = chosen
        to, of = chosen.ravel(), np.repeat(nodes, degree).astype(np.int32)
        to, of = to[to >= 0], of[chosen.ravel() >= 0]
        turn = np.argsort(to, kind="stable")
        to, of = to[turn], of[turn]
        who, at, many = np.unique(to, return_index=True, return_counts=True)
        for lo in range(0, len(who), 512):
            w = who[lo : lo + 512]
            room = min(int(many[lo : lo + 512].max()), 4 * degree)
            extra = np.full((len(w), room), -1, np.int32)
            for r, (a, m) in enumerate(zip(at[lo : lo + 512], many[lo : lo + 512], strict=True)):
                new = of[a : a + m]
                if m > room:
                    new = new[np.argsort(-(vectors[new] @ vectors[w[r]]))[:room]]
                extra[r, : len(new)] = new
            ids = np.concatenate([self.links[w], extra], axis=1)
            ids.sort(axis=1)
            ids[:, 1:] = np.where(ids[:, 1:] == ids[:, :-1], -1, ids[:, 1:])
            sims = np.where(ids >= 0, np.einsum("ned,nd->ne", vectors[np.maximum(ids, 0)], vectors[w]), -2.0)
            turn = np.argsort(-sims, axis=1, kind="stable")
            self.links[w] = _diverse(np.take_along_axis(sims, turn, axis=1), np.take_along_axis(ids, turn, axis=1), vectors, degree)


class Graph:
    """A shard: unit vectors and layers, the widest last."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, copies: np.ndarray | None = None):
        turn = np.argsort(K.mix(ids.view(np.uint64)))
        self.ids, self.raw = ids[turn], raw[turn]
        self.copies = np.ones(len(ids), np.int64) if copies is None else copies[turn]
        self.vectors = _unit(self.raw)
        n = len(ids)
        draw = (K.mix(self.ids.view(np.uint64) ^ K.U64(0x1234567)) >> K.U64(11)).astype(float) / (1 << 53)
        level = np.minimum(-np.log(np.maximum(draw, 1e-300)) / np.log(DEGREE), np.log(max(n, 2)) / np.log(DEGREE)).astype(np.int64)
        level[0] = level.max()  # the entry point
        self.layers = []
        for depth in range(int(level.max()), -1, -1):
            layer = Layer(n, UPPER_DEGREE if depth else DEGREE)
            nodes = np.flatnonzero(level >= depth)
            done, size = 1, 1
            while done < len(nodes):
                batch = nodes[done : done + size]
                layer.insert(self.vectors, batch, nodes[:done], self._entry(self.vectors[batch], 4))
                done, size = done + len(batch), min(size * 2, 512)
            self.layers.append(layer)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "vectors"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state
        self.vectors = _unit(self.raw)

    @property
    def widest(self) -> int:
        return max(WIDEST_BEAM, len(self.ids) // WIDEST_SHARE)

    def _entry(self, queries: np.ndarray, width: int) -> np.ndarray:
        at = np.zeros((len(queries), 1), np.int32)
        for layer in self.layers:
            at = layer.search(self.vectors, queries, at, width)[0]
        return at

    def near(self, ids: np.ndarray, raw: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries and nodes of the links that the graph finds, and the queries whose crowd is too large for a beam."""
        unit = _unit(raw)
        todo, widest = np.arange(len(raw)), max(beam, self.widest)
        entry, out = np.zeros((len(raw), 1), np.int32), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for layer in self.layers[:-1]:
            entry = layer.search(self.vectors, unit, entry, 4)[0]
        while len(todo) and beam <= widest:
            width = min(beam, len(self.ids))
            found, sims = self.layers[-1].search(self.vectors, unit[todo], entry[todo], width)
            hit = (sims >= THRESHOLD - SLACK) & (found >= 0)
            full = hit.all(axis=1) & (width < len(self.ids))
            r, c = np.nonzero(hit & ~full[:, None])
            out.append(self._verified(ids, raw, todo[r], found[r, c].astype(np.int64), sims[r, c]))
            todo, beam = todo[full], beam * 4
        return (*(np.concatenate(x) for x in zip(*out, strict=True)), todo)

    def _verified(self, ids: np.ndarray, raw: np.ndarray, q: np.ndarray, n: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the found pairs that are links, of different nodes; what single precision leaves open is decided in double precision."""
        keep = ids[q] != self.ids[n]
        q, n, sims = q[keep], n[keep], sims[keep]
        good = sims >= THRESHOLD + SLACK
        open_ = np.flatnonzero(~good)
        for lo in range(0, len(open_), BLOCK * 16):
            at = open_[lo : lo + BLOCK * 16]
            a, b = scaled(raw[q[at]]), scaled(self.raw[n[at]])
            good[at] = np.einsum("pd,pd->p", a, b) / (np.sqrt(np.einsum("pd,pd->p", a, a)) * np.sqrt(np.einsum("pd,pd->p", b, b))) >= THRESHOLD
        return q[good], n[good]

    def exact(self, ids: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries and nodes of all links of a few queries: every query against every node."""
        sims = _unit(raw) @ self.vectors.T
        q, n = np.nonzero(sims >= THRESHOLD - SLACK)
        return self._verified(ids, raw, q, n, sims[q, n])


def scaled(raw: np.ndarray) -> np.ndarray:
    """Vectors over their largest component, so that squares neither vanish nor overflow; cosines stay."""
    return raw / np.abs(raw).max(axis=1, keepdims=True) if len(raw) else raw


def _unit(raw: np.ndarray) -> np.ndarray:
    raw = scaled(raw)
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


class Audit:
    """A stream of queries to a shard, in an order of chance. AUDIT planted queries and the first AUDIT real ones are compared with every node.
    Then ``beam`` is the first whose recall on those with links passes, over all links and as a mean of the queries; if none does, every query is
    compared with every node. ``through_graph`` and ``exhaustive`` count the queries."""

    def __init__(self, shard: Graph):
        self.shard, self.beam, self.seen = shard, 0, 0
        self.through_graph = self.exhaustive = 0
        self.found, self.true = 0, 0  # links of the audited queries at the chosen beam
        self.held: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []
        self._plant()

    def _plant(self) -> None:
        """Queries near the first nodes, which stand in an order of chance: each is moved in a direction of chance, at right angles."""
        nodes = scaled(self.shard.raw[:AUDIT])
        nodes = nodes / np.linalg.norm(nodes, axis=1, keepdims=True)
        away = np.random.default_rng(len(self.shard.ids)).normal(size=nodes.shape)
        away -= (away * nodes).sum(axis=1, keepdims=True) * nodes
        far = np.linalg.norm(away, axis=1, keepdims=True)
        moved = PLANTED * nodes + np.sqrt(1 - PLANTED**2) * away / np.where(far > 0, far, 1.0)
        ids = -1 - np.arange(len(moved))
        self._keep(ids, moved, *self.shard.exact(ids, moved))

    def _keep(self, ids: np.ndarray, raw: np.ndarray, q: np.ndarray, n: np.ndarray) -> None:
        live, at, many = np.unique(q, return_index=True, return_counts=True)  # queries rise
        self.held.append((ids[live], raw[live], [n[a : a + m] for a, m in zip(at, many, strict=True)]))

    def _add(self, ids: np.ndarray, raw: np.ndarray, q: np.ndarray, n: np.ndarray) -> None:
        self._keep(ids, raw, q, n)
        self.seen += len(ids)
        if self.seen >= AUDIT:
            self.beam = self._passing()
            self.held = []

    def end(self) -> None:
        """Fewer than AUDIT queries came: all were compared with every node, and so were the planted ones."""
        if not self.beam:
            self.found = self.true = sum(len(n) for _, _, links in self.held for n in links)

    def _passing(self) -> int:
        ids, raw = (np.concatenate([h[i] for h in self.held]) for i in (0, 1))
        true = [n for h in self.held for n in h[2]]
        size = np.array([len(t) for t in true])
        beam = FIRST_BEAM
        while beam < len(self.shard.ids) and beam <= self.shard.widest:
            q, n, crowded = self.shard.near(ids, raw, beam)
            turn = np.argsort(q, kind="stable")
            cut = np.searchsorted(q[turn], np.arange(len(ids) + 1))
            got = np.array([len(np.intersect1d(t, n[turn[a:b]])) for t, a, b in zip(true, cut[:-1], cut[1:], strict=True)])
            got[crowded] = size[crowded]  # those are compared with every node
            if got.sum() >= AUDIT_RECALL * size.sum() and (got / size).mean() >= AUDIT_RECALL:
                self.found, self.true = int(got.sum()), int(size.sum())
                return beam
            beam *= 2
        self.found = self.true = int(size.sum())  # every query is compared with every node
        return len(self.shard.ids)

    def blocks(self, ids: np.ndarray, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Links of the next queries with the shard's nodes, as numbers of both, in blocks; and whether a block holds all links of its queries."""
        lo = 0
        while lo < len(ids) and (not self.beam or self.beam >= len(self.shard.ids)):
            at = np.arange(lo, min(lo + AUDIT, len(ids)))
            q, n = self.shard.exact(ids[at], raw[at])
            self.exhaustive += len(at)
            yield q + lo, n, True
            if not self.beam:
                self._add(ids[at], raw[at], q, n)
            lo += AUDIT
        if lo < len(ids):
            q, n, crowded = self.shard.near(ids[lo:], raw[lo:], self.beam)
            self.through_graph += len(ids) - lo - len(crowded)
            self.exhaustive += len(crowded)
            yield q + lo, n, False
            for c in range(0, len(crowded), AUDIT):
                at = crowded[c : c + AUDIT] + lo
                q, n = self.shard.exact(ids[at], raw[at])
                yield at[q], n, True

    def links(self, ids: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of the next queries with the shard's nodes, as ids."""
        got = list(self.blocks(ids, raw))
        return ids[np.concatenate([q for q, _, _ in got])], self.shard.ids[np.concatenate([n for _, n, _ in got])]


class Summary:
    """What a shard's task sends of its links: numbers of links by node, and a spanning forest."""

    def __init__(self, shard: Graph):
        self.shard, n = shard, len(shard.ids)
        self.order = np.argsort(shard.ids)
        self.degree, self.root = np.zeros(n, np.int64), np.arange(n)
        # queries that are nodes of the shard meet each other from both ends
        self.whole, self.from_whole = np.zeros(n, bool), np.zeros(n, np.int64)
        self.pairs: list[np.ndarray] = []

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Nodes a and b are of one component: labels go to their minimum, by hooking and short cuts."""
        while True:
            x, y = self.root[a], self.root[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            low = np.minimum(x, y)
            np.minimum.at(self.root, np.maximum(x, y), low)
            while True:
                jump = self.root[self.root]
                if (jump == self.root).all():
                    break
                self.root = jump

    def own(self, ids: np.ndarray, blocks: Iterator[tuple[np.ndarray, np.ndarray, bool]]) -> None:
        """Links of queries that are nodes of the shard."""
        place = self.order[np.searchsorted(self.shard.ids, ids, sorter=self.order)]
        count = len(self.degree)
        for q, n, whole in blocks:
            p = place[q]
            self._join(p, n)
            if whole:
                self.whole[p] = True
                self.degree += np.bincount(p, self.shard.copies[n], count).astype(np.int64)
                self.from_whole += np.bincount(n, self.shard.copies[p], count).astype(np.int64)
            else:
                self.pairs.append(np.minimum(p, n) * count + np.maximum(p, n))

    def others(self, ids: np.ndarray, copies: np.ndarray, blocks: Iterator[tuple[np.ndarray, np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of queries of other shards: the queries that have some, a linked node of each, and their numbers of links."""
        links, one = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
        for q, n, _ in blocks:
            links += np.bincount(q, self.shard.copies[n], len(ids)).astype(np.int64)
            self.degree += np.bincount(n, copies[q], len(self.degree)).astype(np.int64)
            one[q] = n
            self._join(one[q], n)
        live = np.flatnonzero(one >= 0)
        return ids[live], self.shard.ids[one[live]], links[live]

    def rest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the forest's edges; nodes with links and their numbers."""
        count = len(self.degree)
        pairs = np.unique(np.concatenate(self.pairs)) if self.pairs else np.zeros(0, np.int64)
        u, v = pairs // max(1, count), pairs % max(1, count)
        sparse = ~self.whole[u] & ~self.whole[v]
        for a, b in ((u, v), (v, u)):
            self.degree += np.bincount(a[sparse], self.shard.copies[b[sparse]], count).astype(np.int64)
        self.degree += np.where(self.whole, 0, self.from_whole)
        below, live = np.flatnonzero(self.root != np.arange(count)), np.flatnonzero(self.degree)
        return self.shard.ids[below], self.shard.ids[self.root[below]], self.shard.ids[live], self.degree[live]


def _matrix(column) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


FOUND = "u long, v long, links long, audited long, recalled long"


def _found(u, v=None, links=None, audit: tuple[int, int] | None = None) -> pa.RecordBatch:
    """Rows of a forest's edges (u, v), of numbers of links (u, links), or of an audit."""
    n = 1 if audit else len(u)
    none = pa.nulls(n, pa.int64())
    cols = [none if x is None else pa.array(x, pa.int64()) for x in (u, v, links)]
    told = [pa.array([x], pa.int64()) for x in audit] if audit else [none, none]
    return pa.RecordBatch.from_arrays([*cols, *told], ["u", "v", "links", "audited", "recalled"])


def near_links(nodes: DataFrame) -> DataFrame:
    """What links the nodes (node, vector, copies) of each dimension ``dim`` have: rows (u, v) that join the same components,
    rows (u, links) to be added up by node, and a row (audited, recalled) for each audit."""
    total, widest = nodes.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    shards = max(1, -(-total // max(1, min(SHARD_NODES, SHARD_BYTES // (8 * widest)))))
    salts = max(3, -(-total // QUERY_NODES)) if shards < 64 else max(1, -(-total // QUERY_NODES))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))

    def build(t: pa.Table) -> pa.Table:
        made = Graph(t["node"].to_numpy(), _matrix(t["vector"].combine_chunks()), t["copies"].to_numpy())
        return pa.table({"shard": t["shard"].combine_chunks()[:1], "dim": t["dim"].combine_chunks()[:1], "graph": pa.array([pickle.dumps(made)], pa.binary())})

    # many partitions for few shards: builds are long, and two of them shouldn't wait for each other
    graphs = store.written(dealt.repartition(min(16 * shards, 1 << 14), "shard", "dim").groupBy("shard", "dim").applyInArrow(build, "shard int, dim int, graph binary"), "graphs")
    no = lambda kind: F.lit(None).cast(kind)
    spread = graphs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts)))).select("dim", "shard", "salt", F.lit(0).alias("kind"), no("long").alias("node"), no("array<double>").alias("vector"), no("long").alias("copies"), "graph")
    asked = dealt.select("dim", F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards // 2)), lambda k: ((F.col("shard") + k) % shards).cast("int"))).alias("shard"), "node", "vector", "copies", F.col("shard").alias("home"))
    asked = asked.where(~((F.lit(2) * F.pmod(F.col("shard") - F.col("home"), F.lit(shards)) == shards) & (F.col("home") * 2 >= shards)))  # of opposite shards one asks
    # a shard's own nodes, of bounded number, ask it in one stream (salt 0), so each of their links is known once
    salt = F.when(F.col("shard") == F.col("home"), 0).otherwise(1 + F.pmod(F.xxhash64("node", F.lit(7)), F.lit(salts))).cast("int")
    asked = asked.select("dim", "shard", salt.alias("salt"), F.lit(1).alias("kind"), "node", "vector", "copies", no("binary").alias("graph"))
    streams = spread.unionByName(asked).repartition(min(4 * shards * (salts + 1), 1 << 14), "dim", "shard", "salt").sortWithinPartitions("dim", "shard", "salt", "kind", F.xxhash64("node", F.lit(11)))

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, told, key = None, None, None

        def done() -> Iterator[pa.RecordBatch]:
            if audit is not None:
                audit.end()
                u, v, node, links = told.rest()
                yield _found(u, v)
                yield _found(node, links=links)
                if audit.true:
                    yield _found(None, audit=(audit.true, audit.found))

        for b in batches:
            keys = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            kind = b.column(3).to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1) | (kind[1:] != kind[:-1])]))
            for lo, hi in zip(cut, np.append(cut[1:], b.num_rows), strict=True):
                if kind[lo] == 0:
                    yield from done()
                    audit, key = Audit(pickle.loads(b.column(7)[int(lo)].as_py())), tuple(keys[lo])
                    told = Summary(audit.shard)
                    continue
                if audit is None or key != tuple(keys[lo]):
                    continue  # no node of this dimension in the shard
                for at in range(lo, hi, BLOCK):
                    part = b.slice(at, min(BLOCK, hi - at))
                    ids, raw, copies = part.column(4).to_numpy(), _matrix(part.column(5)), part.column(6).to_numpy()
                    if key[2] == 0:
                        told.own(ids, audit.blocks(ids, raw))
                    else:
                        u, v, links = told.others(ids, copies, audit.blocks(ids, raw))
                        yield _found(u, v, links)
        yield from done()

    return streams.mapInArrow(query, FOUND)


def near_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding), and audit_recall (the share of the links that the
    audits found again, planted ones among them; the same in all rows, null only where no vector can have links).

    Vectors that are null or zero, or hold null or non-finite components, link with nothing, nor do rows without a vec_id; vectors
    of different lengths don't link; equal vectors do; rows that share a vec_id are vectors of their own; other columns are
    ignored; an empty table gives no rows."""
    v = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    good = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    tagged = store.written(v.withColumn("vector", F.when(good, F.transform("vector", lambda x: x + F.lit(0.0)))), "vectors")
    equal = tagged.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("lowest"), F.count("*").alias("copies"))
    nodes = store.written(equal.withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("vector")}), "nodes")
    found = store.written(near_links(nodes.select("node", "vector", "copies", "dim")), "links")
    audited, recalled = found.agg(F.sum("audited"), F.sum("recalled")).first()
    degree = found.where("links is not null").groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "node")
    label = graph.components(found.where("v is not null").select("u", "v"))
    of = nodes.join(degree, "node", "left").join(label, "node", "left").select("vector", "lowest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    of = store.written(of, "nodes-linked")
    lowest = of.groupBy("component").agg(F.min("lowest").alias("component_id"))
    known = of.join(lowest, "component").select("vector", "n_links", "component_id")
    out = tagged.join(known, "vector", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    recall = F.lit(recalled / audited if audited else None).cast("double")
    return out.withColumns({"kept": F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)), "audit_recall": recall})


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``; for nulls, repeats and empty tables see ``near_vectors``."""
    return near_vectors(store.table(spark, sf_dir, "embeddings"))
