"""Operator 12: the prefix trie of rebuilt conversations, by composable fingerprints.

A run of turns is an element of a monoid: its length n and, in each of four lanes, the sum of turn hash times base to the power of its place,
modulo a prime.  Two runs compose as (n1, s1) (n2, s2) = (n1 + n2, s1 + base^n1 s2), and a head can be taken off again.  A rebuilt
conversation is the first turns of a base conversation and the rest of its own, so each of its prefixes is the base's head composed with a stretch of
its own turns: no text is rebuilt, a row of the table of paths holds a fingerprint and the place (conversation, turn number) of its last turn.

Prefixes of one depth and fingerprint are a node.  That they are equal is verified: in each node all last turns have one turn fingerprint, which
with the same prefix fingerprint means one parent, and so on to the root; and each turn fingerprint stands for one stored role and text.
If either fails the trie is made anew with other hashes.

Subtrees are summed without walking them.  The smallest member of a node owns it; a conversation owns a stretch of its path, down to its end.  What a
subtree holds is what its members own in all, less what the owner of its top owns above it.

A conversation of any length is dealt to many tasks: turns are range-partitioned in their order, each task composes its stretch, and
stretches are composed from one row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernel as K
from . import store

PRIME = (1 << 31) - 1
LANES = 4
#: A rebuilt conversation c has the first crc32(c) % HEADS turns of conversation c - c % FAMILY.
HEADS, FAMILY = 9, 5
#: Hashes that are tried before giving up.
TRIES = 5
#: Characters of a text that the range of its row depends on.
TIE_CHARS = 32
#: Depths that one group of a running sum along a path holds.
STRETCH = 4096
#: Bytes of joined ids in a row.
CHUNK = 1 << 16

S, P, T = ([f"{x}{i}" for i in range(LANES)] for x in "spt")
NODE = ["depth", *S]


def bases(seed: int) -> np.ndarray:
    return (K.mix(np.arange(1, LANES + 1, dtype=K.U64) * K.U64(0x9E3779B97F4A7C15) + K.U64(seed)) % K.U64(PRIME - 1024)).astype(np.int64) + 512


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo the prime."""
    out, square, left = np.ones(len(exponents), np.int64), int(base), exponents.astype(np.int64)
    while left.any():
        out = np.where(left & 1, out * square % PRIME, out)
        square, left = square * square % PRIME, left >> 1
    return out


def with_powers(df: DataFrame, exponent: str, seed: int) -> DataFrame:
    """p0 .. p3: each lane's base to the power of a column."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = b.column(names.index(exponent)).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(power(x, e)) for x in bases(seed))], [*names, *P])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + "".join(f", {p} long" for p in P))


def turns_of(conversations: DataFrame, seed: int) -> DataFrame:
    """conv_id, turn, role, text, bytes and the turn's hashes t0 .. t3; rows without a conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    hashed = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", role, text).withColumns({"a": F.xxhash64(F.lit(2 * seed), "role", "text"), "b": F.xxhash64(F.lit(2 * seed + 1), "role", "text")})
    halves = [F.col(x).bitwiseAND(0xFFFFFFFF) if half else F.shiftrightunsigned(x, 32) for x in "ab" for half in (0, 1)]
    return hashed.withColumns({"bytes": F.octet_length("text").cast("long")} | {t: h % PRIME for t, h in zip(T, halves, strict=True)}).drop("a", "b")


def texts_apart(turns: DataFrame) -> bool:
    """Whether each turn hash stands for one role and text."""
    each = F.struct("role", "text")
    return turns.groupBy(*T).agg(F.min(each).alias("low"), F.max(each).alias("high")).where("low <> high").isEmpty()


def stretches(turns: DataFrame, seed: int) -> DataFrame:
    """Turns in order, written: part, conv_id, k (from 1 within the part), bytes, t0 .. t3, and s0 .. s3: the fingerprint of the part's first k turns.

    Turns stand in order of turn (null first), then role, then text."""
    parts = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), turns.rdd.getNumPartitions())
    ordered = turns.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, TIE_CHARS)).sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "bytes", *T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, base = TaskContext.get().partitionId(), bases(seed)
        conv, k, sums = None, 0, [0] * LANES  # of the last row
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            new = np.concatenate([[conv is None or ids[0] != conv], ids[1:] != ids[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
            goes_on = ids == conv if conv is not None and not new[0] else np.zeros(len(ids), bool)
            at = np.arange(len(ids)) - first + 1 + np.where(goes_on, k, 0)
            cols = []
            for lane in range(LANES):
                total = np.concatenate([[0], np.cumsum(b.column(2 + lane).to_numpy() * power(base[lane], at - 1) % PRIME)])
                cols.append((total[1:] - total[first] + np.where(goes_on, sums[lane], 0)) % PRIME)
            conv, k, sums = int(ids[-1]), int(at[-1]), [int(c[-1]) for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), part, np.int32)), b.column(0), pa.array(at), *b.columns[1:], *(pa.array(c) for c in cols)], ["part", "conv_id", "k", "bytes", *T, *S])

    return store.written(ordered.mapInArrow(run, "part int, conv_id long, k long, bytes long" + "".join(f", {x} long" for x in T + S)), "stretches")


def offsets(made: DataFrame, seed: int) -> DataFrame:
    """For each part of a conversation: n, the turns before it (off), their fingerprint (o0 .. o3) and base ** off (p0 .. p3). Written."""
    last = made.groupBy("part", "conv_id").agg(F.max(F.struct("k", *S)).alias("x")).select("part", "conv_id", F.col("x.k").alias("n"), *(f"x.{s}" for s in S))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = with_powers(last.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0))), "off", seed)
    return store.written(placed.withColumns({f"o{i}": F.coalesce(F.sum((F.col(S[i]) * F.col(P[i])) % PRIME).over(before), F.lit(0)) % PRIME for i in range(LANES)}).drop(*S), "offsets")


def _prefix(i: int) -> Column:
    """Lane i of a conversation's first off + k turns."""
    return (F.col(f"o{i}") + F.col(P[i]) * F.col(S[i])) % PRIME


def paths(conversations: DataFrame, turns: DataFrame, seed: int) -> DataFrame:
    """One row for every prefix of every rebuilt conversation, written: conv_id, depth, s0 .. s3, of the last turn t0 .. t3, bytes and its place
    (turn_conv, turn_at), and is_end: whether the conversation ends there."""
    made = stretches(turns, seed)
    off = offsets(made, seed)
    heads = made.where(F.col("k") < HEADS).join(off, ["part", "conv_id"]).withColumn("i", F.col("off") + F.col("k")).where(F.col("i") < HEADS)
    heads = store.written(heads.select("conv_id", "i", "bytes", *T, *(_prefix(i).alias(S[i]) for i in range(LANES))), "heads")
    length = off.groupBy("conv_id").agg(F.sum("n").alias("len"))
    convs = length.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS, "base": F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))})
    convs = convs.join(length.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len")), "base", "left")
    convs = convs.withColumns({"cut": F.least("h", "len"), "m": F.least("h", F.coalesce("base_len", F.lit(0)))})
    own = heads.select("conv_id", F.col("i").alias("cut"), *(F.col(S[i]).alias(f"c{i}") for i in range(LANES)))
    head = heads.select(F.col("conv_id").alias("base"), F.col("i").alias("m"), *(F.col(S[i]).alias(f"m{i}") for i in range(LANES)))
    lanes = [f"{x}{i}" for x in "cm" for i in range(LANES)]
    convs = store.written(convs.join(own, ["conv_id", "cut"], "left").join(head, ["base", "m"], "left").fillna(0, lanes).withColumn("size", F.col("m") + F.col("len") - F.col("cut")), "rebuilt")

    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(x) for x in S + T), F.lit(0).cast("long").alias("bytes"), F.lit(None).cast("long").alias("turn_conv"), F.lit(None).cast("long").alias("turn_at"), (F.col("size") == 0).alias("is_end"))
    shared = convs.select("conv_id", "base", "m", "size").join(heads.withColumnRenamed("conv_id", "base"), "base").where(F.col("i") <= F.col("m"))
    shared = shared.select("conv_id", F.col("i").alias("depth"), *S, *T, "bytes", F.col("base").alias("turn_conv"), F.col("i").alias("turn_at"), (F.col("size") == F.col("i")).alias("is_end"))
    # B ** (m - h): what moves a conversation's own place h to its place m
    back = [[pow(int(b), -j, PRIME) for j in range(HEADS)] for b in bases(seed)]
    moved = off.join(convs.select("conv_id", "cut", "m", "size", *lanes, F.greatest(F.col("cut") - F.col("m"), F.lit(0)).alias("down"), F.greatest(F.col("m") - F.col("cut"), F.lit(0)).alias("up")), "conv_id")
    forth = [[pow(int(b), j, PRIME) for j in range(HEADS)] for b in bases(seed)]
    of = lambda told, at: F.element_at(F.array(*map(F.lit, told)), (F.col(at) + 1).cast("int")).cast("long")
    moved = moved.withColumns({f"b{i}": of(back[i], "down") * of(forth[i], "up") % PRIME for i in range(LANES)})
    rest = made.join(moved, ["part", "conv_id"]).withColumn("at", F.col("off") + F.col("k")).where(F.col("at") > F.col("cut")).withColumn("depth", F.col("at") - F.col("cut") + F.col("m"))
    rest = rest.select("conv_id", "depth", *((F.col(f"m{i}") + F.col(f"b{i}") * F.pmod(_prefix(i) - F.col(f"c{i}"), F.lit(PRIME))) % PRIME for i in range(LANES)), *T, "bytes", F.col("conv_id").alias("turn_conv"), F.col("at").alias("turn_at"), (F.col("size") == F.col("depth")).alias("is_end"))
    return store.written(root.union(shared).union(rest), "paths")


def ends_of(ended: DataFrame) -> DataFrame:
    """depth, s0 .. s3 and ends_sha256 of the nodes where conversations end. Ids are joined in ranges first, then a node's few long rows are
    digested in order."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size = None, [], 0
        names = [*NODE, "first", "ids"]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in key), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names)

        for b in batches:
            for *node, conv in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key is not None and (node != key or size >= CHUNK):
                    yield row()
                    ids, size = [], 0
                key = node
                ids.append(conv)
                size += len(str(conv)) + 1
        if key is not None:
            yield row()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        out = lambda: pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in list(zip(*done, strict=True))[:-1]), pa.array([d[-1] for d in done])], [*NODE, "ends_sha256"])
        for b in batches:
            for *node, _, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if node == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append([*key, state.hexdigest()])
                key, state = node, hashlib.sha256(ids.encode())
            if done:
                yield out()
                done = []
        if key is not None:
            done.append([*key, state.hexdigest()])
            yield out()

    columns = ", ".join(f"{n} long" for n in NODE)
    parts = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ended.select(*NODE, "conv_id").repartitionByRange(parts, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(joined, f"{columns}, first long, ids string")
    return chunks.repartition(parts, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digested, f"{columns}, ends_sha256 string")


def _parents(nodes: DataFrame, seed: int) -> DataFrame:
    """Nodes with the fingerprint q0 .. q3 of their parent: the last turn is taken off."""
    told = with_powers(nodes.withColumn("above", F.greatest(F.col("depth") - 1, F.lit(0))), "above", seed)
    return told.withColumns({f"q{i}": F.pmod(F.col(S[i]) - F.col(P[i]) * F.col(T[i]) % PRIME, F.lit(PRIME)) for i in range(LANES)}).drop(*P)


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and turn_conv and turn_at: where
    the node's last turn is stored (conversation, and number from 1 in its order; the smallest such place).

    Turns stand in order of turn (null first), then role, then text; null roles and texts are empty; repeated rows are turns; rows without a conv_id are left
    out; negative ids have the base below them; other columns are ignored; an empty table gives no rows (there is no member to name a root by)."""
    for seed in range(1, TRIES + 1):
        turns = turns_of(conversations, seed)
        if not texts_apart(turns):
            continue
        way = paths(conversations, turns, seed)
        last = F.struct(*T)
        nodes = way.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.min(last).alias("low"), F.max(last).alias("high"), F.min(F.struct("turn_conv", "turn_at")).alias("turn"))
        nodes = store.written(nodes.withColumn("same", F.col("low") == F.col("high")).select(*NODE, "conv_id", "n_convs", "bytes", "same", *(F.col(f"low.{t}").alias(t) for t in T), "turn.turn_conv", "turn.turn_at"), "nodes")
        if nodes.where("not same").isEmpty():
            return _summed(way, nodes, seed)
    raise RuntimeError(f"fingerprints of different turns met with each of {TRIES} hashes")


def _summed(way: DataFrame, nodes: DataFrame, seed: int) -> DataFrame:
    nodes = _parents(nodes, seed)
    own = [*NODE, "conv_id", "n_convs", "bytes", "turn_conv", "turn_at", *(f"q{i}" for i in range(LANES))]
    child = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), *(F.col(f"q{i}").alias(S[i]) for i in range(LANES)), F.lit(1).cast("long").alias("n_children"))
    counted = nodes.select(*own).unionByName(child, allowMissingColumns=True).groupBy(*NODE).agg(*(F.max(c).alias(c) for c in own if c not in NODE), F.coalesce(F.sum("n_children"), F.lit(0)).alias("n_children"))
    # a running sum along what a conversation owns: within stretches of depths, and over the stretches before
    counted = store.written(counted.withColumns({"weight": (F.col("n_convs") - 1) * F.col("bytes"), "stretch": F.floor(F.col("depth") / STRETCH)}), "counted")
    chain = counted.groupBy("conv_id", "stretch").agg(F.sum("weight").alias("total"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    chain = store.written(chain.withColumn("earlier", F.coalesce(F.sum("total").over(Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "owned")
    inside = F.coalesce(F.sum("weight").over(Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counted.withColumn("inside", inside).join(chain.select("conv_id", "stretch", "earlier"), ["conv_id", "stretch"]).withColumn("above", F.col("inside") + F.col("earlier"))
    owners = chain.groupBy("conv_id").agg(F.sum("total").alias("held"), F.sum("leaves").alias("n_leaves")).where("held <> 0 or n_leaves <> 0")
    below = way.select("conv_id", *NODE).join(store.checked(owners, "owners"), "conv_id").groupBy(*NODE).agg(F.sum("held").alias("held"), F.sum("n_leaves").alias("n_leaves"))
    ends = ends_of(way.where("is_end"))
    facts = [c for c in placed.columns if c not in (*NODE, "inside", "earlier", "stretch", "weight", "bytes")]
    every = placed.select(*NODE, *facts).unionByName(below, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
    done = every.groupBy(*NODE).agg(*(F.max(c).alias(c) for c in [*facts, "held", "n_leaves", "ends_sha256"]))
    done = store.written(done, "trie")
    parent = done.select((F.col("depth") + 1).alias("depth"), *(F.col(S[i]).alias(f"q{i}") for i in range(LANES)), F.col("conv_id").alias("parent_conv_id"))
    return done.join(parent, ["depth", *(f"q{i}" for i in range(LANES))], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", (F.col("held") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "turn_conv", "turn_at")


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations; for nulls, ties, repeats and empty tables see ``trie``."""
    return trie(store.table(spark, sf_dir, "conversations")).drop("turn_conv", "turn_at")


#: Prefixes are named by a digest chained over their turns; crc32 is worked out bit by bit.
ORACLE = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base,
    xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [1::UBIGINT, 1, 1, 1, 1, 1, 1, 1]), lambda u, v: xor(u >> 1, 3988292384::UBIGINT * (u & v))))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, t.i AS place, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
), o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, strlen(text) AS bytes, sha256(role || chr(1) || strlen(role) || chr(1) || text) AS name FROM r
), p AS (
  SELECT conv_id, depth, bytes, sha256(string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
    CASE WHEN depth = 1 THEN '' ELSE sha256(string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) END AS parent FROM o
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c
), e AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM p
), n AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end) AS ends FROM e GROUP BY depth, node
), k AS (
  SELECT n.*, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.parent = n.node) AS n_children FROM n
), u AS (
  SELECT a.depth, a.node, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves, sum((k.n_convs - 1) * k.bytes) AS saved
  FROM e a JOIN e b ON b.conv_id = a.conv_id AND b.depth >= a.depth JOIN k ON k.depth = b.depth AND k.node = b.node AND k.conv_id = b.conv_id GROUP BY a.depth, a.node
)
SELECT k.conv_id, k.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, k.n_convs, k.n_children, u.n_leaves, u.saved::BIGINT AS saved_tokens, sha256(coalesce(k.ends, '')) AS ends_sha256
FROM k JOIN u USING (depth, node) LEFT JOIN n q ON q.depth = k.depth - 1 AND q.node = k.parent
"""
