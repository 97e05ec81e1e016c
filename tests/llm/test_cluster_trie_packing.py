"""Centroid clustering, prefix trie and packing against plain versions, on nulls, ties, repeated rows, extra columns and empty tables."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockflow.llm import packing, prefixtrie, ptolemy, queries

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_conversation_prefix_trie"])
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("conversations", "embeddings"):
        c.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    got = queries.QUERIES[name](spark, D).toArrow()
    want = c.sql(queries.ORACLE_SQL[name]).to_arrow_table().select(got.column_names)
    key = lambda r: repr(list(r.values()))
    assert got.num_rows and sorted(got.to_pylist(), key=key) == sorted(want.to_pylist(), key=key)


# centroid clustering

def plain_clusters(rows, k=8, rounds=10):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == 64 and all(c is not None and math.isfinite(c) for c in x) and sum(c * c for c in x) < (1 << 20) ** 2:
            kept.append((vec_id, [math.floor(1024 * c) for c in x]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [q for _, q in first[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda q: min((far(q, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, q in kept:
            own[nearest(q)[1]].append(q)
        centroids = [[sum(col) // len(own[i]) for col in zip(*own[i], strict=True)] if own[i] else c for i, c in enumerate(centroids)]
    out = [(v, *nearest(q)) for v, q in kept]
    of = collections.Counter()
    for _, d, c in out:
        of[c] += d
    return sorted(((v, c, d, of[c], sum(of.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for v, d, c in out), key=repr)


def vectors(n, seed, spread=0.3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, 64))
    return [(i, (centres[i % 5] + spread * r.normal(size=64)).tolist()) for i in range(n)]


VECTORS = [
    *vectors(120, 1), (500, None), (501, []), (502, [0.5] * 63), (503, [0.5] * 63 + [None]), (504, [float("nan")] + [0.1] * 63), (505, [float("inf")] * 64), (506, [-0.0] * 64), (507, [0.0] * 64), (508, [1e30] * 64), (509, [900_000.0] + [0.0] * 63),
    (None, [0.25] * 64), (510, [0.125] * 64), (510, [0.125] * 64), (510, [-0.125] * 64), (511, [-0.0001] * 64),
]


@pytest.mark.parametrize("rows", [VECTORS, VECTORS[:3], [(1, [0.5] * 64)] * 30, [(i, [float(i % 3)] + [0.0] * 63) for i in range(40)], vectors(300, 7, 3.0)], ids=["mixed", "few", "equal", "ties", "spread"])
def test_clusters_equal_plain_version(spark, rows):
    df = spark.createDataFrame([(v, x, 1, "c") for v, x in rows], "vec_id long, embedding array<double>, cluster int, vector string").repartition(3)
    got = ptolemy.cluster(ptolemy.whole_numbers(df)).drop("compared").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_clusters(rows)


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    out = ptolemy.cluster(ptolemy.whole_numbers(df))
    assert out.count() == 0 and out.columns[:3] == ["vec_id", "cluster", "distance"]


def test_bounds_hold_and_spare_comparisons():
    rows = np.array([[math.floor(1024 * c) for c in x] for _, x in vectors(400, 3)], np.int64)
    pivots = ptolemy.Pivots(rows[:8])
    centroids = np.concatenate([rows[:6], rows[20:22] + 3])
    below = pivots.below(pivots.distances(rows), centroids)
    exact = np.stack([ptolemy.squared(rows, c) for c in centroids], axis=1)
    assert (below <= exact).all()
    nearest, distance, compared = ptolemy.assign(rows, pivots.distances(rows), pivots, centroids)
    assert (nearest == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert compared.mean() < 0.7 * len(centroids)


def test_bounds_hold_for_large_and_close_vectors():
    r = np.random.default_rng(5)
    rows = r.integers(-(1 << 26), 1 << 26, (300, 64)) + np.repeat(r.integers(0, 2, (300, 1)), 64, axis=1)
    rows = np.concatenate([rows, rows + 1])
    pivots, centroids = ptolemy.Pivots(rows[:8]), np.concatenate([rows[10:14], rows[10:14] + 1])
    assert (pivots.below(pivots.distances(rows), centroids) <= np.stack([ptolemy.squared(rows, c) for c in centroids], axis=1).astype(float)).all()
    near, d, _ = ptolemy.assign(rows, pivots.distances(rows), pivots, centroids)
    exact = np.stack([ptolemy.squared(rows, c) for c in centroids], axis=1)
    assert (d == exact.min(axis=1)).all() and (near == exact.argmin(axis=1)).all()


# prefix trie

def plain_trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1].encode()) if node else 0
    ends = {n: ",".join(str(c) for c in m if rebuilt[c] == n) for n, m in members.items()}
    return sorted(((m[0], len(n), members[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends[n].encode()).hexdigest()) for n, m in members.items()), key=repr)


def talk(seed, convs=60, most=14):
    r, rows = random.Random(seed), []
    for c in range(convs):
        if c % 11 == 5:
            continue  # some bases are absent
        for t in range(r.randrange(most)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", r.choice(["yes", "no", "maybé so", "go on " * (c % 3)])))
    return rows


ODD = [
    (None, 1, "user", "no conversation"), (1, None, "user", "first"), (1, 1, None, None), (1, 1, "", ""), (2, 1, "user", "twice"), (2, 1, "user", "twice"), (2, 2, "ab", "c"), (3, 2, "a", "bc"), (3, 2, "a", "b"), (-3, 0, "user", "below zero"), (-5, 0, "user", "base below"),
    (7, 3, "user", "x" * 200_000), (8, 3, "user", "x" * 200_000), (8, 4, "user", None), (40, 0, "user", "alone"), (43, 0, "user", "of an absent base? no, of 40"), (99, 1, "user", "short and its base is absent"),
]


@pytest.mark.parametrize("rows", [ODD, talk(1) + ODD, talk(2, 200, 6), talk(3, 12, 60), [(c, t, "user", "the same") for c in range(300) for t in range(5)]], ids=["odd", "mixed", "many", "long", "copies"])
def test_trie_equals_plain_version(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, s0 string").repartition(3)
    got = prefixtrie.trie(df).drop("turn_conv", "turn_at").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_trie(rows)


def test_one_conversation_over_many_parts_and_stretches(spark, monkeypatch):
    """One conversation has most of the rows; its turns, path and list of ends are dealt to many groups."""
    monkeypatch.setattr(prefixtrie, "STRETCH", 50)
    monkeypatch.setattr(prefixtrie, "CHUNK", 20)
    rows = talk(4, 30) + [(4, t, "user", f"turn {t % 3}") for t in range(100, 700)] + [(c, 0, "user", "turn 0") for c in range(1000, 1100)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    made = prefixtrie.stretches(prefixtrie.turns_of(df, 1), 1)
    assert made.where("conv_id = 4").select("part").distinct().count() >= 3
    assert sorted((tuple(r) for r in prefixtrie.trie(df).drop("turn_conv", "turn_at").collect()), key=repr) == plain_trie(rows)


def test_trie_is_made_anew_when_turn_hashes_meet(spark, monkeypatch):
    honest = prefixtrie.turns_of
    asked = []

    def poor(conversations, seed):
        asked.append(seed)
        t = honest(conversations, seed)
        return t.withColumns({x: F.lit(7).cast("long") for x in prefixtrie.T}) if seed == 1 else t

    monkeypatch.setattr(prefixtrie, "turns_of", poor)
    rows = talk(5)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((tuple(r) for r in prefixtrie.trie(df).drop("turn_conv", "turn_at").collect()), key=repr) == plain_trie(rows)
    assert asked == [1, 2]


def test_trie_is_made_anew_when_prefixes_meet(spark, monkeypatch):
    """A base of 1 makes fingerprints that don't see order; the nodes' last turns tell."""
    honest = prefixtrie.bases
    monkeypatch.setattr(prefixtrie, "bases", lambda seed: np.ones(prefixtrie.LANES, np.int64) if seed == 1 else honest(seed))
    rows = [(0, 0, "user", "a"), (0, 1, "user", "b"), (100, 0, "user", "b"), (100, 1, "user", "a"), (100, 2, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((tuple(r) for r in prefixtrie.trie(df).drop("turn_conv", "turn_at").collect()), key=repr) == plain_trie(rows)


def test_nodes_tell_where_their_last_turn_is_stored(spark):
    rows = talk(6)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    stored = {}
    for c, t, _, text in sorted(rows):
        stored[c, t + 1] = text
    got = prefixtrie.trie(df).where("depth > 0").collect()
    assert got and all((r.turn_conv, r.turn_at) in stored for r in got)
    assert all(r.turn_conv is None for r in prefixtrie.trie(df).where("depth = 0").collect())


def test_trie_of_nothing(spark):
    assert prefixtrie.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert prefixtrie.trie(spark.createDataFrame([(None, 1, "user", "a")], "conv_id long, turn long, role string, text string")).count() == 0


# packing

TEXTS = [
    None, "", " ", "\t\n", "Hello, World!", "don't we'LL they've I'd it's 'tis rock'n'roll", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> c<|endoftext|> d", "ÉCOLE déjà vu Straße İstanbul ŉ ΣΑΣ Σ", "é combining ´ ̈x ＡＢＣ ﬁ ① ½",
    "日本語のテキスト 你好世界 한국어", "1234 56,78 9.0%", "🙂🙂 emoji👩‍👩‍👧 end", "no break em　ideographic\u0085next\x0bvt\x0cff\x1cfs", "_under_score__ a_b -- ... !!! ?!", "x" * 5000, "word " * 9000, "а́б Ж", "it''s ''s '' 'S", "ǅ ǆ Ǆ ª º µ ſ K Å", "a\x00b ﻿c", "tail‍ ́ end",
]


@pytest.fixture(scope="module")
def word_bpe():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_word_encoder_equals_the_library(word_bpe, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing.WordEncoder, "KEEP", 300)  # memories are cleared on the way
    enc = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert enc.words_apart
    r = random.Random(3)
    pool = [w for t in TEXTS if t and len(t) < 300 for w in t.split(" ")] + ["".join(r.choice("abcdefABCé'.,-0") for _ in range(r.randrange(1, 12))) for _ in range(600)]
    texts = [t or "" for t in TEXTS] + [" ".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(400)]
    for lo in range(0, len(texts), 70):
        part = texts[lo : lo + 70]
        ids, ends = enc.encode(pa.array(part))
        for t, a, b in zip(part, [0, *ends[:-1]], ends, strict=True):
            assert ids[a:b].tolist() == word_bpe.encode(t, add_special_tokens=False).ids, t


def test_other_pipelines_are_encoded_whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, tok = packing.WordEncoder(path), Tokenizer.from_file(path)
    texts = [t or "" for t in TEXTS]
    ids, ends = enc.encode(pa.array(texts))
    assert not enc.words_apart and ids.tolist() == [i for t in texts for i in tok.encode(t, add_special_tokens=False).ids] and len(ends) == len(texts)


def plain_place(lengths, capacity):
    """Every open sequence is tried, and the whole sum is taken anew."""
    made, fills = [], -(-sum(lengths) // capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        gaps = [capacity - sum(lengths[j] for j in s) for s in made]
        fit = [x for x, g in enumerate(gaps) if g >= lengths[i]]

        def total(to):
            after = [g - lengths[i] * (x == to) for x, g in enumerate(gaps)] + ([capacity - lengths[i]] if to == len(made) else [])
            return sum(n * n for g, n in collections.Counter(after).items() if g)

        choices = fit + ([len(made)] if not fit or len(made) < fills else [])
        best = min(choices, key=lambda to: (total(to), gaps[to] if to < len(made) else capacity))
        if best == len(made):
            made.append([])
        made[best].append(i)
    return made


@pytest.mark.parametrize("seed", range(6))
def test_place_has_the_smallest_sums_of_squares(seed):
    r = random.Random(seed)
    lengths = [r.choice([r.randrange(1, 41), 40, 13, 1]) for _ in range(r.randrange(1, 80))]
    got, want = packing.place(np.array(lengths), 40), plain_place(lengths, 40)
    sizes = lambda made: sorted(sorted(lengths[i] for i in s) for s in made)
    assert sorted(i for s in got for i in s) == list(range(len(lengths)))
    assert len(got) == len(want) and sorted(sum(x) for x in sizes(got)) == sorted(sum(x) for x in sizes(want))
    assert all(sum(s) <= 40 for s in sizes(got))


def check_packing(rows, docs, word_bpe):
    """Pieces are the documents' ids in order, sequences are filled without gaps; returns sequences and tokens."""
    want = []
    for doc_id, text in docs:
        ids = [*word_bpe.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(doc_id, p, lo, len(ids[lo : lo + 2048]), zlib.crc32(np.array(ids[lo : lo + 2048], np.uint32).tobytes())) for p, lo in enumerate(range(0, len(ids), 2048))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by), sum(w[3] for w in want)


def test_pieces_and_sequences(spark, word_bpe):
    docs = [(None if i == 3 else i // 2, t) for i, t in enumerate([*TEXTS, *TEXTS[4:9], *TEXTS[4:9]])]
    df = spark.createDataFrame([(d, t, 1, b"", "s") for d, t in docs], "doc_id long, text string, piece int, ids binary, sequence_id string").repartition(4)
    n, tokens = check_packing(packing.piece_rows(packing.pack(df)).collect(), docs, word_bpe)
    assert n == -(-tokens // 2048)


def test_few_sequences_over_levels(spark, word_bpe, monkeypatch):
    """Small groups: what doesn't fill a sequence goes on to the next levels."""
    monkeypatch.setattr(packing, "GROUP_PIECES", 60)
    r = random.Random(9)
    docs = [(i, "lorem ipsum " * r.choice([3, 40, r.randrange(1, 300), 300, 700])) for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    n, tokens = check_packing(packing.piece_rows(packing.pack(df)).collect(), docs, word_bpe)
    assert n <= 1.03 * tokens / 2048


def test_pieces_that_never_fill_end(spark, word_bpe):
    """Equal documents of more than half a sequence: one sequence each, and the levels stop."""
    docs = [(i, "one " * 1200) for i in range(300)]
    n, _ = check_packing(packing.piece_rows(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"))).collect(), docs, word_bpe)
    assert n == 300


def test_packing_of_nothing(spark):
    out = packing.piece_rows(packing.pack(spark.createDataFrame([], "doc_id long, text string")))
    assert out.count() == 0 and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_packing_query(spark, word_bpe):
    docs = [tuple(r) for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect()]
    n, tokens = check_packing(queries.QUERIES["op13_sum_of_squares_packing"](spark, D).collect(), docs, word_bpe)
    assert n <= -(-tokens // 2048) + 2
