"""Operator 3: benchmark decontamination by template windows.

A text becomes a template: numbers, names and units of measure are typed placeholders, other words are lower-cased.
Windows of ``WINDOW`` template tokens are hashed and joined with the windows of the benchmark items.  A window also carries the
values of its slots: over all windows that a document shares with an item, or those of one occurrence of it, the values must be one
to one, as they are in a re-parameterised question, or the windows equal as they stand.  A capital at the start of a sentence may be a name or not, so
templates have three forms: without names, with names inside sentences, and with all capitals as names.  Texts are hashed with array operations; a bitmap of fixed size,
filled from the benchmark, leaves out windows that cannot join, and the join itself is an ordinary equi-join on the hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from . import store

WINDOW = 8
#: Plain words that a template window must hold (a window with fewer is compared as it stands), and windows of an item that a document must share (or all of a shorter item).
PLAIN = 4
SHARED = 3
BITMAP_BITS = 22

#: Units of measure that become a placeholder.
UNITS = "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg lb lbs pound pounds ounce ounces oz ton tons ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours day days week weeks month months year years dollar dollars usd euro euros cent cents percent degree degrees celsius fahrenheit mph kph watt watts volt volts joule joules newton newtons hz khz mhz gb mb kb".split()

_KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 letters, 2 symbols, 3 digits
_KIND[K.IS_SPACE] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 3
_NUM, _NAME, _UNIT = (K.U64(K.fnv(f"\x00{x}")) for x in ("number", "name", "unit"))
_BARE = K.U64(K.fnv("\x00bare"))
_UNIT_HASHES = np.sort(np.array([K.fnv(u) for u in UNITS], np.uint64))
_STOP = np.zeros(256, bool)
_STOP[[*b".!?:;\n\r\"|*#>-("]] = True


#: Forms of a template: which words are names.
NO_NAMES, INNER_NAMES, ALL_CAPITALS = range(3)


def template(data: np.ndarray, offsets: np.ndarray, form: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template hash, slot value (0 outside slots) and row of every token of a batch. A row's tokens depend on nothing outside of it."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = _KIND[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    cut = np.flatnonzero(change)
    starts, ends = cut[:-1], cut[1:]
    keep = (kind[starts] == 1) | (kind[starts] == 3)
    starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = np.searchsorted(offsets, starts, "right") - 1
    raw = K.range_hashes(K.LOWER[data], starts, ends)
    number = kind[starts] == 3
    at = np.minimum(np.searchsorted(_UNIT_HASHES, raw), len(_UNIT_HASHES) - 1)
    near = np.zeros(len(raw), bool)
    near[1:] = number[:-1] & (rows[1:] == rows[:-1])
    unit = (_UNIT_HASHES[at] == raw) & near
    name = np.zeros(len(raw), bool)
    if form != NO_NAMES:
        nxt = np.minimum(starts + 1, len(data) - 1)
        upper = ((data[starts] >= 65) & (data[starts] <= 90) & (ends - starts > 1) & (data[nxt] >= 97)) | ((data[starts] == 0xC3) & (data[nxt] >= 0x80) & (data[nxt] <= 0x9E))
        # a capital right after a stop (white space aside), or at the start of a text, may be no name
        solid = np.maximum.accumulate(np.where(kind > 0, np.arange(len(data)), -1))
        before = np.where(starts > offsets[rows], solid[starts - 1], -1)
        broke = np.cumsum(data == 10)
        newline = broke[np.maximum(starts - 1, 0)] > broke[np.maximum(before, 0)]
        opening = (before < offsets[rows]) | _STOP[data[np.maximum(before, 0)]] | newline
        name = upper & (kind[starts] == 1)
        if form == INNER_NAMES:
            name &= ~opening
    gap = np.zeros(len(raw), np.int64)
    gap[1:] = starts[1:] - ends[:-1]
    same = np.zeros(len(raw), bool)
    same[1:] = rows[1:] == rows[:-1]
    point = np.zeros(len(raw), bool)
    point[1:] = (gap[1:] == 1) & ((data[starts[1:] - 1] == 46) | (data[starts[1:] - 1] == 44))
    run = np.zeros(len(raw), bool)  # goes on with the slot of the token before: 3.14, 1,000, Ada King
    run[1:] = same[1:] & ((number[1:] & number[:-1] & point[1:]) | (name[1:] & name[:-1]))
    hashes = np.where(number, _NUM, np.where(unit, _UNIT, np.where(name, _NAME, raw)))
    slot = np.where(number | unit | name, raw | K.U64(1), K.U64(0))
    lead = np.flatnonzero(~run)
    value = np.add.reduceat(np.where(run, K.mix(slot), slot), lead) | K.U64(1)
    return hashes[lead], np.where(slot[lead] > 0, value, K.U64(0)), rows[lead]


def windows(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...], whole: bool, form: int, bitmap: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Hash, literal hash, row, place in the row (in template tokens), size, whether it is bare, and slot values of every window that
    ``bitmap`` lets through. A bare window has too few plain words for a template and is hashed as it stands. ``lengths``: besides
    WINDOW, shorter ones; ``whole``: a shorter length only for rows of exactly that many tokens."""
    h, slot, rows = template(data, offsets, form)
    per = np.bincount(rows, minlength=len(offsets) - 1) if len(rows) else np.zeros(len(offsets) - 1, np.int64)
    begin = np.cumsum(per) - per
    free = np.concatenate([[0], np.cumsum(slot == 0)])
    steps = np.array(K._STEP[8 : 8 + WINDOW], np.uint64)
    out = []
    for k in sorted({WINDOW, *lengths}):
        n = len(h) - k + 1
        if n <= 0:
            continue
        ok = rows[:n] == rows[k - 1 :]
        if whole and k < WINDOW:
            ok &= per[rows[:n]] == k
        bare = free[k:] - free[:n] < min(PLAIN, k)
        sums = np.full(n, K.U64(k))
        for j in range(k):
            sums += h[j : n + j] * K._STEP[j]
        few = np.flatnonzero(ok & bare)
        inside = few[:, None] + np.arange(k)
        sums[few] = K.mix(((h[inside] ^ slot[inside]) * steps[:k]).sum(axis=1, dtype=np.uint64) + K.U64(k)) ^ _BARE
        at = np.flatnonzero(ok)
        key = K.mix(sums[at])
        if bitmap is not None:
            spot = key >> K.U64(64 - BITMAP_BITS)
            hit = (bitmap[(spot >> K.U64(3)).astype(np.int64)] >> (spot & K.U64(7)).astype(np.uint8)) & 1 > 0
            at, key = at[hit], key[hit]
        inside = at[:, None] + np.arange(k)
        held = np.zeros((len(at), WINDOW), np.uint64)
        held[:, :k] = slot[inside]
        literal = K.mix(((h[inside] ^ held[:, :k]) * steps[:k]).sum(axis=1, dtype=np.uint64) + K.U64(k))
        out.append((key, literal, rows[at], at - begin[rows[at]], np.full(len(at), k, np.int32), bare[at], held))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (*(np.zeros(0, np.uint64),) * 2, *(np.zeros(0, np.int64),) * 2, np.zeros(0, np.int32), np.zeros(0, bool), np.zeros((0, WINDOW), np.uint64))


def _template_windows(df: DataFrame, key: str, lengths: tuple[int, ...], whole: bool, bitmap: np.ndarray | None) -> DataFrame:
    """Windows of every row in each ``form``; ``source`` tells the texts of one key apart."""
    held = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(2))
            for lo, hi in K.slices(offsets):
                part, off = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                for form in (NO_NAMES, INNER_NAMES, ALL_CAPITALS):
                    h, literal, row, at, size, bare, slots = windows(part, off, lengths, whole, form, held.value)
                    if len(h):
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(h) * WINDOW + 1, WINDOW), pa.int32()), pa.array(slots.ravel().view(np.int64)))
                        of = pa.array(lo + row)
                        cols = [b.column(0).take(of), b.column(1).take(of), pa.array(np.full(len(h), form, np.int32)), pa.array(h.view(np.int64)), pa.array(literal.view(np.int64)), pa.array(at), pa.array(size), pa.array(bare), lists]
                        yield pa.RecordBatch.from_arrays(cols, [key, "source", "form", "h", "literal", "at", "size", "bare", "slots"])

    texts = df.where(f"{key} is not null and text is not null").select(key, F.xxhash64("text").alias("source"), "text")
    return texts.mapInArrow(run, f"{key} long, source long, form int, h long, literal long, at long, size int, bare boolean, slots array<long>")


def _held(n: str, template: str) -> F.Column:
    """Whether shared windows suffice, of an item that has ``n`` windows, ``template`` of them not bare."""
    all_of, some_of = F.least(F.lit(SHARED), n), F.greatest(F.lit(1), F.least(F.lit(SHARED), template))
    one_to_one = (F.size("filled") == F.size(F.array_distinct("filled.own_slots"))) & (F.size("filled") == F.size(F.array_distinct("filled.slots")))
    exact = (F.col("exact_windows") >= all_of) | (F.col("exact_template") >= some_of)
    return exact | ((F.col("n_windows") >= all_of) | (F.col("template_windows") >= some_of)) & one_to_one


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: doc_id, item_id, n_windows (distinct windows of the item that
    the document shares), n_item_windows (both of the form of template that shares most), reparameterised (true if some shared windows hold other slot values than the item's).

    A document holds an item if, in one form of template, it shares SHARED of its windows, or all of them if the item has fewer, and its slot values are one to
    one with the item's over all shared windows of that form, or stand as they do in the item. It also does if that is so for one occurrence
    alone: the shared windows that are as far apart in the document as in the item, whatever else the document shares. Windows with
    fewer plain words than PLAIN (and than tokens) are shared only as they stand; where an item has too few others for SHARED, all
    of the others suffice as well. Items shorter than WINDOW tokens are one window. Rows with a null id or text hold nothing;
    repeated rows count once; other columns are ignored; an empty table gives no pairs."""
    spark = docs.sparkSession
    items = store.written(_template_windows(benchmark, "item_id", tuple(range(1, WINDOW)), True, None).distinct(), "benchmark-windows")
    spots = items.select(F.shiftrightunsigned("h", 64 - BITMAP_BITS).cast("int").alias("at")).distinct().toPandas()["at"].to_numpy(np.int64)
    bits = np.zeros(1 << BITMAP_BITS, np.uint8)  # its size is fixed, whatever the benchmark
    bits[spots] = 1
    lengths = tuple(sorted(r[0] for r in items.select("size").distinct().collect()))  # WINDOW or less: other sizes join with nothing
    found = _template_windows(docs, "doc_id", lengths, False, np.packbits(bits, bitorder="little"))
    template = F.when(~F.col("bare"), F.col("h"))
    needed = items.groupBy("item_id", "form").agg(F.countDistinct("h").alias("n_item_windows"), F.countDistinct(template).alias("n_item_template"))
    own = items.select("item_id", "h", "form", F.col("source").alias("own_source"), F.col("literal").alias("own"), F.col("at").alias("own_at"), F.col("slots").alias("own_slots"), F.exists("slots", lambda x: x != 0).alias("slotted"))
    slots = F.filter(F.arrays_zip("own_slots", "slots"), lambda p: p["slots"] != 0)
    pair = ["doc_id", "item_id", "form"]
    joined = store.written(found.join(own, ["h", "form"]).select(*pair, "source", "own_source", (F.col("at") - F.col("own_at")).alias("shift"), "h", "bare", "slotted", (F.col("literal") == F.col("own")).alias("exact"), slots.alias("pairs")), "shared-windows")

    def distinct(condition: F.Column) -> F.Column:
        return F.size(F.collect_set(F.when(condition, F.col("h"))))

    exact, slotted, bare = F.col("exact"), F.col("slotted"), F.col("bare")
    counts = [
        distinct(F.lit(True)).cast("long").alias("n_windows"), distinct(~bare).alias("template_windows"), distinct(exact).alias("exact_windows"), distinct(exact & ~bare).alias("exact_template"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~bare, F.col("pairs"))))).alias("filled"),
    ]
    # what is shared in several forms counts once in each: forms aren't added up
    pairs = joined.groupBy(*pair).agg(*counts, (distinct(slotted) > distinct(slotted & exact)).alias("changed")).join(needed, ["item_id", "form"])
    occurrences = joined.groupBy(*pair, "source", "own_source", "shift").agg(*counts).join(needed, ["item_id", "form"])
    whole = occurrences.where(_held("n_item_windows", "n_item_template")).select(*pair, F.lit(True).alias("whole")).distinct()
    forms = pairs.join(whole, pair, "left").withColumn("holds", _held("n_item_windows", "n_item_template") | F.coalesce("whole", F.lit(False)))
    most = F.max(F.struct("n_windows", "n_item_windows"))
    told = forms.groupBy("doc_id", "item_id").agg(F.bool_or("holds").alias("holds"), most.alias("most"), F.bool_or("changed").alias("reparameterised")).where("holds")
    return told.select("doc_id", "item_id", F.col("most.n_windows").alias("n_windows"), F.col("most.n_item_windows").alias("n_item_windows"), "reparameterised")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents`` and ``benchmark``; for nulls, repeats and empty tables see ``leaks``."""
    return leaks(store.table(spark, sf_dir, "documents"), store.table(spark, sf_dir, "benchmark"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose text holds a benchmark item go. A text is known by its 64-bit hash, not by its doc_id: rows without one are looked at, and
    others of the same doc_id stay. Null texts stay; all columns stay; an empty table, or an empty benchmark, changes nothing."""
    hit = leaks(docs.select(F.xxhash64("text").alias("doc_id"), "text"), store.table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak")).distinct()
    held = store.checked(hit, "leaks")
    return docs.join(held, docs["text"].isNotNull() & (F.xxhash64(docs["text"]) == held["leak"]), "left_anti")
