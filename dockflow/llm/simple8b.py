"""Operator 8: token ids in Simple-8b words.

Each 64-bit word holds a 4-bit selector and as many equal-width ids as fit.  Packing restarts at every block of
``BLOCK_IDS`` values, and a file row keeps the word offset of each of its blocks: blocks are packed and unpacked side by
side with array operations, and any block can be read alone.  A value of 61 bits or more is an escape: selector 0 points
into a list of raw 64-bit values.

File format: a Parquet folder, one row for each run of whole documents (about ``ROW_IDS`` ids), written in ascending
document order; ``part`` and ``seq`` give the order of the rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store

#: Values in a word and bits of each, by selector; selector 0 is an escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK_IDS = 1024
ROW_IDS = 1 << 20
#: Characters of a text that the range of its row depends on, besides doc_id.
TIE_CHARS = 32

FILE_SCHEMA = "part int, seq int, start_in_part long, n_docs int, n_ids long, words binary, blocks binary, escapes binary, doc_words binary, doc_blocks binary, doc_escapes binary, len_words binary, len_blocks binary, len_escapes binary, null_ids binary"


_SHORT = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _bit_lengths(v: np.ndarray) -> np.ndarray:
    if not len(v) or int(v.max()) < 1 << 16:
        return _SHORT[v]
    out = np.zeros(len(v), np.uint8)
    rest = v.astype(np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1 << step)
        out[big] += step
        rest = np.where(big, rest >> np.uint64(step), rest)
    return out + (rest > 0).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unsigned 64-bit values to (words, word offset of each block, escaped values)."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32), np.zeros(0, np.uint64)
    blocks = -(-n // BLOCK_IDS)
    pad = int(COUNTS.max())
    grid = np.zeros((blocks, BLOCK_IDS + pad), np.uint64)
    flat = np.zeros(blocks * BLOCK_IDS, np.uint64)
    flat[:n] = v
    grid[:, :BLOCK_IDS] = flat.reshape(blocks, BLOCK_IDS)
    need = _bit_lengths(flat).reshape(blocks, BLOCK_IDS)
    need = np.concatenate([need, np.zeros((blocks, pad), np.uint8)], axis=1)
    best = np.where(need[:, :BLOCK_IDS] > 60, np.uint8(0), np.uint8(15))
    widest, span = need.copy(), 1  # most bits needed by the next `span` values
    for s in range(14, 0, -1):
        while span < COUNTS[s]:
            step = min(span, int(COUNTS[s]) - span)
            widest[:, :-step] = np.maximum(widest[:, :-step], widest[:, step:])
            span += step
        best = np.where(widest[:, :BLOCK_IDS] <= BITS[s], np.uint8(s), best)
    jump = COUNTS[best]
    jump, best = jump.ravel(), best.ravel()
    at = np.arange(blocks) * BLOCK_IDS
    last = np.minimum(at + BLOCK_IDS, n)
    starts = []
    while len(at):  # one word of every block at a time
        starts.append(at)
        at = at + jump[at]
        go = at < last
        if not go.all():
            at, last = at[go], last[go]
    place = np.sort(np.concatenate(starts))
    block, start = place // BLOCK_IDS, place % BLOCK_IDS
    chosen = best[place]
    wide = BLOCK_IDS + pad
    place = block * wide + start
    grid = grid.ravel()
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        if BITS[s] == 0 or s == 0:
            continue
        k = np.flatnonzero(chosen == s)
        for j in range(int(COUNTS[s])):
            words[k] |= grid[place[k] + j] << np.uint64(j * int(BITS[s]))
    k = np.flatnonzero(chosen == 0)
    escapes = grid[place[k]]
    words[k] = np.arange(len(k), dtype=np.uint64)
    return words, np.concatenate([[0], np.cumsum(np.bincount(block, minlength=blocks))]).astype(np.uint32), escapes


def decode(words: np.ndarray, blocks: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n values that ``encode`` packed."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    ends = np.cumsum(counts)
    per = np.diff(blocks.astype(np.int64))
    block = np.repeat(np.arange(len(per)), per)
    base = np.concatenate([[0], ends])[blocks[:-1].astype(np.int64)]
    inside = ends - counts - base[block]
    start, stop = block * BLOCK_IDS + inside, np.minimum((block + 1) * BLOCK_IDS, n)
    out = np.zeros(n, np.uint64)
    for s in np.unique(chosen):
        k = np.flatnonzero(chosen == s)
        if s == 0:
            out[start[k]] = escapes[words[k].astype(np.int64)]
        elif BITS[s]:
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for j in range(int(COUNTS[s])):
                ok = k[start[k] + j < stop[k]]
                out[start[ok] + j] = (words[ok] >> np.uint64(j * int(BITS[s]))) & mask
    return out


#: Latin letters, digits and ASCII symbols but the apostrophe: runs of one kind, space-led or not, are pre-tokens, and so is a line end
#: between two of them.
_LATIN = "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f"
_RUN = re.compile(rf" ?(?:[{_LATIN}]+|[0-9]+|[!-&(-/:-@\[-`{{-~]+)|\n(?=\S)")
#: A space that starts a pre-token, and one that may not.
_SPACE, _LOOSE = re.compile(r" (?=\S)"), re.compile(r" (?!\S)")


class Encoder:
    """Token ids of whole texts by the ``tokenizers`` library, with a memory of what each pre-token gave.

    A text of plain runs, with single line ends between them, is cut into its pre-tokens, which go straight to the model, a new one
    once per worker. Any other text is cut at each space before a character that is no white space, where byte-level pre-tokenisation always starts
    anew, and its pieces are encoded and remembered likewise. A text with a special token that holds a space is encoded whole."""

    KEEP = 700_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        pre = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {c: pre.pre_tokenize_str(chr(c))[0][0] for c in [10, *range(32, 127), *range(0xC0, 0x250)]}
        self.pieces, self.tokens = _Memory(lambda p: self._piece(" " + p)), _Memory(self._model)
        self.number = [array("I", [i]).tobytes() for i in range(self.tok.get_vocab_size())]
        self.special = [x.content for x in self.tok.get_added_tokens_decoder().values()]

    def _model(self, pretoken: str) -> bytes:
        spelled = pretoken.replace(" ", self.table[32]) if pretoken.isascii() and pretoken != "\n" else pretoken.translate(self.table)
        return b"".join([self.number[x.id] for x in self.tok.model.tokenize(spelled)])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _plain(self, text: str) -> bytes | None:
        runs = _RUN.findall(text)
        return b"".join(map(self.tokens.__getitem__, runs)) if sum(map(len, runs)) == len(text) else None

    def _piece(self, piece: str) -> bytes:
        got = None if any(s in piece for s in self.special) else self._plain(piece)
        return self._whole(piece) if got is None else got

    def ids(self, text: str) -> bytes:
        """Ids of a text, as little-endian 32-bit numbers."""
        for memory in (self.pieces, self.tokens):
            if len(memory) >= self.KEEP:
                memory.clear()
        special = [s for s in self.special if s in text]
        if any(" " in s for s in special):
            return self._whole(text)
        got = None if special else self._plain(text)
        if got is not None:
            return got
        first, *parts = text.split(" ") if _LOOSE.search(text) is None else _SPACE.split(text)
        return (self._piece(first) if first else b"") + b"".join(map(self.pieces.__getitem__, parts))


class _Memory(dict):
    """What strings gave; a new one is encoded when it is asked for."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        got = self[text] = self.encode(text)
        return got


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _packed(values: np.ndarray, name: str) -> dict:
    words, blocks, escapes = encode(values)
    return {f"{name}words": words.tobytes(), f"{name}blocks": blocks.tobytes(), f"{name}escapes": escapes.tobytes()}


def _file_row(part: int, seq: int, start: int, docs: list, lengths: list[int], chunks: list[bytes]) -> dict:
    ids = np.frombuffer(b"".join(chunks), np.uint32)
    known = np.array([0 if d is None else d for d in docs], np.int64)
    delta = np.diff(known, prepend=0)
    return {"part": part, "seq": seq, "start_in_part": start, "n_docs": len(docs), "n_ids": len(ids), "null_ids": np.array([d is None for d in docs], bool).tobytes()} | _packed(ids, "") | _packed(((delta << 1) ^ (delta >> 63)).view(np.uint64), "doc_") | _packed(np.array(lengths, np.uint64), "len_")


def write_token_file(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encode ``docs`` (doc_id, text) and write the ids to ``path`` in ascending doc_id order.

    A null text is empty and still gets its end id; a null doc_id sorts first; rows with the same doc_id stand in order of
    text; other columns are ignored; no rows make an empty folder with the schema. Documents are range-partitioned by
    doc_id and the first characters of the text (which part the rows of one id, and keep the sample of keys that comes to the driver
    small); a task streams its range, sorted, and holds one file row of it. A lost task is encoded anew from its own range."""
    spark = docs.sparkSession
    schema = spark.createDataFrame([], FILE_SCHEMA).schema
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, end = encoder(tokenizer_path), TaskContext.get().partitionId(), np.array([end_id], np.uint32).tobytes()
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        docs, lengths, chunks, seq, start, held = [], [], [], 0, 0, 0

        def row():
            r = _file_row(part, seq, start, docs, lengths, chunks)
            return pa.RecordBatch.from_pydict({n: [r[n]] for n in names}, schema=arrow)

        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = enc.ids(t.as_py() or "")
                docs.append(d)
                lengths.append(len(got) // 4 + 1)
                chunks += (got, end)
                held += lengths[-1]
                if held >= ROW_IDS:
                    yield row()
                    docs, lengths, chunks, seq, start, held = [], [], [], seq + 1, start + held, 0
        if docs:
            yield row()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id"), F.substring("text", 1, TIE_CHARS)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(path)


def read_token_file(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and with
    ``keep_ids`` the ids themselves. Only one number per written partition is broadcast."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("part").agg(F.sum("n_ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("part_start"))
    joined = rows.join(F.broadcast(before), "part").drop("seq", "part", "n_ids")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                def series(name: str, n: int, r=r) -> np.ndarray:
                    return decode(np.frombuffer(r[f"{name}words"], np.uint64), np.frombuffer(r[f"{name}blocks"], np.uint32), np.frombuffer(r[f"{name}escapes"], np.uint64), n)

                lengths = series("len_", r["n_docs"]).astype(np.int64)
                zig = series("doc_", r["n_docs"])
                docs = np.cumsum((zig >> np.uint64(1)).view(np.int64) ^ -(zig & np.uint64(1)).view(np.int64))
                ids = series("", int(lengths.sum())).astype(np.uint32)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                cols = [pa.array(docs, mask=np.frombuffer(r["null_ids"], bool)), pa.array(ends - lengths + r["part_start"] + r["start_in_part"]), pa.array(lengths), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, schema)


def token_file(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 0) -> DataFrame:
    """Write ``docs`` as a token file in the shared folder and read it back, one row per document."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    path = store.scratch(docs.sparkSession, "tokens")
    write_token_file(docs, path, tokenizer_path, end_id)
    return read_token_file(docs.sparkSession, path)
