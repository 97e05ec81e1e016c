"""Operator 13: packing documents into sequences by the sum of squares.

A document becomes pieces of at most ``CAPACITY`` tokens.  Full pieces are sequences of their own; the others are placed one after
another in the open sequence, or a new one, for which the sum over all gaps of (number of open sequences with that gap) squared becomes
smallest: gaps stay evenly spread, so that whatever comes finds one that it fills.  Within a group the largest pieces
come first, and no more sequences are opened than the group's tokens fill, as long as an open one has room.

A group is what a task holds: GROUP_PIECES pieces or GROUP_TOKENS tokens at most.  The first level packs where documents are read, without a
shuffle.  Sequences that are not full are dissolved and dealt anew, as groups of the next level, until one group is left or dealing no longer
spares sequences; so only a few of all tokens are ever shuffled, and at most one group ends with gaps that could have been shared.

File format: a Parquet row for each sequence: its ids as little-endian 32-bit numbers, and its pieces in order.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from . import store

CAPACITY = 2048
#: Pieces and tokens of a group, at most.
GROUP_PIECES, GROUP_TOKENS = 1 << 14, 1 << 23
#: Bytes of text that are encoded side by side.
SLICE = 2 << 20
#: Levels of packing, at most; each next one holds a small share of the last. A level that spares less than this share of its sequences is the last.
LEVELS, GAIN = 12, 1e-3

#: The text pipeline that the fast path below stands for.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words without characters that normalisation changes other than in case.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ɏ]+")


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, with a memory of what words gave.

    White space always ends a pre-token of this tokenizer, so texts are cut there and each distinct word of a slice is looked up
    once. A word not seen before is cut into its pre-tokens, and new pre-tokens go to the model side by side; the model marks the end of each. Words with
    other scripts or special tokens are encoded by the whole tokenizer, and so are whole texts where the file has another text pipeline."""

    KEEP = 700_000

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        pre = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.words_apart = [x["type"] for x in (told["normalizer"] or {}).get("normalizers", [])] == _NORMALIZERS and [x["type"] for x in pre] == ["Split", "ByteLevel"] and pre[0]["pattern"] == {"Regex": _SPLIT} and told["model"]["end_of_word_suffix"] == "</w>" and not any(x["content"][:-1].isalpha() for x in told["added_tokens"])
        self.split = regex.compile(_SPLIT)
        marks = [i for w, i in told["model"]["vocab"].items() if w.endswith("</w>")]
        self.is_end = np.zeros(max([*told["model"]["vocab"].values(), 0]) + 1, bool)
        self.is_end[marks] = True
        self.special = [x["content"] for x in told["added_tokens"]]
        told |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *pre[1:]]}}
        self.model = Tokenizer.from_str(json.dumps(told)) if self.words_apart else None
        self.pretokens: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _cut(self, word: str) -> str | list[str] | None:
        """The pre-token that a word is, or its pre-tokens; None where only the whole tokenizer can tell."""
        if not (word.isascii() or _PLAIN.fullmatch(word)):
            return None
        low = word.lower()
        if low.isalpha():
            return low
        if low[:-1].isalpha() and not low[-1].isalnum():
            return [low[:-1], low[-1]]
        return None if any(s in word for s in self.special) else self.split.findall(low)

    def _learn_pretokens(self, new: list[str]) -> None:
        for lo in range(0, len(new), 4096):
            part = new[lo : lo + 4096]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = (np.flatnonzero(self.is_end[ids]) + 1) * 4
            if len(ends) != len(part):  # the model left something out
                self.pretokens.update((p, self._whole(p)) for p in part)
                continue
            raw, at = ids.tobytes(), ends.tolist()
            self.pretokens.update(zip(part, map(raw.__getitem__, map(slice, [0, *at[:-1]], at)), strict=True))

    def _learn(self, words: list[str]) -> np.ndarray:
        """Numbers of new words."""
        cuts = list(map(self._cut, words))
        wanted = {c for c in cuts if c.__class__ is str}
        wanted.update(*(c for c in cuts if c.__class__ is list))
        if len(self.pretokens) + len(wanted) >= self.KEEP:
            self.pretokens.clear()
        known = self.pretokens
        self._learn_pretokens([p for p in wanted if p not in known])
        got = [known[c] if c.__class__ is str else self._whole(w) if c is None else b"".join([known[p] for p in c]) for w, c in zip(words, cuts, strict=True)]
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(got), np.uint32)])
        return np.arange(first, first + len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no nulls), one after another, and where each text's ids end."""
        if not self.words_apart:
            got = [self._whole(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(got), np.uint32), np.cumsum(np.fromiter(map(len, got), np.int64, len(got)) // 4)
        parts = pc.ascii_split_whitespace(texts)
        told = parts.flatten().dictionary_encode()
        words = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.number) >= self.KEEP:
            self._forget()
        known = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = self._learn([words[i] for i in new.tolist()])
        word = known[told.indices.to_numpy()]
        size = self.size[word]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.start[word] - ends[:-1], size)]
        at = parts.offsets.to_numpy().astype(np.int64)
        return ids, ends[at[1:] - at[0]]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Pieces (numbers into ``lengths``, each from 1 to ``capacity``) of each sequence, by the sum of squares.

    Placing a piece of s tokens in a sequence of gap g changes the sum of squares by 1 - 2 N(g), plus 2 N(g - s) + 1 if it isn't full then;
    a new sequence by 2 N(capacity - s) + 1. Of equal changes the smallest gap is taken, a new sequence last."""
    open_ = np.zeros(capacity + 1, np.int64)  # N, by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences of each gap
    sequences: list[list[int]] = []
    never = np.int64(1) << 40
    order = np.argsort(-lengths, kind="stable").tolist()
    alone = int((lengths == capacity).sum())  # they come first, and leave no gap
    sequences += [[i] for i in order[:alone]]
    fills = -(-int(lengths.sum()) // capacity)
    for i in order[alone:]:
        s = int(lengths[i])
        has = open_[s:]
        change = np.where(has > 0, 1 - 2 * has, never)
        change[1:] += 2 * open_[1 : capacity + 1 - s] + 1
        if len(sequences) < fills or not has[:-1].any():
            change[-1] = 2 * open_[capacity - s] + 1
        gap = s + int(change.argmin())
        if gap == capacity:
            at = len(sequences)
            sequences.append([i])
        else:
            at = waiting[gap].pop()
            open_[gap] -= 1
            sequences[at].append(i)
        if gap > s:
            waiting[gap - s].append(at)
            open_[gap - s] += 1
    return sequences


PACKED = "sequence_id long, whole boolean, tokens int, n_pieces int, ids binary, pieces array<struct<doc_id: long, piece: int, start: long, length: long>>"
_PIECES = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
_ARROW = pa.schema([("sequence_id", pa.int64()), ("whole", pa.bool_()), ("tokens", pa.int32()), ("n_pieces", pa.int32()), ("ids", pa.binary()), ("pieces", _PIECES)])


class Packer:
    """One task's groups. Sequence ids: level, partition and a running number."""

    def __init__(self, level: int, last: bool, capacity: int):
        from pyspark import TaskContext

        self.next, self.last, self.capacity = (level << 56) | (TaskContext.get().partitionId() << 32), last, capacity
        self.held: list[tuple[dict, bytes]] = []
        self.tokens = 0

    def add(self, doc_id: int | None, piece: int, start: int, ids: bytes) -> Iterator[pa.RecordBatch]:
        self.held.append(({"doc_id": doc_id, "piece": piece, "start": start, "length": len(ids) // 4}, ids))
        self.tokens += len(ids) // 4
        if len(self.held) >= GROUP_PIECES or self.tokens >= GROUP_TOKENS:
            yield from self.done()

    def done(self) -> Iterator[pa.RecordBatch]:
        lengths = np.array([p["length"] for p, _ in self.held], np.int64)
        made = place(lengths, self.capacity)
        for lo in range(0, len(made), 1024):
            part = made[lo : lo + 1024]
            tokens = [int(lengths[s].sum()) for s in part]
            whole = [self.last or n == self.capacity for n in tokens]
            yield pa.RecordBatch.from_pydict({"sequence_id": range(self.next, self.next + len(part)), "whole": whole, "tokens": tokens, "n_pieces": list(map(len, part)), "ids": [b"".join([self.held[i][1] for i in s]) for s in part], "pieces": [[self.held[i][0] for i in s] for s in part]}, schema=_ARROW)
            self.next += len(part)
        self.held, self.tokens = [], 0


def _first_level(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, end = encoder(tokenizer_path), Packer(0, False, capacity), np.array([end_id], np.uint32).tobytes()
        for batch in batches:
            texts = batch.column(1)
            texts = texts.fill_null("") if texts.null_count else texts
            for lo, hi in K.slices(K.text_bytes(texts)[1], SLICE):
                ids, ends = enc.encode(texts.slice(lo, hi - lo))
                raw, a = ids.tobytes(), 0
                for doc_id, b in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), (ends * 4).tolist(), strict=True):
                    own = raw[a:b] + end
                    a = b
                    for piece, at in enumerate(range(0, len(own), 4 * capacity)):
                        yield from packer.add(doc_id, piece, at // 4, own[at : at + 4 * capacity])
        yield from packer.done()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PACKED)


def _next_level(rest: DataFrame, groups: int, level: int, last: bool, capacity: int) -> DataFrame:
    """Dissolved sequences, dealt out evenly; each partition is a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(level, last, capacity)
        for batch in batches:
            for ids, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = 0
                for p in pieces:
                    yield from packer.add(p["doc_id"], p["piece"], p["start"], ids[at : at + 4 * p["length"]])
                    at += 4 * p["length"]
        yield from packer.done()

    return rest.select("ids", "pieces").repartition(groups).mapInArrow(run, PACKED)


def pack(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Sequences (sequence_id, ids, pieces) of all rows of (doc_id, text), written to the shared folder.

    A null or empty text is its end id alone; a null doc_id stays null; rows of one doc_id are documents of their own, repeated rows too; a
    document longer than ``capacity`` is cut into pieces of that size, of which the last may be shorter; other columns are ignored; an empty table
    gives no rows."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    made = store.written(_first_level(docs, tokenizer_path, end_id, capacity), "packed", "whole")
    kept, asked = [], None
    for level in range(1, LEVELS + 1):
        kept.append(made.where("whole"))
        rest = made.where("not whole")
        count = lambda x: F.coalesce(F.sum(F.when(~F.col("whole"), x if isinstance(x, F.Column) else F.col(x))), F.lit(0)).cast("long")
        left, pieces, tokens, sequences = made.agg(count(F.lit(1)), count("n_pieces"), count("tokens"), F.count("*")).first()
        spared = asked is None or asked - sequences >= GAIN * asked
        if level == LEVELS or not spared or left <= -(-tokens // capacity):  # dealing anew didn't help, or can't
            kept.append(rest)
            break
        groups = max(-(-pieces // GROUP_PIECES), -(-tokens // GROUP_TOKENS))
        made, asked = store.written(_next_level(rest, groups, level, groups == 1, capacity), "packed", "whole"), left
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return out.drop("whole", "tokens", "n_pieces")


def piece_rows(sequences: DataFrame) -> DataFrame:
    """One row per piece, read from the sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sequence_id, ids, pieces in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at = 0
                for p in pieces:
                    n = p["length"]
                    rows.append(p | {"ids_crc32": zlib.crc32(ids[4 * at : 4 * (at + n)]), "sequence_id": sequence_id, "offset": at})
                    at += n
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(x.split()[0], pa.int32() if x.split()[0] == "piece" else pa.int64()) for x in schema.split(", ")]))

    return sequences.select("sequence_id", "ids", "pieces").mapInArrow(run, schema)


def op13_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``, packed and read back; for nulls, repeats, long texts and empty tables see ``pack``."""
    return piece_rows(pack(store.table(spark, sf_dir, "documents")))
