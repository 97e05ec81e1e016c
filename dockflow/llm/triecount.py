"""Operator 10: token counts of a unigram model by dynamic programming over a trie.

The distinct pre-tokens (white-space words, each led by a space) of a slice of texts are sorted, which lays their trie out
level by level: words with a common prefix are neighbours.  The best score of a prefix is computed once for all words that share
it, for a whole level of the trie at a time, from the levels before; a word's terminal node holds its number of tokens.
A document's count is the sum over its words.  A long word is cut wherever no piece of more than one byte crosses, and its distinct parts
go through the trie like words; the best score of a whole is the sum of its parts' scores, so nothing is lost by that.  A part that is itself
longer than a trie should be deep is scored in blocks at once: a block's scores are linear in the last few before it (with min for
sum), so every block is scored from each of these places, and blocks are joined in order.

The pieces are those of a public vocabulary file, its path a parameter; a piece of rank r costs ln(r + 2), a byte
that is no piece falls back to one token of a high cost. Of segmentations of equal cost the one of fewest tokens counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import kernel as K
from . import store

#: Words of as many bytes are cut into parts; parts of more than DEEP bytes are scored by blocks of BLOCK bytes, STRETCH bytes at a time.
WIDE, DEEP, BLOCK, STRETCH = 48, 1024, 512, 1 << 18
_COST = 1 << 32  # one unit of cost in a value; the low bits count tokens
_FAR = 1 << 61  # no way to get there
_FALLBACK = 20_000
_B = K.U64(0x2545F4914F6CDD1D)
_BITS = 21


class Pieces:
    """A vocabulary: costs by piece, and the same by hash and length for whole levels."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cost: dict[bytes, int] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:]:
                self.cost.setdefault(piece, int(round(1000 * np.log(len(self.cost) + 2))))
        self.lengths = sorted({len(p) for p in self.cost} | {1})
        self.longest = max(self.lengths)
        self.single = np.array([self.cost.get(bytes([b]), _FALLBACK) for b in range(256)], np.int64) * _COST + 1
        self.by_length = {}
        for n in self.lengths:
            pieces = [p for p in self.cost if len(p) == n]
            h = np.zeros(len(pieces), np.uint64)
            for j in range(n):
                h = h * _B + np.array([p[j] + 1 for p in pieces], np.uint64)
            turn = np.argsort(h)
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[(K.mix(h) >> K.U64(64 - _BITS)).astype(np.int64)] = True
            self.by_length[n] = (h[turn], (np.array([self.cost[p] for p in pieces], np.int64) * _COST + 1)[turn], bitmap)

    def matches(self, text: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, values) of the pieces of n bytes, two or more, in a text, one n after the other."""
        h = np.zeros(len(text) + 1, np.uint64)
        for n in range(1, min(self.longest, len(text)) + 1):
            h = h[: len(text) - n + 1] * _B + (text[n - 1 :].astype(np.uint64) + K.U64(1))
            if n == 1 or n not in self.by_length or not len(self.by_length[n][0]):
                continue
            known, cost, bitmap = self.by_length[n]
            at = np.flatnonzero(bitmap[(K.mix(h) >> K.U64(64 - _BITS)).astype(np.int64)])
            i = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
            good = known[i] == h[at]
            yield n, at[good], cost[i[good]]

    def parts(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the parts of a text that no piece joins. A space begins a part, as no piece holds one but in front."""
        crossed = np.zeros(len(text) + 1, np.int32)
        for a in range(0, len(text), 16 * STRETCH):
            piece = text[a : a + 16 * STRETCH + self.longest - 1]
            change = np.zeros(len(piece) + 1, np.int64)
            for n, at, _ in self.matches(piece):
                at = at[at < 16 * STRETCH]  # the others begin in the next stretch
                change += np.bincount(at + 1, minlength=len(change)) - np.bincount(at + n, minlength=len(change))
            crossed[a : a + len(change)] += change.astype(np.int32)
        starts = np.flatnonzero(np.cumsum(crossed[:-1], dtype=np.int32) == 0)
        return starts, np.append(starts[1:], len(text))

    def block_count(self, part: np.ndarray) -> int:
        """Tokens of one long part."""
        back, index = self.longest, {n: k for k, n in enumerate(self.lengths)}
        total, last = 0, np.full(back, _FAR)  # the score of the place reached, and those of the places up to there over it
        last[0] = 0
        for a in range(0, len(part), STRETCH):
            b, low = min(len(part), a + STRETCH), max(0, a - back + 1)
            blocks = -(-(b - a) // BLOCK)
            cost = np.full((len(self.lengths), blocks * BLOCK), _FAR)
            cost[index[1]] = 0  # past the end nothing is added
            cost[index[1], : b - a] = self.single[part[a:b]]
            for n, at, value in self.matches(part[low:b]):
                end = low + at + n - a - 1
                cost[index[n], end[end >= 0]] = value[end >= 0]
            cost = np.ascontiguousarray(cost.reshape(len(self.lengths), blocks, BLOCK).transpose(2, 0, 1))
            rows = []  # by how far back, then block, then the place before the block that is its start
            for u in range(back):
                rows.append(np.full((blocks, back), _FAR))
                rows[u][:, u] = 0
            for step in cost:
                value = rows[0] + step[index[1]][:, None]
                for n, k in index.items():
                    hit = np.flatnonzero(step[k] < _FAR) if n > 1 else ()
                    if len(hit):
                        value[hit] = np.minimum(value[hit], rows[n - 1][hit] + step[k, hit][:, None])
                rows = [np.minimum(value, _FAR), *rows[:-1]]
            whole = np.stack(rows, axis=1)
            for block in whole:
                last = (block + last).min(axis=1)
                total += int(last[0])
                last -= last[0]
        return total & (_COST - 1)

    def distinct_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: int) -> np.ndarray:
        """Tokens of distinct strings of a slice, behind ``lead`` spaces."""
        length, tokens = ends - starts, np.zeros(len(starts), np.int64)
        for lo, hi in ((0, 8), (8, 16), (16, WIDE), (WIDE, 256), (256, DEEP + 1)):  # similar lengths pad little
            k = np.flatnonzero((length >= lo) & (length < hi))
            if len(k):
                width = int(length[k].max())
                grid = np.full((len(k), width + lead), 32, np.uint8)
                at = starts[k][:, None] + np.arange(width)
                inside = np.arange(width) < length[k][:, None]
                grid[:, lead:] = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
                tokens[k] = self.trie_counts(grid, length[k] + lead)
        for k in np.flatnonzero(length > DEEP):
            tokens[k] = self.block_count(data[starts[k] : ends[k]])
        return tokens

    def long_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of long words of a slice, by their parts."""
        first = np.concatenate([[0], np.cumsum(ends - starts + 1)])
        text = np.empty(first[-1], np.uint8)
        for f, s, e in zip(first[:-1], starts, ends, strict=True):
            text[f] = 32
            text[f + 1 : f + 1 + e - s] = data[s:e]
        s, e = self.parts(text)
        _, one, back = np.unique(K.range_hashes(text, s, e), return_index=True, return_inverse=True)
        counts = self.distinct_counts(text, s[one], e[one], 0)
        return np.bincount(np.searchsorted(first, s, "right") - 1, counts[back], len(starts)).astype(np.int64)

    def trie_counts(self, grid: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of distinct words: ``grid`` holds their bytes (leading space included), padded, ``size`` how many."""
        count, width = grid.shape
        if not count:
            return np.zeros(0, np.int64)
        padded = np.zeros((count, -(-width // 8) * 8), np.uint8)
        padded[:, :width] = grid
        order = np.lexsort(tuple(padded.view(">u8")[:, ::-1].T))
        grid, size = grid[order], size[order]
        differ = grid[1:] != grid[:-1]
        shared = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), width)])
        numbers = np.arange(count)
        out = np.zeros(count, np.int64)
        best = [np.zeros(count, np.int64)]  # by depth, at the first word below a node
        lead = [np.zeros(count, np.int64)]  # by depth, a word's node
        hashes = {}
        for k in range(1, int(size.max()) + 1):
            alive = size >= k
            head = alive & (shared < k)
            at = np.flatnonzero(head)
            node = np.maximum.accumulate(np.where(head, numbers, 0))
            byte = grid[at, k - 1].astype(np.uint64) + K.U64(1)
            up = lead[k - 1][at]
            value = best[k - 1][up] + self.single[grid[at, k - 1]]
            fresh = {}
            for n in range(1, min(k, self.longest) + 1):
                h = byte if n == 1 else hashes[n - 1][up] * _B + byte
                fresh[n] = np.zeros(count, np.uint64)
                fresh[n][at] = h
                if n not in self.by_length or not len(self.by_length[n][0]):
                    continue
                known, cost, bitmap = self.by_length[n]
                hit = np.flatnonzero(bitmap[(K.mix(h) >> K.U64(64 - _BITS)).astype(np.int64)])
                if len(hit):
                    i = np.minimum(np.searchsorted(known, h[hit]), len(known) - 1)
                    good = known[i] == h[hit]
                    hit, i = hit[good], i[good]
                    value[hit] = np.minimum(value[hit], best[k - n][lead[k - n][at[hit]]] + cost[i])
            hashes = fresh
            level = np.zeros(count, np.int64)
            level[at] = value
            best.append(level)
            lead.append(node)
            if k >= self.longest:
                best[k - self.longest], lead[k - self.longest] = None, None
            end = np.flatnonzero(size == k)
            out[end] = level[node[end]] & (_COST - 1)
        back = np.empty(count, np.int64)
        back[order] = out
        return back


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def count_batch(data: np.ndarray, offsets: np.ndarray, model: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens of each row of a slice."""
    n = len(offsets) - 1
    starts, ends = K.word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    rows = np.searchsorted(offsets, starts, "right") - 1
    _, first, back = np.unique(K.range_hashes(data, starts, ends), return_index=True, return_inverse=True)
    s, e = starts[first], ends[first]
    tokens = np.zeros(len(first), np.int64)
    long = e - s >= WIDE
    tokens[~long] = model.distinct_counts(data, s[~long], e[~long], 1)
    if long.any():
        tokens[long] = model.long_counts(data, s[long], e[long])
    return np.bincount(rows, minlength=n), np.bincount(rows, tokens[back], n).astype(np.int64)


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words and n_tokens of every row. Null and empty texts have none; repeated rows count each; a word of any length
    is segmented as a whole; other columns are ignored; an empty table gives no rows. Nothing is shuffled."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(vocabulary)
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            words, tokens = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for lo, hi in K.slices(offsets, 4 << 20):
                words[lo:hi], tokens[lo:hi] = count_batch(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(tokens)], ["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``; for nulls, repeats and empty tables see ``token_counts``."""
    return token_counts(store.table(spark, sf_dir, "documents"))
