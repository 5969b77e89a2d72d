"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch lie end to end in one array of symbols.  Each
round finds every sequence's lowest-rank pair of neighbours and merges it in all
sequences at once; what is left when no pair merges is counted.  The vocabulary
is read from a public tokenizer's file; nothing is trained.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import small_batches, table

SPACE_MARK = "▁"
MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Characters of text worked on at once, pre-tokens remembered by a worker, and
#: the length from which a sequence's merges are taken from a heap one by one.
CHUNK_CHARS, REMEMBERED, LONG = 1 << 20, 400_000, 2048
_NONE = np.iinfo(np.int32).max


class PieceCounter:
    """Counts tokens as a BPE piece model with byte fallback and a dummy prefix would give them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in ids]
        scores = np.array([model.get_score(i) for i in ids])
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError("pieces with a space inside can't be counted by pre-tokens")
        self.known = {p: k for k, p in enumerate(pieces)}
        order = -scores
        ranks = np.searchsorted(np.unique(order), order).astype(np.int32)
        self.width = len(pieces)
        keys, merged = [], []
        eager = np.zeros(self.width, bool)  # symbols that may merge on at once, ahead of others of their rank
        for p, k in self.known.items():
            for cut in range(1, len(p)):
                a, b = self.known.get(p[:cut]), self.known.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    merged.append(k)
                    for part in (a, b):
                        eager[part] |= ranks[k] <= ranks[part]
        at = np.argsort(keys)
        self.keys, self.merged = np.array(keys, np.int64)[at], np.array(merged, np.int32)[at]
        self.pair_rank, self.eager = ranks[self.merged], eager
        self.symbol = np.full(0x110000, -1, np.int32)
        for p, k in self.known.items():
            if len(p) == 1:
                self.symbol[ord(p)] = k
        self.after_space: dict[str, int] = {}
        self.inside: dict[str, int] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of each merged pair; rank _NONE where the pair does not merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(ok, self.pair_rank[at], _NONE), self.merged[at]

    def counts(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each sequence of characters, spaces already marked."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        out = np.zeros(len(sequences), np.int64)
        for k in np.flatnonzero(lengths >= LONG):
            out[k] = self._one_by_one(sequences[k])
        some = np.flatnonzero((lengths > 0) & (lengths < LONG))
        if not len(some):
            return out
        code = np.frombuffer("".join(sequences[k] for k in some).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.symbol[code]
        # a character outside the vocabulary falls back to its bytes
        weight = np.where(sym >= 0, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)).astype(np.int64)
        seq = np.repeat(some, lengths[some])
        out += np.bincount(seq, weight - 1, len(sequences)).astype(np.int64) + np.bincount(seq, minlength=len(sequences))
        rank, new = self._pairs(sym[:-1], sym[1:])
        rank = np.append(np.where(seq[:-1] == seq[1:], rank, _NONE), _NONE)
        new = np.append(new, 0)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(np.r_[starts, len(sym)])
            live = np.repeat(best < _NONE, size)
            if not live.all():
                sym, seq, rank, new, best, size = sym[live], seq[live], rank[live], new[live], best[best < _NONE], size[best < _NONE]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            first = np.r_[True, seq[at[1:]] != seq[at[:-1]]]
            # where the merged symbol can't merge on ahead of its peers, all of them merge now, else the leftmost
            run = np.r_[True, at[1:] != at[:-1] + 1]
            begins = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            even = (np.arange(len(at)) - begins) % 2 == 0
            alone = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            held = np.logical_or.reduceat(self.eager[new[at]], np.flatnonzero(first))
            held = np.repeat(held, np.diff(np.r_[np.flatnonzero(first), len(at)]))
            at = at[np.where(held, np.arange(len(at)) == alone, even)]
            np.subtract.at(out, seq[at], 1)
            sym[at] = new[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = (np.cumsum(keep) - 1)[at]
            sym, seq, rank, new = sym[keep], seq[keep], rank[keep], new[keep]
            touched = np.unique(np.r_[moved, moved[moved > 0] - 1])
            after = np.minimum(touched + 1, len(sym) - 1)
            r, n = self._pairs(sym[touched], sym[after])
            rank[touched] = np.where((touched < after) & (seq[touched] == seq[after]), r, _NONE)
            new[touched] = n
        return out

    def _one_by_one(self, text: str) -> int:
        """The same count for a very long sequence, its merges taken from a heap."""
        sym = [self.known.get(c, -1) for c in text]
        total = sum(1 if s >= 0 else len(c.encode("utf-8", "surrogatepass")) for s, c in zip(sym, text, strict=True))
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        rank, new = self._pairs(np.array(sym[:-1], np.int32), np.array(sym[1:], np.int32))
        heap = [(r, i, sym[i], sym[i + 1], n) for i, (r, n) in enumerate(zip(rank.tolist(), new.tolist(), strict=True)) if r < _NONE]
        heapq.heapify(heap)
        table = self._table()

        def push(i: int, j: int) -> None:
            if i >= 0 and j < len(sym) and (found := table.get(sym[i] * self.width + sym[j] if sym[i] >= 0 and sym[j] >= 0 else -1)):
                heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

        while heap:
            _, i, a, b, n = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= len(sym) or sym[j] != b:
                continue
            total -= 1
            sym[i], sym[j], after[i] = n, -2, after[j]
            if after[i] < len(sym):
                before[after[i]] = i
            push(before[i], i)
            push(i, after[i])
        return total

    @functools.cache  # noqa: B019  one counter lives as long as its worker
    def _table(self) -> dict[int, tuple[int, int]]:
        return {k: (r, n) for k, r, n in zip(self.keys.tolist(), self.pair_rank.tolist(), self.merged.tolist(), strict=True)}

    def texts(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text."""
        if len(self.after_space) + len(self.inside) > REMEMBERED:
            self.after_space, self.inside = {}, {}
        spaced, bare = self.after_space, self.inside
        split, unseen_spaced, unseen_bare = [], set(), set()
        for text in texts:
            rows = []
            for k, line in enumerate(text.split("\n") if text else ()):
                # a line break is never part of a piece; only the first line has the dummy prefix
                line = line.replace(SPACE_MARK, " ")
                words = line.split(" ")
                head = None if k == 0 else words.pop(0)
                if "" in words:
                    marked = SPACE_MARK * (head is None) + line.replace(" ", SPACE_MARK)[len(head or "") :]
                    words = [x[1:] for x in re.findall(f"{SPACE_MARK}+[^{SPACE_MARK}]*", marked)]
                rows.append((head, words))
                unseen_spaced.update(words)
                if head:
                    unseen_bare.add(head)
            split.append(rows)
        for seen, found, mark in ((spaced, unseen_spaced, SPACE_MARK), (bare, unseen_bare, "")):
            fresh = [x for x in found if x not in seen]
            seen.update(zip(fresh, self.counts([mark + x for x in fresh]).tolist(), strict=True))
        return [sum(sum(map(spaced.__getitem__, words)) + (bare[head] if head else 0) for head, words in rows) + max(0, len(rows) - 1) for rows in split]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, model_path: str, text_col: str = "text", id_col: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: id, UTF-8 bytes, tokens, and whether they are over the limit.

    ``model_path`` must exist on every worker.  A null or empty text has 0 bytes
    and 0 tokens; ids are passed on as they are, null and repeated ones too; an
    empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    schema = docs.select(id_col).schema.add("n_bytes", "long").add("n_tokens", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens: list[int] = []
            part: list[str] = []
            size = 0
            for text in texts:
                part.append(text)
                size += len(text)
                if size >= CHUNK_CHARS:
                    tokens += model.texts(part)
                    part, size = [], 0
            tokens += model.texts(part)
            n_bytes = pa.array([len(x.encode("utf-8")) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(tokens, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    out = docs.select(id_col, text_col).mapInArrow(count, schema)
    return out.withColumn("over_limit", out["n_tokens"] > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the production vocabulary."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
