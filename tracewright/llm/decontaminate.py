"""Benchmark decontamination by latent semantic retrieval.

Benchmark items, cut into passages, span a latent space: the right singular
vectors of their TF-IDF matrix, by randomised SVD with the matrix products done
on the executors.  Windows of every document are folded in and compared with all
passages by cosine; so are windows that hold a run of an item's words, however
common.  Candidates must then share a long common subsequence of words with the
item, its answer included.  IDF counts every document.  Items are the
stated query set, taken in blocks; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import release, settle, small, small_batches, table
from .hashing import chunks, mix, plain_hashes

#: Words of a passage and of half a window, latent dimensions, extra columns and rounds of the randomised SVD.
PASSAGE, STRIDE, RANK, OVERSAMPLE, ROUNDS, SEED = 48, 24, 320, 16, 2, 7
#: Cells of the document-frequency sketch, parts it is summed in; words in more than this part of documents weigh least.
LOG_CELLS, LOG_PARTS, MAX_DF = 18, 9, 0.2
#: Weight of a word at least, so that no item is without weight, and at most, so that the rare words around a leak don't hide it.
IDF_LEAST, IDF_CAP = 0.1, 4.0
#: Least cosine of a candidate; least part of an item, and of its answer, in common order; part that needs no answer.
COSINE, COMMON, ANSWER, ENOUGH = 0.28, 0.6, 0.5, 0.8
#: Items taken at once, so few that RANK keeps nearly all that sets them apart; items of fewer words must appear whole and unbroken.
BLOCK, SHORT = 250, 8
#: Passages that share a bound.
GROUP = 16
#: Bits of the table that most runs of words are ruled out by.
LOG_RUNS = 20
_RUN = np.uint64(0x9E3779B97F4A7C15)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Documents that have a word of each cell, and documents: a table of fixed size."""
    step = 1 << (LOG_CELLS - LOG_PARTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, rows = np.zeros(1 << LOG_CELLS, np.int32), 0
        for batch in batches:
            texts = batch.column(0)
            rows += len(texts)
            for part in chunks(texts):
                cells += np.bincount(_cells(plain_hashes(texts[part], distinct=True)[0]), minlength=1 << LOG_CELLS).astype(np.int32)
        some = [k for k in range(1 << LOG_PARTS) if cells[k * step : (k + 1) * step].any()]
        blobs = [cells[k * step : (k + 1) * step].tobytes() for k in some]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some], pa.int32()), pa.array([np.int64(rows).tobytes(), *blobs], pa.binary())], names=["part", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(blob, np.int64 if k < 0 else np.int32).astype(np.int64)
                held[k] = held[k] + x if k in held else x
        for k, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["part", "cells"])

    out, rows = np.zeros(1 << LOG_CELLS, np.int64), 0
    shape = "part int, cells binary"
    for row in docs.select(text_col).mapInArrow(count, shape).repartition(64, "part").mapInArrow(add, shape).collect():  # 2**LOG_PARTS rows
        x = np.frombuffer(row["cells"], np.int64)
        if row["part"] < 0:
            rows += int(x[0])
        else:
            out[row["part"] * step : (row["part"] + 1) * step] = x
    return out, rows


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) >> np.uint64(64 - LOG_CELLS)).astype(np.int64)


def idf_table(frequencies: np.ndarray, documents: int) -> np.ndarray:
    weight = np.log((documents + 1) / (frequencies + 1.0))
    return np.where(frequencies > max(1.0, MAX_DF * documents), IDF_LEAST, np.clip(weight, IDF_LEAST, IDF_CAP)).astype(np.float32)


def _runs(tokens: np.ndarray, length: int) -> np.ndarray:
    """A hash of the run of so many words that begins at each word, where one can."""
    count = max(0, len(tokens) - length + 1)
    out = np.zeros(count, np.uint64)
    for k in range(length):
        out = out * _RUN + tokens[k : k + count]
    return out


def _gaussian(tokens: np.ndarray, columns: int) -> np.ndarray:
    """Rows of the random test matrix, made from the tokens' hashes wherever they are needed."""
    a = mix(tokens[:, None] + np.arange(1, columns + 1, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93))
    u = ((a >> np.uint64(40)).astype(np.float64) + 0.5) / (1 << 24)
    v = ((a & np.uint64((1 << 24) - 1)).astype(np.float64) + 0.5) / (1 << 24)
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


def randomized_svd(spark: SparkSession, passages: list[tuple[np.ndarray, np.ndarray]], rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary (sorted token hashes) and right singular vectors of the passages' rows.

    Passages are (tokens, weights); products with the matrix and its transpose are
    sums over passages, computed by the executors.  What comes back is bounded by
    the block of items: passages or vocabulary by rank + OVERSAMPLE numbers.
    """
    columns = min(len(passages), rank + OVERSAMPLE)
    vocabulary = np.unique(np.concatenate([t for t, _ in passages])) if passages else np.zeros(0, np.uint64)
    if not len(vocabulary):
        return vocabulary, np.zeros((0, 0), np.float32)
    rows = spark.createDataFrame(
        [(k, bytearray(t.tobytes()), bytearray(w.astype(np.float64).tobytes())) for k, (t, w) in enumerate(passages)], "k int, t binary, w binary"
    ).repartition(max(1, min(64, len(passages) // 64)))

    def times(right: np.ndarray | None) -> np.ndarray:
        """A @ right; the random matrix for None."""
        shared = spark.sparkContext.broadcast(right)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for t, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    t = np.frombuffer(t, np.uint64)
                    m = _gaussian(t, columns) if shared.value is None else shared.value[np.searchsorted(vocabulary, t)]
                    out.append((np.frombuffer(w) @ m).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["k", "y"])

        y = np.zeros((len(passages), columns))
        for row in rows.mapInArrow(run, "k int, y binary").collect():
            y[row["k"]] = np.frombuffer(row["y"])
        shared.destroy()
        release(spark)
        return y

    def transposed(left: np.ndarray) -> np.ndarray:
        """A.T @ left."""
        shared = spark.sparkContext.broadcast(left)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z = np.zeros((len(vocabulary), columns))
            for batch in batches:
                for k, t, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    np.add.at(z, np.searchsorted(vocabulary, np.frombuffer(t, np.uint64)), np.outer(np.frombuffer(w), shared.value[k]))
            yield pa.RecordBatch.from_arrays([pa.array([z.tobytes()], pa.binary())], names=["z"])

        z = np.zeros((len(vocabulary), columns))
        for row in rows.mapInArrow(run, "z binary").collect():
            z += np.frombuffer(row["z"]).reshape(z.shape)
        shared.destroy()
        release(spark)
        return z

    y = times(None)
    for _ in range(ROUNDS):
        q, _ = np.linalg.qr(y)
        q = np.pad(q, ((0, 0), (0, columns - q.shape[1])))
        z, _ = np.linalg.qr(transposed(q))
        y = times(np.pad(z, ((0, 0), (0, columns - z.shape[1]))))
    q, _ = np.linalg.qr(y)
    q = np.pad(q, ((0, 0), (0, columns - q.shape[1])))
    _, _, right = np.linalg.svd(transposed(q).T, full_matrices=False)
    return vocabulary, np.ascontiguousarray(right[:rank].T.astype(np.float32))


def common_length(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    places: dict[int, int] = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | (1 << k)
    full = (1 << len(item)) - 1
    row = full
    for w in region:
        m = places.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


@dataclass(frozen=True)
class Index:
    """A block of items ready for search; its size is bounded by BLOCK."""

    idf: np.ndarray
    vocabulary: np.ndarray
    gains: np.ndarray  # what a word adds to the inner product with each passage, in latent space
    bounds: np.ndarray  # the most that a word adds for any passage of each group of GROUP
    most: np.ndarray  # and for any passage at all
    owner: np.ndarray  # item of each passage
    items: list[tuple[int, list[int], list[int]]]  # id, words, words of the answer
    sorted_words: list[np.ndarray]  # of each item and its answer
    word_counts: list[np.ndarray]  # of each of them, how often the item has it
    runs: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # by length: table of the hashes' top bits, hashes in order, item of each

    def shared_runs(self, tokens: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and items of the runs of SHORT words, or of whole shorter items, that texts share with items."""
        places, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length, table, hashes, items in self.runs:
            h = _runs(tokens, length)
            at = np.flatnonzero(table[h >> np.uint64(64 - LOG_RUNS)])
            at = at[doc[at] == doc[at + length - 1]]
            first, last = (np.searchsorted(hashes, h[at], side) for side in ("left", "right"))
            n = last - first
            places.append(np.repeat(at, n))
            owners.append(items[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())])
        return np.concatenate(places), np.concatenate(owners)

    @staticmethod
    def _sums(gains, known, piece, word, hopeful, two, total) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the known words' gains by piece of the hopeful windows, and the row of each piece; the last row is 0."""
        need = np.zeros(total + 1, bool)
        need[hopeful] = True
        need[hopeful[two[hopeful]] + 1] = True
        take = np.flatnonzero(known & need[piece])
        at = piece[take]
        cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
        row = np.full(total + 1, -1)
        row[at[cuts]] = np.arange(len(cuts))
        sums = np.add.reduceat(gains[word[take]], cuts, axis=0) if len(at) else np.zeros((0, gains.shape[1]), np.float32)
        return np.vstack([sums, np.zeros((1, gains.shape[1]), np.float32)]), row

    @staticmethod
    def _windows(sums, row, hopeful, two) -> np.ndarray:
        """The sums of windows of two pieces, or of a text's last piece alone."""
        out = sums[row[hopeful]]
        pairs = np.flatnonzero(two[hopeful])
        out[pairs] += sums[row[hopeful[pairs] + 1]]
        return out

    def search(self, texts: list[str | None]) -> list[tuple[int, int, float, float, float]]:
        """(text, item, cosine, common part, common part of the answer) of every leak."""
        tokens, n = plain_hashes(texts)
        start = np.cumsum(n) - n
        doc = np.repeat(np.arange(len(n)), n)
        out: dict[tuple[int, int], tuple[float, float, float]] = {}
        if not len(tokens) or not len(self.vocabulary):
            return []
        pieces = -(-n // STRIDE)
        first = np.cumsum(pieces) - pieces
        piece = first[doc] + (np.arange(len(tokens)) - start[doc]) // STRIDE
        weight = self.idf[_cells(tokens)]
        word = np.minimum(np.searchsorted(self.vocabulary, tokens), len(self.vocabulary) - 1)
        known = (self.vocabulary[word] == tokens) & (weight > 0)
        total = int(pieces.sum())
        square = weight.astype(np.float64) ** 2
        all2 = np.bincount(piece, square, total + 1)
        most = np.bincount(piece[known], self.most[word[known]], total + 1)
        of = np.repeat(np.arange(len(n)), pieces)
        two = np.r_[of[1:] == of[:-1], False]  # the piece and the next are one text's
        all2, most = all2[:-1] + np.where(two, all2[1:], 0), most[:-1] + np.where(two, most[1:], 0)
        # no passage gains more from a window than the most that any gains from each word, and no passage of a group
        # more than the most that one of the group gains: the bounds lose no candidate
        norm = np.sqrt(all2)
        hopeful = np.flatnonzero((most > 0) & (most >= COSINE * norm))
        if len(hopeful):
            sums, row = self._sums(self.bounds, known, piece, word, hopeful, two, total)
            hopeful = hopeful[(self._windows(sums, row, hopeful, two) >= (COSINE * norm[hopeful])[:, None]).any(axis=1)]
        places, owners = self.shared_runs(tokens, doc)
        run_pieces, run_items = np.divmod(np.unique(piece[places] * len(self.items) + owners), len(self.items))
        hopeful = np.union1d(hopeful, run_pieces)
        if len(hopeful):
            sums, row = self._sums(self.gains, known, piece, word, hopeful, two, total)
            cosine = self._windows(sums, row, hopeful, two)
            cosine /= norm[hopeful].astype(np.float32)[:, None]
            rows, passages = np.nonzero(cosine >= COSINE)
            seeds = [(i, k + int(cosine[i, k:end].argmax())) for i, k, end in zip(np.searchsorted(hopeful, run_pieces), *(np.searchsorted(self.owner, run_items, side) for side in ("left", "right")), strict=True)]
            for i, j in [*zip(rows, passages, strict=True), *(x for x in seeds if cosine[x] < COSINE)]:
                d, item = int(of[hopeful[i]]), int(self.owner[j])
                if (d, item) in out and out[d, item][1] == 1.0:
                    out[d, item] = max(out[d, item][0], float(cosine[i, j])), *out[d, item][1:]
                    continue
                _, words, answer = self.items[item]
                a = start[d] + (hopeful[i] - first[d]) * STRIDE
                lo, hi = max(start[d], a - len(words)), min(start[d] + n[d], a + 2 * STRIDE + len(words))
                region = tokens[lo:hi]
                own = self.sorted_words[item]
                place = np.minimum(np.searchsorted(own, region), len(own) - 1)
                mine = own[place] == region
                if np.minimum(np.bincount(place[mine], minlength=len(own)), self.word_counts[item]).sum() < COMMON * len(words):  # a bound on what is in common order
                    continue
                region = region[mine]
                region = region.tolist()
                common = common_length(words, region) / len(words)
                if common < COMMON or (d, item) in out and out[d, item][1] >= common:
                    continue
                answered = common_length(answer, region) / len(answer)
                leak = common >= ENOUGH or answered >= ANSWER
                if len(words) < SHORT:
                    region = tokens[lo:hi].tolist()
                    leak = any(region[k : k + len(words)] == words for k in range(len(region) - len(words) + 1))
                if leak:
                    out[d, item] = float(cosine[i, j]), common, answered
        return [(d, self.items[item][0], *x) for (d, item), x in sorted(out.items())]


def _answer(text: str) -> str:
    """The last sentence, where an item has no answer of its own."""
    rest = text.rstrip().rstrip(".?!")
    return text[max(rest.rfind(x) for x in (".", "?", "!", "\n")) + 1 :]


def build_index(spark: SparkSession, items: list[tuple[int, str, str | None]], idf: np.ndarray) -> Index:
    known, rows, owner = [], [], []
    for name, text, answer in items:
        words, n = plain_hashes([text, answer or _answer(text)])
        if not n[0]:
            continue
        whole, last = words[: n[0]], words[n[0] :]
        known.append((name, whole.tolist(), (last if len(last) else whole).tolist()))
        for k in range(0, max(1, len(whole) - STRIDE), STRIDE):
            passage, count = np.unique(whole[k : k + PASSAGE], return_counts=True)
            weight = count * idf[_cells(passage)]
            keep = weight > 0
            norm = float(np.sqrt((weight**2).sum()))
            if norm > 0:
                rows.append((passage[keep], weight[keep].astype(np.float64) / norm))
                owner.append(len(known) - 1)
    vocabulary, vectors = randomized_svd(spark, rows, RANK)
    latent = np.array([w @ vectors[np.searchsorted(vocabulary, t)] for t, w in rows], np.float32).reshape(len(rows), -1)
    norms = np.linalg.norm(latent, axis=1, keepdims=True)
    # folding a window in is linear, so its words' products with the unit passages can be added up instead
    gains = (vectors * idf[_cells(vocabulary)][:, None]) @ (latent / np.maximum(norms, 1e-9)).T
    groups = range(0, gains.shape[1], GROUP)
    bounds = np.stack([gains[:, k : k + GROUP].max(axis=1) for k in groups], axis=1) if len(groups) and len(gains) else np.zeros((len(gains), 1))
    most = gains.max(axis=1, initial=0).clip(0).astype(np.float64)
    runs = []
    for length in sorted({min(SHORT, len(words)) for _, words, _ in known}):
        own = [(k, _runs(np.array(words, np.uint64), length)) for k, (_, words, _) in enumerate(known) if min(SHORT, len(words)) == length]
        hashes, items_of = np.concatenate([h for _, h in own]), np.concatenate([np.full(len(h), k) for k, h in own])
        order = np.argsort(hashes, kind="stable")
        table = np.zeros(1 << LOG_RUNS, bool)
        table[hashes >> np.uint64(64 - LOG_RUNS)] = True
        runs.append((length, table, hashes[order], items_of[order]))
    sorted_words = [np.array(sorted({*words, *last}), np.uint64) for _, words, last in known]
    counts = [np.bincount(np.searchsorted(own, np.array(words, np.uint64)), minlength=len(own)) for own, (_, words, _) in zip(sorted_words, known, strict=True)]
    return Index(idf, vocabulary, np.ascontiguousarray(gains, np.float32), np.ascontiguousarray(bounds + 1e-6, np.float32), most, np.array(owner, np.int64), known, sorted_words, counts, runs)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, answer_col: str | None) -> Iterator[list[tuple[int, str, str | None]]]:
    """The items in blocks, each repeated text once; items without text or id are no items."""
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    rows = benchmark.where(F.col(text_col).isNotNull() & F.col(item_col).isNotNull()).select(item_col, text_col, answer.alias("_answer")).distinct()
    block: list[tuple[int, str, str | None]] = []
    for row in rows.orderBy(item_col, text_col).toLocalIterator():
        block.append(tuple(row))
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block


def _found(docs: DataFrame, benchmark: DataFrame, text_col: str, id_col: str, item_col: str, item_text_col: str, answer_col: str | None) -> DataFrame | None:
    """Settled: id, text_hash, item_id, cosine, common, answer of every leak; None without items.

    One block of items is searched after the other, so that one index lives at a time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kinds = [docs.schema[id_col].dataType, T.LongType(), benchmark.schema[item_col].dataType, *[T.DoubleType()] * 3]
    names = ["id", "text_hash", "item_id", "cosine", "common", "answer"]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    item_type = to_arrow_type(kinds[2])
    idf, out = None, None
    for block in _blocks(benchmark, item_col, item_text_col, answer_col):
        if idf is None:
            idf = idf_table(*document_frequencies(rows, "text"))
        shared = spark.sparkContext.broadcast(build_index(spark, block, idf))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(2)
                for part in chunks(texts, 1 << 19):
                    found = shared.value.search(texts[part])
                    at = pa.array([part.start + d for d, *_ in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([x[1] for x in found], item_type), *(pa.array([x[k] for x in found], pa.float64()) for k in (2, 3, 4))], names=names)

        part = settle(rows.mapInArrow(run, schema))
        shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, cosine, common, answer.

    Null and empty texts leak nothing and are no items.  Repeated rows give one
    row together; a null doc_id is an id of its own; no items or no documents give
    no rows.  Ties between windows keep the better common part.  Other columns, of
    whatever name, are not read.  A very long text is held by one worker with its
    words, some 60 bytes each.
    """
    out = _found(docs, benchmark, text_col, id_col, item_col, item_text_col, answer_col)
    if out is None:
        shape = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", benchmark.schema[item_col].dataType), *[T.StructField(x, T.DoubleType()) for x in ("cosine", "common", "answer")]])
        return docs.sparkSession.createDataFrame([], shape)
    best = out.groupBy(F.col("id").alias("doc_id"), "item_id").agg(F.max(F.struct("common", "cosine", "answer")).alias("x"))
    return best.select("doc_id", "item_id", *[F.col(f"x.{c}").alias(c) for c in ("cosine", "common", "answer")])


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns unchanged, whatever their names.

    The rows to drop go by id and hash of the text, so that no text is shuffled
    while they are few enough to broadcast.
    """
    out = _found(docs, benchmark, text_col, id_col, item_col, item_text_col, answer_col)
    if out is None:
        return docs
    gone = small(settle(out.select(F.col("id").alias("_gone_id"), F.col("text_hash").alias("_gone_text")).distinct()))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs[text_col].cast("string")) == gone["_gone_text"]), "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document searched for every benchmark item."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
