"""Quality classifier: importance resampling between hashed n-gram models.

One generative model counts the hashed n-grams of good labelled text (the
target), another those of all text (raw).  A document's importance weight is the
ratio of its probabilities under the two, and k documents are drawn without
replacement by Gumbel top-k on their log weights.

N-grams are unigrams and bigrams of words and of runs of ASCII signs (a word
after itself is one bigram, whatever the word), and n-grams of the bytes of a word
with a mark at either end; all are hashed into one table.  As documents have 1 to many thousand words, log weights are those of a
text of PER n-grams: the mean log ratio of the document's n-grams times PER.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, small, small_batches, table
from .hashing import PLAIN, chunks, mix, split_words, token_hashes

#: Buckets of hashed n-grams as a power of two, and the parts they are summed in; bytes of n-grams inside words.
LOG_BUCKETS, LOG_PARTS, INSIDE = 20, 10, (5, 6, 7, 8)
#: At most so many labelled documents, by hash of their id, train and calibrate the classifier.
LABELLED = 40_000
#: Pseudo-count; a bucket's ratio counts where so many target n-grams are expected and their number differs by so many deviations.
SMOOTH, LEAST, SIGMA = 1.0, 5.0, 3.5
#: N-grams of the text that log weights are scaled to, about 300 words; seed of the noise.
PER, SEED = 10_000, 20
#: Where k is not given: the part of good calibration documents that may weigh less than the least of the k documents before noise.
REFUSED = 0.01
#: Text worked on at once.
CHUNK = 1 << 20
#: What runs of ASCII signs are split from: all else becomes a space.
SIGNS = np.array([c if 32 < c < 127 and not chr(c).isalnum() else 32 for c in range(256)], np.uint8)
_PAIR, _STEP, _AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3), np.uint64(0x2545F4914F6CDD1D)


def _buckets(h: np.ndarray, family: int) -> np.ndarray:
    return (mix(h ^ np.uint64(family * int(_PAIR) % (1 << 64))) >> np.uint64(64 - LOG_BUCKETS)).astype(np.int64)


def inside_words(words: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and hash of every n-gram of bytes inside the words, each word between two marks."""
    _, at, data = words.buffers()
    wide = np.int64 if pa.types.is_large_string(words.type) else np.int32
    at = np.frombuffer(at, wide)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    length = np.diff(at)
    total = int(at[-1] - at[0]) + 2 * len(words)
    marked = np.zeros(total, np.uint64)  # marks are 0, bytes 1 to 256
    owner = np.repeat(np.arange(len(words)), length + 2)
    if len(words):
        place = np.arange(int(at[-1] - at[0])) + np.repeat(2 * np.arange(len(words)) + 1, length)
        marked[place] = np.frombuffer(data, np.uint8)[at[0] : at[-1]].astype(np.uint64) + np.uint64(1) if data is not None else 0
    count = max(0, total - n + 1)
    h = np.zeros(count, np.uint64)
    for k in range(n):
        h = h * _STEP + mix(marked[k : k + count] + np.uint64(7))
    whole = owner[:count] == owner[n - 1 : n - 1 + count]
    return owner[:count][whole], h[whole]


@dataclass
class Features:
    """Buckets of some texts' n-grams: those in a row of words as (text, bucket), those inside words by distinct word."""

    rows: list[tuple[np.ndarray, np.ndarray]]
    doc: np.ndarray  # text of each word
    word: np.ndarray  # and which distinct word it is
    owner: np.ndarray  # distinct word of each n-gram inside words
    bucket: np.ndarray
    words: np.ndarray  # words of each text
    kinds: int  # distinct words

    @classmethod
    def of(cls, texts: pa.Array | list[str | None]) -> Features:
        rows, kept = [], None
        for family, signs in ((0, PLAIN), (2, SIGNS)):
            at, words, n = split_words(texts, signs)
            doc, h = np.repeat(np.arange(len(n)), n), token_hashes(words)
            rows.append((doc, _buckets(h, family)[at]))
            h, same = h[at], doc[1:] == doc[:-1]
            pair = h[:-1] * _PAIR + h[1:]
            if family == 0:
                pair = np.where(h[:-1] == h[1:], _AGAIN, pair)
            rows.append((doc[1:][same], _buckets(pair, family + 1)[same]))
            if kept is None:
                found = [(o, _buckets(g, 4 + k)) for k in INSIDE for o, g in [inside_words(words, k)]]
                kept = doc, at, np.concatenate([o for o, _ in found]), np.concatenate([b for _, b in found]), n, len(words)
        return cls(rows, *kept)

    def counts(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """N-grams of each bucket in all texts, or in the chosen ones."""
        of = (lambda doc: slice(None)) if chosen is None else (lambda doc: chosen[doc])
        out = np.bincount(np.concatenate([b[of(d)] for d, b in self.rows]), minlength=1 << LOG_BUCKETS)
        often = np.bincount(self.word[of(self.doc)], minlength=self.kinds)
        return out + np.bincount(self.bucket, often[self.owner], 1 << LOG_BUCKETS).astype(np.int64)

    def totals(self, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the ratios of each text's n-grams, and their number."""
        size = len(self.words)
        each, n = np.bincount(self.owner, ratio[self.bucket], self.kinds), np.bincount(self.owner, minlength=self.kinds)
        total, number = np.bincount(self.doc, each[self.word], size), np.bincount(self.doc, n[self.word], size)
        for doc, bucket in self.rows:
            total += np.bincount(doc, ratio[bucket], size)
            number += np.bincount(doc, minlength=size)
        return total, number


def labelled_sample(labels: DataFrame, id_col: str = "doc_id", bound: int = LABELLED) -> DataFrame:
    """Bounded: id, good (quality 1 and not toxic), part (0 calibrates, 1 and 2 train)."""
    mark = F.xxhash64(F.lit(SEED), F.col(id_col))
    per = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("good"))
    return per.orderBy(mark, id_col).limit(bound).select(F.col(id_col).alias("_id"), F.coalesce("good", F.lit(False)).alias("_good"), F.pmod(mark, F.lit(3)).alias("_part"))


def _with_label(docs: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    # the sample's bound makes it safe to broadcast
    return docs.join(F.broadcast(sample), docs[id_col] == sample["_id"], "left")


def train(docs: DataFrame, sample: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> np.ndarray:
    """The log ratio of each bucket: target model, from the good training part, over raw model, from all text."""
    rows = _with_label(docs.select(F.col(id_col).alias("_id_"), F.col(text_col).cast("string").alias("_text")), sample, "_id_").select("_text", (F.col("_good") & (F.col("_part") > 0)).alias("_target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << LOG_BUCKETS), np.int64)
        for batch in batches:
            texts, target = batch.column(0), np.array([bool(x) for x in batch.column(1).to_pylist()])
            for part in chunks(texts, CHUNK):
                found = Features.of(texts[part])
                counts[0] += found.counts()
                if target[part].any():
                    counts[1] += found.counts(target[part])
        step = 1 << (LOG_BUCKETS - LOG_PARTS)
        some = [(k, counts[:, k * step : (k + 1) * step]) for k in range(1 << LOG_PARTS)]
        some = [(k, np.ascontiguousarray(x)) for k, x in some if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()), pa.array([_pack(x) for _, x in some], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[k] = held[k] + _unpack(blob) if k in held else _unpack(blob)
        for k, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["part", "counts"])

    shape = "part int, counts binary"
    summed = rows.mapInArrow(count, shape).repartition(64, "part").mapInArrow(add, shape)
    step = 1 << (LOG_BUCKETS - LOG_PARTS)
    total = np.zeros((2, 1 << LOG_BUCKETS))
    for row in summed.collect():  # 2**LOG_PARTS rows, 2**(LOG_BUCKETS + 4) bytes together, whatever the input
        total[:, row["part"] * step : (row["part"] + 1) * step] = np.frombuffer(row["counts"], np.int64).reshape(2, -1)
    return log_ratios(*total)


def _pack(x: np.ndarray) -> bytes:
    """Non-zero cells as place and two counts, or all cells if that is shorter."""
    at = np.flatnonzero(x.any(axis=0))
    if len(at) * 3 < x.size:
        return b"s" + np.int32(x.shape[1]).tobytes() + at.astype(np.int32).tobytes() + x[:, at].astype(np.int32).tobytes()
    return b"d" + x.astype(np.int32).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    if blob[:1] == b"d":
        return np.frombuffer(blob, np.int32, offset=1).reshape(2, -1).astype(np.int64)
    width = int(np.frombuffer(blob, np.int32, 1, 1)[0])
    rest = np.frombuffer(blob, np.int32, offset=5).reshape(3, -1)
    out = np.zeros((2, width), np.int64)
    out[:, rest[0]] = rest[1:]
    return out


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability by bucket; 0 where the counts are too small or too close to tell them apart."""
    expected = raw * (target.sum() / max(1.0, raw.sum()))
    sure = (expected >= LEAST) & (np.abs(expected - target) >= SIGMA * np.sqrt(expected))
    return np.where(sure, np.log((target + SMOOTH) / (expected + SMOOTH)), 0.0).astype(np.float32)


def weights(texts: pa.Array | list[str | None], ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weight of each text, and its words; a text without n-grams weighs 0."""
    found = Features.of(texts)
    total, number = found.totals(ratio)
    return PER * total / np.maximum(number, 1), found.words


def score(docs: DataFrame, ratio: np.ndarray, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row per row of ``docs``: id, text_hash, log_weight, n_words."""
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # 2**LOG_BUCKETS floats, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for part in chunks(texts, CHUNK):
                weight, n = weights(texts[part], shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], batch.column(1)[part], pa.array(weight, pa.float64()), pa.array(n, pa.int64())], names=["id", "text_hash", "log_weight", "n_words"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, f"id {kind}, text_hash long, log_weight double, n_words long")


def _gumbel(id_col: str) -> Column:
    """Standard Gumbel noise by id: the same in every run."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 1), F.col(id_col)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def top_k_cut(rows: DataFrame, key: str, k: int) -> float:
    """The k-th largest key, to 2**-32: counts by ever finer intervals, 2**16 at most at a time."""
    place = F.floor((F.least(F.lit(32767.0), F.greatest(F.lit(-32768.0), F.col(key))) + 32768.0) * F.lit(float(1 << 32))).cast("long")
    rows, low, left = rows.select(place.alias("p")), 0, k
    for shift in (32, 16, 0):
        here = rows.where((F.col("p") >= low) & (F.col("p") < low + (1 << (shift + 16))))
        found = here.groupBy(F.shiftright(F.col("p") - low, shift).alias("b")).count().collect()  # 65,536 rows at most
        for b, n in sorted(found, reverse=True):
            if left <= n:
                low += b << shift
                break
            left -= n
        else:
            return float("-inf")
    return low / float(1 << 32) - 32768.0


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", k: int | None = None) -> DataFrame:
    """Settled: a row per row of ``docs``: id, text_hash, n_words, log_weight, gumbel_key, kept.

    k, the number of documents drawn: where it is not given, that of documents
    with words whose log weight reaches the REFUSED quantile of the good labelled
    documents that did not train the model.
    """
    small_batches(docs.sparkSession)
    sample = settle(labelled_sample(labels, id_col))
    scored = settle(score(docs, train(docs, sample, text_col, id_col), text_col, id_col).withColumn("gumbel_key", F.col("log_weight") + _gumbel("id")))
    drawn = scored.where("n_words > 0")
    if k is None:
        good = _with_label(scored, sample, "id").where(F.col("_good") & (F.col("_part") == 0) & (F.col("n_words") > 0))
        border = good.agg(F.percentile("log_weight", F.lit(REFUSED))).first()[0]
        k = drawn.where(F.col("log_weight") >= F.lit(float("-inf") if border is None else border)).count()
    cut = top_k_cut(drawn, "gumbel_key", k) if k else float("inf")
    return scored.select("id", "text_hash", "n_words", "log_weight", "gumbel_key", ((F.col("gumbel_key") >= cut) & (F.col("n_words") > 0)).alias("kept"))


def importance_classifier(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", k: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_words, log_weight, gumbel_key, kept.

    Texts without words (null, empty, blank) are not kept.  Without good labels
    all weights are 0 and every text with words is kept.  Labels with a null id
    are ignored; a null id in ``docs`` has no label but is judged as any other;
    repeated ids share their noise; an empty table gives an empty one; other
    columns, of whatever name, are not read.  A very long text is held by one
    worker with its n-grams, some 30 a distinct word of it.
    """
    return fit(docs, labels, text_col, id_col, k).select(F.col("id").alias(id_col), "n_words", "log_weight", "gumbel_key", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", k: int | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns unchanged, whatever their names.

    The rows to drop go by id and hash of the text, so that no text is shuffled
    while they are few enough to broadcast; repeated rows share their fate.
    """
    gone = small(settle(fit(docs, labels, text_col, id_col, k).where("not kept").select(F.col("id").alias("_gone_id"), F.col("text_hash").alias("_gone_text")).distinct()))
    same = docs[id_col].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs[text_col].cast("string")) == gone["_gone_text"])
    return docs.join(gone, same, "left_anti")


def op10_importance_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the production classifier."""
    return importance_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
