"""LM scoring: a log-frequency Bloom filter of quantised n-gram counts.

A count is stored as its level on a logarithmic scale: the filter holds the
n-gram once for every level up to that, and repeated membership probes find the
level again.  A filter is sized from the keys counted to fill it, which are those of
all training text, and cut into slices by key range, so that a worker holds one
slice at a time whatever the input.  The exact unigram base beside it uses a
broadcast head of frequent words and a join for all the others.

The score interpolates bigrams with unigrams.  What bigrams weigh depends on the
level of the word before: Witten-Bell over all contexts of a level, tokens after
them against distinct bigrams of them, so that the chances of all words after a
context sum to 1 but for what the levels round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, lean, settle, small_batches, table
from .hashing import Bloom, chunks, mix, put_keys, split_words, token_hashes

#: The end of a text, a token of its own, and what stands before the first word; no word has a space in it.
END, START = b" end", b" start"
#: Ratio of neighbouring levels, hash functions, parts that filters are built in at least.
BASE, HASHES, LOG_PARTS = 1.5, 3, 8
#: Part of a filter's bits that its keys set at most, least bits of a part, bits of the slice that a worker holds.
FILL, LOG_LEAST, LOG_SLICE = 1 / 3, 14, 28
#: Bytes of a filter that pass the driver at once, a part at least; n-grams that are probed at once.
AT_ONCE, PROBED = 4 << 20, 1 << 18
#: Most words in the head.
HEAD = 300_000
#: What a counting worker holds before it passes it on: words, bigrams.
HELD_WORDS, HELD_BIGRAMS = 600_000, 3_000_000
#: Where pieces of sorted bigrams begin that are packed, and passed on, at once; a range, named by more top bits, lies in one of them.
_PIECES = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)
#: Low bits of a bigram key that give way to the level of its context on the way.
_LEVEL_BITS = 7
_MIX = np.uint64(0x9E3779B97F4A7C15)


def level(count: np.ndarray) -> np.ndarray:
    """Level of a count from 1 up: 1 for 1, then by factors of BASE."""
    return 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def _means() -> np.ndarray:
    """The count that each level stands for: the geometric mean of the whole numbers at its ends; 0 for level 0."""
    out = [0.0]
    for q in range(1, 90):
        low, high = np.ceil(BASE ** (q - 1) - 1e-6), np.ceil(BASE**q - 1e-6) - 1
        out.append(float(np.sqrt(low * max(low, high))))
    return np.array(out)


MEANS = _means()


def level_keys(keys: np.ndarray, q: int, log_parts: int = LOG_PARTS) -> np.ndarray:
    """What is stored for these n-grams at a level; the top bits, which name the part, stay."""
    low = np.uint64((1 << (64 - log_parts)) - 1)
    return (keys & ~low) | (mix(keys + np.uint64(q * int(_MIX) % (1 << 64))) & low)


def probe(bloom: Bloom, keys: np.ndarray) -> np.ndarray:
    """Levels by probing 1, 2, ... until a miss; PROBED n-grams at a time, as probing takes many times their size."""
    out = np.zeros(len(keys), np.uint8)
    for start in range(0, len(keys), PROBED):
        at = np.arange(start, min(start + PROBED, len(keys)))
        q = 1
        while len(at) and q < len(MEANS):
            at = at[bloom.has(level_keys(keys[at], q, bloom.log_parts))]
            out[at] = q
            q += 1
    return out


def _expand(keys: np.ndarray, counts: np.ndarray, log_parts: int = LOG_PARTS) -> np.ndarray:
    """All level keys of n-grams with these counts."""
    top = level(counts)
    return np.concatenate([level_keys(keys[top >= q], q, log_parts) for q in range(1, int(top.max()) + 1)]) if len(keys) else keys


def log_width(keys: int, least: int) -> int:
    """Bits of a part, as a power of two, of which so many keys set FILL at most."""
    return max(least, int(np.ceil(np.log2(max(1, keys) * HASHES / -np.log(1 - FILL)))))


@dataclass(frozen=True)
class Sliced:
    """A filter as slices of equal key ranges, 2**LOG_SLICE bits each at most unless a part is larger."""

    slices: list[Broadcast]
    log_bits: int
    log_parts: int
    fill: float  # part of all bits that is set

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of n-grams."""
        return self.levels_of([keys])[0]

    def levels_of(self, blocks: list[np.ndarray]) -> list[np.ndarray]:
        """Levels of n-grams in blocks, a byte each.

        A slice is read where it is needed, once for all blocks, and not kept, unless
        it is the only one; beside it and the levels, only numbers of one block are held.
        """
        cut = len(self.slices).bit_length() - 1
        if not cut:
            whole = Bloom(self.slices[0].value, self.log_bits, self.log_parts, HASHES)
            return [probe(whole, keys) for keys in blocks]
        out = [np.zeros(len(keys), np.uint8) for keys in blocks]
        for k, shared in enumerate(self.slices):
            held = None
            for keys, found in zip(blocks, out, strict=True):
                at = np.flatnonzero(keys >> np.uint64(64 - cut) == k)
                if len(at):
                    held = held or _Slice(self._read(shared), self.log_bits, self.log_parts, HASHES, k, cut)
                    found[at] = probe(held, keys[at])
        return out

    @staticmethod
    def _read(shared: Broadcast) -> np.ndarray:
        bits = shared.value
        if getattr(shared, "_path", None):  # it can be read from there again
            shared.__dict__.pop("_value", None)
        return bits


class _Slice(Bloom):
    """The part of a filter whose keys have these top bits."""

    def __init__(self, bits: np.ndarray, log_bits: int, log_parts: int, hashes: int, number: int, cut: int):
        super().__init__(bits, log_bits, log_parts, hashes)
        self.first = np.uint64((number << log_bits) >> cut)

    def offset(self, base: np.ndarray) -> np.ndarray:
        return base - self.first


def slice_filter(parts: DataFrame, log_parts: int, keys: int) -> Sliced:
    """Settled rows (part, width, bits) as a filter, one slice after the other through the driver.

    The width comes from all keys; parts come wider, as a part alone does not know
    it, and are folded before they travel.  They reach the driver in their order,
    AT_ONCE bytes a job, so that it holds one slice beside them.
    """
    context = parts.sparkSession.sparkContext
    width = log_width(keys >> log_parts, LOG_LEAST)
    width = min(width, parts.agg(F.min("width")).first()[0] or width)
    log_bits = width + log_parts
    cut = min(log_parts, max(0, log_bits - LOG_SLICE))
    held, step, ones, slices = 1 << (log_parts - cut), 1 << (width - 3), 0, []
    together = max(1, min(held, AT_ONCE // step))

    @lean
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, bits in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                folded = np.bitwise_or.reduce(np.frombuffer(bits.as_buffer(), np.uint8).reshape(-1, step), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([folded.tobytes()], pa.binary())], names=["part", "bits"])

    folded = parts.select("part", "bits").mapInArrow(fold, "part long, bits binary")
    rows = folded.repartitionById((1 << log_parts) // together, F.floor(F.col("part") / together).cast("int")).toLocalIterator()
    row = next(rows, None)
    for k in range(1 << cut):
        bits = np.zeros(held * step, np.uint8)
        while row is not None and row["part"] < (k + 1) * held:
            at = (row["part"] - k * held) * step
            bits[at : at + step] = np.frombuffer(row["bits"], np.uint8)
            row = next(rows, None)
        ones += int(np.bitwise_count(bits).sum(dtype=np.int64))
        slices.append(context.broadcast(bits))
    return Sliced(slices, log_bits, log_parts, ones / (1 << log_bits))


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 1; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _with_ends(tokens: np.ndarray, n: np.ndarray, end, start) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with an end after every text, what stands before each, and the text of each."""
    doc = np.repeat(np.arange(len(n)), n + 1)
    last = np.cumsum(n + 1) - 1
    now = np.empty(len(doc), tokens.dtype)
    inside = np.ones(len(doc), bool)
    inside[last] = False
    now[inside], now[last] = tokens, end
    before = np.empty(len(doc), tokens.dtype)
    before[1:] = now[:-1]
    before[last - n] = start
    return now, before, doc


def bigram_keys(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mix(before * _MIX + now)


def count_words(train: DataFrame, text_col: str) -> DataFrame:
    """Settled: every training word and its count; ends are not words."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                counts = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("c", "sum")])
                held.clear()
                yield from pa.table({"token": counts["token"], "c": counts["c_sum"]}).to_batches()

        for batch in batches:
            texts = batch.column(0)
            for part in chunks(texts):
                at, words, _ = split_words(texts[part])
                held.append(pa.table({"token": words.cast(pa.binary()), "c": pa.array(np.bincount(at, minlength=len(words)), pa.int64())}))
                if sum(x.num_rows for x in held) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    return settle(train.select(text_col).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")))


def _log_ranges(tokens: int) -> int:
    """Ranges that bigrams of so many tokens travel in, as a power of two."""
    return LOG_PARTS + max(0, int(np.ceil(np.log2(max(1, tokens) / (1 << 28)))))


def truncated(keys: np.ndarray, tokens: int) -> np.ndarray:
    """Bigram keys as the filter knows them: the bits that travel."""
    spare = np.uint64(max(_LEVEL_BITS, 24 - _log_ranges(tokens)))
    return (keys >> spare) << spare


def bigram_filter(train: DataFrame, text_col: str, tokens: int, unigrams: Sliced) -> tuple[Sliced, np.ndarray]:
    """The filter of all bigrams of the training text, and what bigrams weigh by the level of their context.

    Bigrams travel as packed arrays by range of their hash, 40 bits each beside
    the range and a byte for the level, so that counting them all moves little
    more than 6 bytes a distinct bigram; the ranges grow in number with the tokens.
    """
    log_ranges = _log_ranges(tokens)
    low, least, mask = np.uint64(64 - log_ranges), LOG_LEAST, np.uint64((1 << _LEVEL_BITS) - 1)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            cuts = [[0, *np.searchsorted(x, _PIECES), len(x)] for x in held]
            for k in range(len(_PIECES) + 1 if held else 0):  # what merging and packing take beside the keys is held for a piece
                keys = np.concatenate([x[at[k] : at[k + 1]] for x, at in zip(held, cuts, strict=True)])
                if len(keys):
                    keys.sort()
                    yield packed(keys)
            held.clear()

        def packed(keys: np.ndarray) -> pa.RecordBatch:
            blobs, more, levels = [], [], []
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            n, keys = np.diff(np.r_[starts, len(keys)]), keys[starts]
            ranges = (keys >> low).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]])
            rest = ((keys << np.uint64(log_ranges)) >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            context = (keys & mask).astype(np.uint8)
            for a, b in zip(cuts, np.append(cuts, len(keys))[1:], strict=True):
                blobs.append(np.ascontiguousarray(rest[a:b]).tobytes())
                levels.append(context[a:b].tobytes())
                often = np.flatnonzero(n[a:b] > 1)
                more.append(np.r_[often, n[a:b][often]].astype(np.int32).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(ranges[cuts]), *(pa.array(x, pa.binary()) for x in (blobs, more, levels))], names=["r", "keys", "more", "levels"])

        for batch in batches:
            texts = batch.column(0)
            for part in chunks(texts):
                at, words, n = split_words(texts[part])
                h = np.concatenate([token_hashes([END, START]), token_hashes(words)])
                now, before, _ = _with_ends(at + 2, n, 0, 1)
                keys = truncated(bigram_keys(h[before], h[now]), tokens)
                keys |= unigrams.levels(mix(h)).astype(np.uint64)[before]
                keys.sort()
                held.append(keys)
                if sum(map(len, held)) > HELD_BIGRAMS:
                    yield from flush()
        yield from flush()

    @lean
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            k, c, q = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(k, kind="stable")
            k, c, q = k[order], c[order], q[order]
            starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            k, c, q = k[starts], np.add.reduceat(c, starts), q[starts]
            expanded, bits = _expand(k, c, log_ranges), {}
            width = log_width(len(expanded), least) + 1
            put_keys(bits, expanded, width, log_ranges, HASHES)
            after, kinds = (np.bincount(q, x, len(MEANS)).astype(np.int64).tolist() for x in (c, None))
            for part, blob in bits.items():
                columns = [[part], [width], [blob.tobytes()], [len(expanded)], [after], [kinds]]
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.int64(), kind, kind), strict=True)], names=["part", "width", "bits", "n", "after", "kinds"])

        for batch in batches:
            for r, blob, more, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != range_:
                    yield from close()
                    range_, held = r, []
                packed = np.zeros((len(blob) // 5, 8), np.uint8)
                packed[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
                keys = ((packed.view("<u8")[:, 0] << np.uint64(24)) >> np.uint64(log_ranges)) | (np.uint64(r) << low)
                n = np.ones(len(keys), np.int64)
                at, many = np.frombuffer(more, np.int32).reshape(2, -1)
                n[at] = many
                held.append((truncated(keys, tokens), n, np.frombuffer(context, np.uint8)))
        yield from close()

    counted = train.select(text_col).mapInArrow(count, "r long, keys binary, more binary, levels binary")
    built = settle(counted.repartition("r").sortWithinPartitions("r").mapInArrow(put, "part long, width int, bits binary, n long, after array<long>, kinds array<long>"))
    stored = built.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sums = built.select(F.posexplode(F.arrays_zip("after", "kinds")).alias("q", "x")).groupBy("q").agg(F.sum("x.after").alias("after"), F.sum("x.kinds").alias("kinds"))
    weight = np.zeros(len(MEANS))
    for r in sums.where("kinds > 0 and q > 0").collect():  # a row a level
        weight[r["q"]] = r["after"] / (r["after"] + r["kinds"])
    return slice_filter(built, log_ranges, stored), weight


def unigram_filter(vocabulary: DataFrame, end_count: int) -> Sliced:
    @lean
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mix(token_hashes(batch.column(0))).view(np.int64)), batch.column(1)], names=["h", "c"])

    ends = vocabulary.sparkSession.createDataFrame([(bytearray(END), end_count), (bytearray(START), end_count)], "token binary, c long").where("c > 0")
    words = vocabulary.unionByName(ends)
    levels = words.agg(F.sum(1 + F.floor(F.log(F.col("c")) / float(np.log(BASE)) + 1e-9))).first()[0] or 0
    width = log_width(int(levels) >> LOG_PARTS, LOG_LEAST)
    keys = words.mapInArrow(hashed, "h long, c long")
    dealt = keys.withColumn("_part", F.shiftrightunsigned("h", 64 - LOG_PARTS).cast("int")).repartition("_part")

    @lean
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            h, c = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            put_keys(held, _expand(h.view(np.uint64), c), width, LOG_PARTS, HASHES)
        for part, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([width], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["part", "width", "bits"])

    return slice_filter(settle(dealt.mapInArrow(put, "part long, width int, bits binary")), LOG_PARTS, int(levels))


def _head(vocabulary: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """The most frequent words, HEAD at most, and their counts: all those from some count up."""
    step = F.floor(F.log2("c") * 4).cast("int")
    sizes = sorted(vocabulary.groupBy(step.alias("s")).count().collect(), reverse=True)  # 256 rows at most
    total, least = 0, None
    for s, n in sizes:
        if (total := total + n) > HEAD:
            break
        least = s
    if least is None:
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    rows = vocabulary.where(step >= least).toArrow().combine_chunks()
    words = rows["token"].cast(pa.binary())
    return (words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words), rows["c"].to_numpy()


def lm_score(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out.  base_score: log10 probability
    under exact add-half unigrams; score: under bigrams interpolated
    with unigrams, counts from the filters.  A null or empty text is one token, its end; a null
    id is never held out; repeated rows count and score each; without training
    rows every token is unknown; an empty table gives an empty one; other
    columns, of whatever name, are not read.  A very long text is held by one
    worker with its bigrams, some 30 bytes a word.
    """
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    train = docs.where(~held_out(id_col))
    vocabulary = count_words(train, text_col)
    ends = train.count()
    words, kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, kinds = words + ends, kinds + (ends > 0)
    below = tokens + 0.5 * (kinds + 1)
    shared = context.broadcast(_head(vocabulary))
    unigrams = unigram_filter(vocabulary, ends)
    bigrams, weight = bigram_filter(train, text_col, tokens, unigrams)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_counts = shared.value
        head_counts = np.append(head_counts, 0)
        for batch in batches:
            texts = batch.column(2)
            keys, waiting, columns = [], [], []  # bigrams of the whole batch are probed together, so that a slice is read once for them
            for part in chunks(texts):
                at, words, n = split_words(texts[part])
                words, size = words.cast(pa.binary()), len(n)
                doc = np.repeat(np.arange(size), n)
                counts = head_counts[pc.fill_null(pc.index_in(words, value_set=head), -1).to_numpy(zero_copy_only=False)]
                each = np.where(counts > 0, np.log10((counts + 0.5) / below), 0.0)
                base = np.bincount(doc, each[at], size) + np.log10((ends + 0.5) / below)
                known = np.bincount(doc, counts[at] > 0, size).astype(np.int64) + (ends > 0)
                rare = np.flatnonzero(counts[at] == 0)
                key = doc[rare] * len(words) + at[rare]
                key.sort()
                starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                often, (of, which) = np.diff(np.r_[starts, len(key)]), np.divmod(key[starts], max(1, len(words)))
                offsets = np.r_[0, np.cumsum(np.bincount(of, minlength=size))].astype(np.int32)
                tail = pa.StructArray.from_arrays([words.take(pa.array(which)), pa.array(often, pa.int64())], names=["token", "tf"])
                columns.append((part, pa.array(n + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.ListArray.from_arrays(pa.array(offsets), tail)))

                h = np.concatenate([token_hashes([END, START]), token_hashes(words)])
                levels = unigrams.levels(mix(h))
                now, before, _ = _with_ends(at + 2, n, 0, 1)
                keys.append(truncated(bigram_keys(h[before], h[now]), tokens))
                waiting.append((levels[now], levels[before]))
            give_back()  # what splitting and counting took, before a slice is read
            found = bigrams.levels_of(keys)
            keys.clear()
            for (part, n, known, base, tail), (now, before), both in zip(columns, waiting, found, strict=True):
                c_now, c_before = MEANS[now], MEANS[before]
                pair = np.minimum(MEANS[both], np.minimum(c_now, c_before))
                chance = weight[before] * pair / np.maximum(c_before, 1) + (1 - weight[before]) * (c_now + 0.5) / below
                score = np.bincount(np.repeat(np.arange(len(n)), n.to_numpy()), np.log10(chance), len(n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], batch.column(1)[part], n, known, base, pa.array(score), tail],
                    names=["doc_id", "held_out", "n_tokens", "known", "base", "score", "tail"],
                )

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, score double, tail array<struct<token: binary, tf: long>>"
    scored = settle(docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema))
    scored = scored.withColumn("_row", F.monotonically_increasing_id())  # over settled rows, so the same each time
    rare = scored.select("_row", F.explode("tail").alias("t")).select("_row", "t.token", "t.tf")
    found = rare.join(vocabulary, "token", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = found.groupBy("_row").agg(
        F.sum(F.col("tf") * F.log10((F.col("c") + 0.5) / F.lit(float(below)))).alias("_base"), F.sum(F.when(F.col("c") > 0, F.col("tf"))).alias("_known")
    )
    return scored.join(sums, "_row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of those not held out."""
    return lm_score(table(spark, sf_dir, "documents"))
