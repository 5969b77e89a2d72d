"""N-gram Jaccard join: rare-first prefix filtering over five-word shingles.

Texts with the same shingle set are one entity from the start, so copies cost
one row each and never pairs.  Entities post the rarest part of their set, the
prefix; two sets similar enough share a posted shingle.  Postings travel packed,
a blob for each task and hash range, and meet in arrays.  Pairs of a shingle's
postings pass length and positional filters, then a suffix filter on prints of
their sets; what is left is verified once on the whole texts, and components grow
from the verified links.  In a group of up to three entities every pair is tried
at once; in a larger one each entity first meets the least and the largest, and
only postings of groups that still span several components meet further: first
one pair a posting, then all that the filters let through, large groups cut into
blocks that meet block by block.  So a large group of near copies costs links in
proportion to its size, and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, small, small_batches, table
from .hashing import build_bloom, chunks, flat_tokens, mix

#: Words of a shingle, and the similarity that links: 100 * intersection >= 75 * union.
WORDS, NUM, DEN = 5, 75, 100
#: Cells and parts of the frequency sketch that orders shingles.
LOG_CELLS, LOG_PARTS = 18, 9
#: Shingles in a cell with more entities than this are dealt out to so many sub-groups.
HOT, SALTS = 200_000, 255
#: Postings that a worker packs or takes apart at once.
HELD = 1_000_000
#: Postings of a group that meet in one block, and blocks of a group at most while they have no more than so many postings.
SPLIT, MOST_BLOCKS, MOST_SPLIT = 256, 64, 200_000
#: Cells of a set's print; rounds of one pair a posting before all pairs left are tried.
LOG_PRINT, ROUNDS = 10, 1
#: Links that one task unites, 16 bytes each; where there are more, they meet by stars in many tasks.
ONE_TASK = 2_000_000
#: Texts whose shingles the verifying worker remembers.
REMEMBERED = 256
#: Names of sets that two different sets may share before the operator gives up; 128 bits tell those apart.
MOST_CLASHES = 10_000
_COEFFICIENTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


#: Bits of a shingle hash that are kept; the others hold the place of the text among those worked on at once.
_KEPT = 53
_DROPPED = np.uint64(64 - _KEPT)


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the text; how many each has.  2**11 texts at most.

    A text with one to four words has one shingle, the whole sequence; one without words none.
    """
    tokens, n = flat_tokens(texts)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), n)
    start = np.cumsum(n) - n
    h = np.zeros(len(tokens), np.uint64)
    for k in range(WORDS):
        h[: max(0, len(tokens) - k)] += tokens[k:] * _COEFFICIENTS[k]
    keep = np.ones(len(tokens), bool)
    for k in range(1, WORDS):
        keep[(start + n - k)[n >= k]] = False  # a shingle would run out of its text
    short = np.flatnonzero((n > 0) & (n < WORDS))
    for i in short:
        s = slice(start[i], start[i] + n[i])
        h[start[i]] = (tokens[s] * _COEFFICIENTS[: n[i]]).sum(dtype=np.uint64) + np.uint64(n[i])
    keep[start[short]] = True
    key = (mix(h[keep]) >> _DROPPED) | (doc[keep] << np.uint64(_KEPT))
    key.sort()
    if len(key):
        key = key[np.r_[True, key[1:] != key[:-1]]]
    return key << _DROPPED, np.bincount((key >> np.uint64(_KEPT)).astype(np.int64), minlength=len(texts)).astype(np.int64)


def set_names(h: np.ndarray, n: np.ndarray, clashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set, the same for equal sets, 0 for empty ones; names known to clash give way to the second."""
    name, other = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        starts = (np.cumsum(n) - n)[some]
        one = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), starts)
        two = np.add.reduceat(mix(h + np.uint64(0x14057B7EF767814F)), starts)
        size = n[some].astype(np.uint64)
        name[some] = mix(one + mix(two) * np.uint64(3) + size)
        other[some] = mix(two + mix(one + size) * np.uint64(5))
    if clashes is not None and len(clashes):
        name = np.where(np.isin(name, clashes), other, name)
    return name, other


def prints_of(h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Each set's parity in 2**LOG_PRINT hash cells; sets differ in at least as many shingles as their prints differ in bits."""
    at = (np.repeat(np.arange(len(n)), n) << LOG_PRINT) | (h >> np.uint64(64 - LOG_PRINT)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(n) << LOG_PRINT) & 1).astype(np.uint8).reshape(len(n), -1)
    return [x.tobytes() for x in np.packbits(odd, axis=1)]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


class _Fresh:
    """Which names a task meets for the first time."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, names: np.ndarray) -> np.ndarray:
        out = np.zeros(len(names), bool)
        for k, x in enumerate(names.tolist()):
            if x and x not in self.seen:
                self.seen.add(x)
                out[k] = True
        return out


def _read(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Settled: a row per row of ``docs`` (id, n, entity, other name, print), and rows of the frequency sketch (part, cells).

    A task gives the print of each entity once.
    """
    step = 1 << (LOG_CELLS - LOG_PARTS)
    names = ["doc_id", "n", "entity", "other", "print", "part", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << LOG_CELLS, np.int32)
        first = _Fresh()
        for batch in batches:
            texts = batch.column(1)
            for part in chunks(texts):
                h, n = shingle_sets(texts[part])
                name, other = set_names(h, n)
                fresh = first(name)
                own = h[np.repeat(fresh, n)]
                cells += np.bincount((own >> np.uint64(64 - LOG_CELLS)).astype(np.int64), minlength=1 << LOG_CELLS).astype(np.int32)
                prints = np.full(len(n), None, object)
                prints[fresh] = prints_of(own, n[fresh])
                size = len(n)
                columns = [batch.column(0)[part], pa.array(n, pa.int64()), _signed(name), _signed(other), pa.array(prints, pa.binary()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        some = [k for k in range(1 << LOG_PARTS) if cells[k * step : (k + 1) * step].any()]
        blobs = pa.array([cells[k * step : (k + 1) * step].tobytes() for k in some], pa.binary())
        empty = [pa.nulls(len(some), pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([*empty, pa.nulls(len(some), pa.binary()), pa.array(some, pa.int32()), blobs], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return settle(rows.mapInArrow(run, "doc_id long, n long, entity long, other long, print binary, part int, cells binary"))


def _frequencies(read: DataFrame) -> np.ndarray:
    """The summed sketch: 2**LOG_CELLS numbers, whatever the input."""
    step = 1 << (LOG_CELLS - LOG_PARTS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(blob, np.int32).astype(np.int64)
                held[k] = held[k] + x if k in held else x
        for k, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["part", "cells"])

    out = np.zeros(1 << LOG_CELLS, np.int64)
    parts = read.where("part is not null").select("part", "cells").repartition(64, "part").mapInArrow(add, "part int, cells binary")
    for row in parts.collect():  # 2**LOG_PARTS rows
        out[row["part"] * step : (row["part"] + 1) * step] += np.frombuffer(row["cells"], np.int64)
    return out


def _entities(rows: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """``rows`` and settled entities (e, first id, n, print), no two different sets under one name; the names that clashed."""

    def grouped(rows: DataFrame) -> DataFrame:
        found = rows.where("n > 0").groupBy(F.col("entity").alias("e"))
        return settle(found.agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.max("print").alias("print"), (F.min("other") != F.max("other")).alias("clash")))

    found = grouped(rows)
    clashes = [r["e"] for r in found.where("clash").select("e").limit(MOST_CLASHES + 1).collect()]
    if len(clashes) > MOST_CLASHES:
        raise ValueError("too many shingle sets share a name")
    if clashes:
        rows = rows.withColumn("entity", F.when(F.col("entity").isin(clashes), F.col("other")).otherwise(F.col("entity")))
        found = grouped(rows)
    return rows, found.select("e", "first", "n", "print"), np.array(clashes, np.int64).view(np.uint64)


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers, in 2 bytes each where they fit, else in 4."""
    return x.astype("<u2" if not len(x) or x.max() < 1 << 16 else "<u4")


def _pack(h: np.ndarray, e: np.ndarray, n: np.ndarray, p: np.ndarray) -> bytes:
    """Postings sorted by shingle: steps between shingles in 5 bytes, places in a table of entities."""
    steps = np.diff(h >> _DROPPED, prepend=np.uint64(0))
    first, steps[:1] = steps[:1].copy(), 0
    wide = 8 if len(steps) and steps.max() >= np.uint64(1 << 40) else 5
    table, at, back = np.unique(e, return_index=True, return_inverse=True)
    columns = [_narrow(x) for x in (back, p, n[at])]
    head = np.array([len(h), len(table), wide, *(x.itemsize for x in columns), int(first[0]) if len(first) else 0], "<i8")
    return head.tobytes() + np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]).tobytes() + table.astype("<u8").tobytes() + b"".join(x.tobytes() for x in columns)


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    size, known, wide, *widths, first = np.frombuffer(blob, "<i8", 7).tolist()
    at = 56
    steps = np.zeros((size, 8), np.uint8)
    steps[:, :wide] = np.frombuffer(blob, np.uint8, size * wide, at).reshape(size, wide)
    at += size * wide
    steps = steps.view("<u8")[:, 0].copy()
    steps[:1] = first
    table = np.frombuffer(blob, "<u8", known, at)
    at += 8 * known
    out = []
    for width, count in zip(widths, (size, size, known), strict=True):
        out.append(np.frombuffer(blob, f"<u{width}", count, at).astype(np.int64))
        at += width * count
    back, p, n = out
    return np.cumsum(steps, dtype=np.uint64) << _DROPPED, table[back], n[back], p


def _postings(docs: DataFrame, cells: np.ndarray, clashes: np.ndarray, ranges: int, text_col: str) -> DataFrame:
    """The prefixes of all entities (shingle, entity, set size, place in rare-first order), packed: range, sub-group, blob.

    A range holds all postings of its shingles; those of hot cells are dealt to sub-groups, each in a range of its own.
    """
    # rank of each cell by frequency: the one order that all tasks sort by
    cell = np.argsort(cells, kind="stable").astype(np.uint32)
    rank = np.empty(len(cells), np.uint32)
    rank[cell] = np.arange(len(cells), dtype=np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast((rank, cell, cells > HOT, clashes))  # 2**LOG_CELLS cells, whatever the input
    rest = np.uint64(_KEPT - LOG_CELLS)  # bits of a hash below those of its cell

    def ranged(h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, cell, hot, clashes = shared.value
        first, held = _Fresh(), []

        def flush() -> pa.RecordBatch:
            out = []
            if held:
                h, e, n, p, s = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                order = np.argsort(h, kind="stable")
                h, e, n, p, s = h[order], e[order], n[order], p[order], s[order]
                cold = s == 0
                r = ranged(h[cold])
                cuts = np.searchsorted(r, np.arange(ranges + 1))
                parts = [x[cold] for x in (h, e, n, p)]
                out = [(k, 0, _pack(*(x[a:b] for x in parts))) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
                for k in np.unique(s[~cold]).tolist():
                    parts = [x[s == k] for x in (h, e, n, p)]
                    r = ranged(mix(parts[0] + np.uint64(k)))
                    out += [(int(x), k, _pack(*(y[r == x] for y in parts))) for x in np.unique(r)]
            r, s, blob = zip(*out, strict=True) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(s, pa.int32()), pa.array(blob, pa.binary())], names=["r", "s", "blob"])

        for batch in batches:
            texts = batch.column(0)
            for part in chunks(texts):
                h, n = shingle_sets(texts[part])
                name, _ = set_names(h, n, clashes)
                fresh = first(name)  # copies in the same task post once
                h, doc = h[np.repeat(fresh, n)], np.repeat(np.flatnonzero(fresh), n[fresh])
                # the text, then the rank of the cell, then what the cell leaves of the hash: sorted as one number
                low = (h >> _DROPPED) & np.uint64((1 << int(rest)) - 1)
                key = (doc.astype(np.uint64) << np.uint64(_KEPT)) | (rank[(h >> np.uint64(64 - LOG_CELLS)).astype(np.int64)].astype(np.uint64) << rest) | low
                key.sort()
                sizes = np.where(fresh, n, 0)
                place = np.arange(len(h)) - (np.cumsum(sizes) - sizes)[doc]
                take = place < (n - (-(-NUM * n // DEN)) + 1)[doc]
                key, doc, place = key[take], doc[take], place[take]
                where = cell[((key >> rest) & np.uint64((1 << LOG_CELLS) - 1)).astype(np.int64)]
                h = (where.astype(np.uint64) << np.uint64(64 - LOG_CELLS)) | ((key & np.uint64((1 << int(rest)) - 1)) << _DROPPED)
                salt = np.where(hot[where], 1 + (name[doc] % np.uint64(SALTS)).astype(np.int64), 0)
                held.append((h, name[doc], n[doc].astype(np.int32), place.astype(np.int32), salt.astype(np.uint8)))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield flush()
        yield flush()

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "r int, s int, blob binary")


def _fits(na, pa_, nb, pb) -> np.ndarray:
    """Length and positional filter: may sets of these sizes that share these places still be similar enough?

    What follows the shared places bounds the intersection; 175 * intersection >= 75 * (na + nb).
    """
    most = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return (DEN * np.minimum(na, nb) >= NUM * np.maximum(na, nb)) & ((NUM + DEN) * most >= NUM * (na + nb))


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, the lesser first."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    one = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return a[one], b[one]


def _shared_only(h: np.ndarray, e: np.ndarray, n: np.ndarray, p: np.ndarray, alone: bool) -> tuple[np.ndarray, ...]:
    """Postings by shingle and entity, each once, of shingles that several entities have; alone: of all."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not alone:
        order = order[np.r_[False, same] | np.r_[same, False]] if len(order) else order
    h, e, n, p = h[order], e[order], n[order], p[order]
    order = np.lexsort((e, h))
    h, e, n, p = h[order], e[order], n[order], p[order]
    one = np.r_[True, (h[1:] != h[:-1]) | (e[1:] != e[:-1])] if len(h) else np.zeros(0, bool)
    h, e, n, p = h[one], e[one], n[one], p[one]
    if alone or not len(h):
        return h, e, n, p
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.diff(np.r_[starts, len(h)])
    keep = np.repeat(size > 1, size)
    return h[keep], e[keep], n[keep], p[keep]


def _meeting(packed: DataFrame, ranges: int) -> DataFrame:
    """Settled: postings (h, e, n, p) of groups of four or more, and pairs (a, b) to try first, distinct within a task.

    All pairs of a group of two or three; in a larger one, and in each sub-group
    of a hot one, every entity with the least and the largest.
    """
    schema = "h long, e long, n int, p int, a long, b long"
    names = ["h", "e", "n", "p", "a", "b"]

    def meet(h, e, n, p, alone: bool) -> Iterator[pa.RecordBatch]:
        h, e, n, p = _shared_only(h, e, n, p, alone)
        if not len(h):
            return
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[starts, len(h)])
        a, b = [], []
        for hub in (starts, starts + size - 1):
            hub = np.repeat(hub, size)
            ok = (np.arange(len(h)) != hub) & _fits(n, p, n[hub], p[hub])
            a.append(e[ok])
            b.append(e[hub[ok]])
        a, b = _distinct(np.concatenate(a), np.concatenate(b))
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none.cast(pa.int32()), none.cast(pa.int32()), _signed(a), _signed(b)], names=names)
        # an entity stays if its own best case leaves room for the smallest fit size or the most that follows in the group
        room = (NUM + DEN) * (n - p) // NUM - n  # the largest partner that its rest allows
        fit = (room >= np.repeat(np.minimum.reduceat(n, starts), size)) & (np.repeat(np.maximum.reduceat(room, starts), size) >= n)
        keep = alone | (fit & np.repeat(size > 3, size))
        h, e, n, p = h[keep], e[keep], n[keep], p[keep]
        none = pa.nulls(len(h), pa.int64())
        yield pa.RecordBatch.from_arrays([_signed(h), _signed(e), pa.array(n.astype(np.int32)), pa.array(p.astype(np.int32)), none, none], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            for s, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                groups.setdefault(s, []).append(_unpack(blob))
        for s in sorted(groups):
            yield from meet(*(np.concatenate(x) for x in zip(*groups.pop(s), strict=True)), s > 0)

    return settle(packed.repartitionById(ranges, "r").mapInArrow(run, schema))


def _near(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """The pairs whose prints do not differ in more shingles than similar sets can."""
    of = lambda x: entities.select(F.col("e").alias(x), F.col("n").alias(f"n{x}"), F.col("print").alias(f"p{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "pa", "pb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = (batch.column(2).to_numpy(zero_copy_only=False) + batch.column(3).to_numpy(zero_copy_only=False)).astype(np.int64)
            bits = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for k in (4, 5)]
            apart = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64)
            keep = pa.array((NUM + DEN) * (size - apart) >= 2 * NUM * size)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _open(meeting: DataFrame, roots: DataFrame, entities: DataFrame) -> DataFrame:
    """Settled postings with component, group size and print, of the shingles whose entities are in several components."""
    named = meeting.join(roots, "e", "left").select("h", "e", "n", "p", F.coalesce("root", "e").alias("root"))
    groups = named.groupBy("h").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count("*").alias("size"))
    found = named.join(groups.where("_lo != _hi").select("h", "size"), "h")
    return settle(found.join(entities.select("e", "print"), "e"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of whole groups of equal first two columns, from rows sorted by them; several groups at a time."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
        cut = int(np.argmax(last))
        if held and (cut or (held[-1][0][-1], held[-1][1][-1]) != (now[0][0], now[1][0])):
            yield tuple(np.concatenate(x) for x in zip(*held, [x[:cut] for x in now], strict=True))
            held = []
        elif cut:
            yield tuple(x[:cut] for x in now)
        held.append([x[cut:] for x in now])
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _cross_pairs(named: DataFrame, one_each: bool) -> DataFrame:
    """Pairs of a shingle's postings in different components that pass all filters.

    Groups over SPLIT are cut into blocks by entity, and each two blocks meet in a
    task of their own.  one_each: of each posting only the first such pair on
    either side, so that components meet in numbers that grow with the postings,
    and the shingles (h) that had more; else every pair.
    """
    blocks = F.greatest(F.least(F.ceil(F.col("size") / SPLIT), F.lit(MOST_BLOCKS)), F.ceil(F.col("size") / MOST_SPLIT)).cast("int")
    dealt = named.withColumn("k", blocks).withColumn("own", F.pmod(F.xxhash64("e"), F.col("k")).cast("int"))
    cell = lambda x: F.least(x, F.col("own")) * F.col("k") + F.greatest(x, F.col("own"))
    dealt = dealt.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), cell)))
    dealt = dealt.select("h", "cell", "own", (F.floor(F.col("cell") / F.col("k")) != F.col("cell") % F.col("k")).alias("two"), "e", "n", "p", "root", "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, cell, own, two, e, n, p, root, bits in _groups(batches):
            order = np.lexsort((e, n, cell, h))
            h, cell, own, two, e, n, p, root, bits = (x[order] for x in (h, cell, own, two, e, n.astype(np.int64), p.astype(np.int64), root, bits))
            bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(h), -1)
            starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (cell[1:] != cell[:-1])])
            for i, j in zip(starts, [*starts[1:], len(h)], strict=True):
                if (root[i:j] == root[i]).all():
                    continue
                # sorted by size: the partners of each entity that the length filter lets through are one slice
                end = i + np.searchsorted(n[i:j], DEN * n[i:j] // NUM, "right")
                todo = np.maximum(end - np.arange(i, j) - 1, 0)
                met, more = np.zeros(j - i, bool), False
                for lo, hi in _blocks(todo):
                    left = np.repeat(np.arange(i + lo, i + hi), todo[lo:hi])
                    off = np.arange(len(left)) - np.repeat(np.cumsum(todo[lo:hi]) - todo[lo:hi], todo[lo:hi])
                    right = left + 1 + off
                    ok = (root[left] != root[right]) & _fits(n[left], p[left], n[right], p[right])
                    if two[i]:
                        ok &= own[left] != own[right]
                    left, right = left[ok], right[ok]
                    both = n[left] + n[right]
                    apart = np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1, dtype=np.int64)
                    ok = (NUM + DEN) * (both - apart) >= 2 * NUM * both
                    left, right = left[ok], right[ok]
                    if one_each and len(left):
                        first = np.zeros(len(left), bool)
                        first[np.unique(left, return_index=True)[1]] = True
                        late, at = np.unique(right, return_index=True)
                        first[at[~met[late - i]]] = True
                        met[late - i] = True
                        more |= not first.all()
                        left, right = left[first], right[first]
                    if len(left):
                        left, right = e[left], e[right]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)), pa.nulls(len(left), pa.int64())], names=["a", "b", "h"])
                if more:
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([h[i]], pa.int64())], names=["a", "b", "h"])

    return settle(dealt.repartition("h", "cell").sortWithinPartitions("h", "cell").mapInArrow(run, "a long, b long, h long"))


def _blocks(todo: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about so many pairs together."""
    total = np.cumsum(todo)
    lo = 0
    while lo < len(todo):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def _texts(docs: DataFrame, pairs: DataFrame, entities: DataFrame, repeated: bool, clashes: np.ndarray, text_col: str, id_col: str) -> DataFrame:
    """Settled: entity and text of the entities in these pairs.

    Texts are fetched by their id: a broadcast of counted size, or a filter sized
    by the count, picks them on the scan, so the others are not shuffled.  Where
    ids are repeated or null the text's set must also have the entity's name.
    """
    wanted = pairs.select(F.col("a").alias("e")).unionByName(pairs.select(F.col("b").alias("e"))).distinct()
    chosen = settle(entities.select("e", F.col("first").alias("_id")).join(wanted, "e"))
    count = chosen.count()
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = small(chosen)
    if ids is chosen:
        log_bits = min(30, max(20, int(np.ceil(np.log2(count * 8)))))
        bloom = docs.sparkSession.sparkContext.broadcast(build_bloom(chosen.select(F.xxhash64("_id").alias("k")), log_bits, 4))

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(bloom.value.has(batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))))

        source = source.withColumn("k", F.xxhash64("doc_id")).mapInArrow(pick, "doc_id long, text string, k long")
    if not repeated:
        return settle(source.join(ids, source["doc_id"] == ids["_id"]).select("e", "text"))

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names = batch.column(1), batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keep = [set_names(*shingle_sets(texts[part]), clashes)[0] == names[part] for part in chunks(texts)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    found = source.join(ids, source["doc_id"].eqNullSafe(ids["_id"])).select("e", "text").mapInArrow(same, "e long, text string")
    return settle(found.groupBy("e").agg(F.first("text").alias("text")))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    left, right = texts.select(F.col("e").alias("a"), F.col("text").alias("ta")), texts.select(F.col("e").alias("b"), F.col("text").alias("tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}

        def known(name: int, text: pa.Array) -> np.ndarray:
            if name not in sets:
                if len(sets) >= REMEMBERED:
                    sets.clear()
                sets[name] = shingle_sets(text)[0]
            return sets[name]

        for batch in batches:
            ok = []
            for k, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                both = np.concatenate((known(a, batch.column(2)[k : k + 1]), known(b, batch.column(3)[k : k + 1])))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                ok.append(DEN * shared >= NUM * (len(both) - shared))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _united(edges: DataFrame) -> DataFrame:
    """Settled components of so few links that one task holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
        if not held:
            return
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = ends[: len(a)], ends[len(a) :]
        label = np.arange(len(names))
        while True:
            least = np.minimum(label[a], label[b])
            before = label.copy()
            for end in (a, b):
                np.minimum.at(label, label[end], least)
                np.minimum.at(label, end, least)
            label = label[label]
            if (label == before).all():
                break
        some = names[label] != names
        yield pa.RecordBatch.from_arrays([pa.array(names[some], pa.int64()), pa.array(names[label][some], pa.int64())], names=["e", "root"])

    return settle(edges.repartition(1).mapInArrow(run, "e long, root long"))


def components(links: DataFrame) -> DataFrame:
    """Entity and least entity of its component, of all but the least ones; by alternating large and small stars."""
    both = lambda x: x.unionByName(x.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = settle(links.select("a", "b").where("a != b").distinct())
    if edges.limit(ONE_TASK + 1).count() <= ONE_TASK:
        return _united(edges)
    seen = None
    while True:
        # large star: larger neighbours of a node go to its least neighbour or itself
        near = both(edges)
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small star: a node and its smaller neighbours go to the least of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("x"), "m", "a")
        edges = settle(small.where("x != m").select(F.col("x").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == seen:
            return edges.select(F.col("a").alias("e"), F.col("b").alias("root"))
        seen = tuple(state)


def _links(docs: DataFrame, entities: DataFrame, repeated: bool, clashes: np.ndarray, cells: np.ndarray, text_col: str, id_col: str) -> DataFrame | None:
    """Entity and least entity of its component, of all entities with links; None if there are none."""
    postings = entities.agg(F.sum(F.floor(F.col("n") / 4) + 1)).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(postings) // HELD))
    met = _meeting(_postings(docs, cells, clashes, ranges, text_col), ranges)
    meeting = met.where("h is not null").select("h", "e", "n", "p")
    tried, links, roots = None, None, None

    def verify(pairs: DataFrame) -> bool:
        """Try these pairs; were there any links?"""
        nonlocal tried, links, roots
        tried = pairs if tried is None else tried.unionByName(pairs)
        if not pairs.limit(1).count():
            return False
        new = settle(_verified(pairs, _texts(docs, pairs, entities, repeated, clashes, text_col, id_col)))
        if not new.limit(1).count():
            return False
        links = new if roots is None else roots.select(F.col("e").alias("a"), F.col("root").alias("b")).unionByName(new)
        roots = components(links)
        return True

    verify(settle(_near(met.where("a is not null").select("a", "b").distinct(), entities)))
    none = entities.limit(0).select("e", F.col("e").alias("root"))
    named = None
    for k in range(ROUNDS + 1):
        named = _open(meeting, none if roots is None else roots, entities)
        if not named.limit(1).count():
            break
        crossed = _cross_pairs(named, k < ROUNDS)
        verify(settle(crossed.where("a is not null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")))
        meeting = meeting.join(crossed.where("h is not null").select("h").distinct(), "h", "left_semi")
    return roots


def jaccard_join(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, entity, component_id.

    component_id: the least doc_id that links reach, its own included.  Texts
    without words (null, empty, blank) have no shingles and link with nothing.  A
    null id counts in a component but never names it unless all are null;
    repeated rows are one entity; an empty table gives an empty one.  Other
    columns, of whatever name, are not read.  A very long text is held by one
    worker with its shingles, some 20 bytes a word.
    """
    small_batches(docs.sparkSession)
    read = _read(docs, text_col, id_col)
    rows, entities, clashes = _entities(read.where("part is null").select("doc_id", "n", "entity", "other", "print"))
    repeated = rows.where("n > 0").groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count() > 0
    roots = _links(docs, entities, repeated, clashes, _frequencies(read), text_col, id_col)
    least = entities.select(F.col("e").alias("_e"), "first")
    if roots is not None:
        least = least.join(roots, least["_e"] == roots["e"], "left").select("_e", "first", F.coalesce("root", "_e").alias("root"))
        by_root = least.groupBy("root").agg(F.min("first").alias("component"))
        least = least.join(by_root, "root").select("_e", "component")
    else:
        least = least.select("_e", F.col("first").alias("component"))
    out = rows.join(least, rows["entity"] == least["_e"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "entity", own.alias("component_id"))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component, that of its least id; all columns unchanged.

    Rows without words or without an id stay.  Of rows with the same id and text one stays.
    """
    joined = settle(jaccard_join(docs, text_col, id_col))
    gone = small(settle(joined.where("n_shingles > 0 and doc_id is not null and doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()))
    kept = docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    repeated = joined.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id", "entity").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates([id_col, text_col]) if repeated else kept


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents joined with all others."""
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
