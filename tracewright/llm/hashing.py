"""Token hashes in flat numpy arrays, and Bloom filters of a fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: What plain words are split from: capitals become small, ASCII signs become spaces.
PLAIN = np.array([c + 32 if 65 <= c <= 90 else c if c > 126 or chr(c).isalnum() else 32 for c in range(256)], np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _M2)
_PLACES = mix(np.arange(1, 4097, dtype=np.uint64) * _M1) | np.uint64(1)


def token_hashes(words: pa.Array | list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: its bytes' numbers times its places' numbers, summed and scrambled."""
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
    if not len(words):
        return np.zeros(0, np.uint64)
    wide = np.int64 if pa.types.is_large_binary(words.type) or pa.types.is_large_string(words.type) else np.int32
    _, at, data = words.buffers()
    at = np.frombuffer(at, wide)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    n = np.diff(at)
    place = np.arange(len(data)) - np.repeat(at[:-1], n)
    if len(place) and int(n.max()) > len(_PLACES):
        factor = mix((place + 1).astype(np.uint64) * _M1) | np.uint64(1)
    else:
        factor = _PLACES[place]
    out = np.zeros(len(words), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        out[some] = np.add.reduceat(_BYTES[data] * factor, at[some])
    return mix(out + n.astype(np.uint64))


def as_texts(texts: pa.Array | list[str | None]) -> pa.Array:
    """Texts as an Arrow array; lists come from small callers only."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not isinstance(texts, pa.Array):
        texts = pa.array([None if t is None else t.encode("utf-8", "surrogatepass") for t in texts], pa.binary())
    return texts.view(pa.string()) if texts.type == pa.binary() else texts.cast(pa.string()) if texts.type == pa.null() else texts


def _translated(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """The texts with each byte replaced, none of them null."""
    texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, at, data = texts.buffers()
    at = np.frombuffer(at, wide)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, wide)
    data = table[np.frombuffer(data, np.uint8)[at[0] : at[-1]]] if data is not None else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(np.ascontiguousarray(at - at[0])), pa.py_buffer(data)])


def split_words(texts: pa.Array | list[str | None], table: np.ndarray | None = None, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of all texts end to end, as places among the distinct words; those; words of each text.

    lower: A-Z first become a-z.  table: every byte is replaced by this table's first.
    """
    texts = as_texts(texts)
    if table is not None:
        texts = _translated(texts, table)
    elif lower:
        texts = pc.ascii_lower(texts)
    texts = pc.ascii_trim_whitespace(texts)
    texts = pc.if_else(pc.greater(pc.binary_length(texts), 0), texts, pa.scalar(None, texts.type))
    lists = pc.ascii_split_whitespace(texts)
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().dictionary_encode()
    return flat.indices.to_numpy(zero_copy_only=False), flat.dictionary, n


def flat_tokens(texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of all texts, A-Z lowered, end to end; words of each text."""
    at, words, n = split_words(texts)
    return token_hashes(words)[at], n


def plain_hashes(texts: pa.Array | list[str | None], distinct: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """As flat_tokens, of words split at signs too; distinct: each word of a text once, in any order."""
    at, words, n = split_words(texts, PLAIN)
    h = token_hashes(words)
    if distinct and len(at):
        key = np.repeat(np.arange(len(n)), n) * len(words) + at
        key.sort()
        doc, at = np.divmod(key[np.r_[True, key[1:] != key[:-1]]], len(words))
        n = np.bincount(doc, minlength=len(n))
    return h[at], n


#: Texts that are worked on at once.
CHUNK_ROWS = 2000


def chunks(texts: pa.Array, size: int = 1 << 21) -> Iterator[slice]:
    """Slices of texts with about so many bytes each, CHUNK_ROWS texts at most."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(total):
        full = int(np.searchsorted(total, (total[start - 1] if start else 0) + size, "left")) + 1
        end = min(full, start + CHUNK_ROWS, len(total))
        yield slice(start, end)
        start = end


class Bloom:
    """2**log_bits bits in 2**log_parts parts; a key's bits all lie in the part that its top bits name."""

    def __init__(self, bits: np.ndarray, log_bits: int, log_parts: int, hashes: int):
        self.bits, self.log_bits, self.log_parts, self.hashes = bits, log_bits, log_parts, hashes

    @staticmethod
    def places(keys: np.ndarray, log_part_bits: int, hashes: int) -> Iterator[np.ndarray]:
        """Bits of the keys inside their part, one array for each hash."""
        a = mix(keys)
        b = (a >> np.uint64(33)) | np.uint64(1)
        mask = np.uint64((1 << log_part_bits) - 1)
        for i in range(hashes):
            yield (a + np.uint64(i) * b) & mask

    def offset(self, base: np.ndarray) -> np.ndarray:
        """Where parts that begin at these bits of the whole filter begin in ``bits``."""
        return base

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], np.uint64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which keys may be in; all that were put in are."""
        width = self.log_bits - self.log_parts
        base = self.offset((keys >> np.uint64(64 - self.log_parts)) << np.uint64(width))
        left = np.arange(len(keys))
        for k, place in enumerate(self.places(keys, width, self.hashes)):
            at = base[left] | place[left] if k else base | place
            # only keys that every bit so far speaks for are looked at again
            left = left[(self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        out = np.zeros(len(keys), bool)
        out[left] = True
        return out


def put_keys(held: dict[int, np.ndarray], values: np.ndarray, width: int, log_parts: int, hashes: int) -> None:
    """Set the bits of the keys in the parts held so far, 2**width bits each."""
    parts = (values >> np.uint64(64 - log_parts)).astype(np.int64)
    order = np.argsort(parts, kind="stable")
    values, parts = values[order], parts[order]
    cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else np.zeros(0, np.int64)
    for a, b in zip(cuts, np.append(cuts, len(parts))[1:], strict=True):
        bits = held.setdefault(int(parts[a]), np.zeros(1 << (width - 3), np.uint8))
        for place in Bloom.places(values[a:b], width, hashes):
            np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))


def collect_bloom(parts: DataFrame, log_bits: int, log_parts: int, hashes: int) -> Bloom:
    """The filter from rows (part, bits); rows of the same part are united."""
    step = 1 << (log_bits - log_parts - 3)
    bits = np.zeros(1 << (log_bits - 3), np.uint8)
    for row in parts.collect():  # 2**log_bits bits together
        bits[row["part"] * step : (row["part"] + 1) * step] |= np.frombuffer(row["bits"], np.uint8)
    return Bloom(bits, log_bits, log_parts, hashes)


def build_bloom(keys: DataFrame, log_bits: int, hashes: int, expand=None, log_parts: int = 6) -> Bloom:
    """A Bloom filter of the longs in the first column of ``keys``, built by part in the executors.

    ``expand(batch)`` turns a batch into the uint64 keys to put in; by default its
    first column is.  The parts that reach the driver hold 2**log_bits bits
    together, whatever the number of keys; a key is placed by the top bits of its
    first column, and ``expand`` must keep those.
    """
    width = log_bits - log_parts
    name = keys.columns[0]
    dealt = keys.withColumn("_part", F.shiftrightunsigned(F.col(name), 64 - log_parts).cast("int")).repartition(1 << min(log_parts, 5), "_part")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            values = expand(batch) if expand else batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            put_keys(held, values, width, log_parts, hashes)
        for part, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["part", "bits"])

    return collect_bloom(dealt.mapInArrow(put, "part int, bits binary"), log_bits, log_parts, hashes)
