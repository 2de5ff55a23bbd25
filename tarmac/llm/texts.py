"""Whole batches of texts as flat byte arrays: words, their hashes, windows.

Everything here runs inside tasks, on one Arrow batch at a time, and does per-byte
or per-word work in numpy. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one step works on; a longer single text is a step of its own.
SLICE_BYTES = 2 << 20
#: Most texts that go to a Python worker in one piece.
BATCH_ROWS = 1000

_LONG_WORD = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)

#: Two independent odd bases for window hashes.
BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words that end at ASCII white space.
SPACED = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of lower-case ASCII letters, digits and all non-ASCII characters.
ALNUM = _byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose session is made to send texts in pieces of ``BATCH_ROWS`` rows at
    most: the default of 10,000 is meant for short rows."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(setting)) <= BATCH_ROWS:
        conf.set(setting, str(BATCH_ROWS))
    return docs


def stable_splits(docs: DataFrame) -> DataFrame:
    """``docs``, whose session is made to split files alike in every job.

    Without a least number of splits, Spark takes the cores alive when a job is planned, so a
    lost executor would change the splits between two scans of one operator.
    """
    setting, conf = "spark.sql.files.minPartitionNum", docs.sparkSession.conf
    if conf.get(setting, None) is None:
        cores = conf.get("spark.sql.leafNodeDefaultParallelism", None)
        conf.set(setting, str(cores or docs.sparkSession.sparkContext.defaultParallelism))
    return docs


def with_row(docs: DataFrame, *columns: str) -> DataFrame:
    """``_row`` and the named columns, nothing else.

    ``_row`` tells rows apart even where ids repeat or are null. It depends on how the input
    is split, which ``stable_splits`` keeps alike from job to job for a scan of files. Other
    input is to be written to a table first.
    """
    row = F.monotonically_increasing_id().alias("_row")
    return small_batches(stable_splits(docs)).select(row, *columns)


def with_row_of_all(docs: DataFrame) -> DataFrame:
    """``_row``, the same as ``with_row`` gives, and the whole row as ``doc``."""
    row = F.monotonically_increasing_id().alias("_row")
    return stable_splits(docs).select(row, F.struct("*").alias("doc"))


def hash_share(*columns: str) -> Column:
    """A number from 0 to 1 that depends on the columns only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1) / F.lit(2.0**63)


def lowest_hashes(rows: DataFrame, n: int, column: str) -> DataFrame:
    """The ``n`` rows whose ``column``, which is to be distinct, hashes lowest.

    Twice as many are let through by their hash beforehand, so that no task gets more than
    about 2n rows however many there are; n should be some hundreds at least.
    """
    total = max(1, rows.count())
    near = rows.filter(hash_share(column) <= 2.0 * n / total)
    return near.orderBy(hash_share(column), column).limit(n)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins (one more at the
    end). A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    begins = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(begins), np.int64)
    return np.frombuffer(data, np.uint8)[begins[0] : begins[-1]], begins - begins[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut by rows so that their texts hold about ``most`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(sizes), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(low, high - low)
            low = high


@dataclass
class Words:
    """Words of a batch: byte spans in ``data``, texts as ranges ``first`` of words."""

    data: np.ndarray
    begins: np.ndarray  # of the texts, in bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        """Number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """Words from each one to the end of its text, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.start))

    def bytes_of(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def split_words(column: pa.Array, inside: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of the bytes in ``inside``; ``lower`` folds A-Z first."""
    data, begins = flat(column)
    if lower:
        data = _LOWER[data]
    is_word = inside[data]
    opens, closes = is_word.copy(), is_word.copy()
    if len(data):
        opens[1:] &= ~is_word[:-1]
        closes[:-1] &= ~is_word[1:]
        filled = np.flatnonzero(np.diff(begins))
        heads, tails = begins[filled], begins[filled + 1] - 1
        opens[heads] = is_word[heads]
        closes[tails] = is_word[tails]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return Words(data, begins, start, end, np.searchsorted(start, begins))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    length = words.end - words.start
    h = mix(length.astype(np.uint64) * _STEP + np.uint64(seed))
    if not len(h):
        return h
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    live = np.flatnonzero(length <= _LONG_WORD)
    at = 0
    while len(live):
        rest = length[live] - at
        chunk = eights[words.start[live] + at] & masks[np.minimum(rest, 8)]
        h[live] = mix((h[live] ^ chunk) * _STEP + np.uint64(at + 1))
        at += 8
        live = live[rest > 8]
    for k in np.flatnonzero(length > _LONG_WORD):
        h[k] = xxhash.xxh3_64_intdigest(words.bytes_of(k), seed)
    return h


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order of first appearance, where each appears first, and the
    number of each value's own."""
    import pandas as pd  # here, as most tasks do without it

    which, values = pd.factorize(hashes)
    first = np.empty(len(values), np.int64)
    first[which[::-1]] = np.arange(len(hashes) - 1, -1, -1)
    return values, first, which


def window_hashes(values: np.ndarray, width: int, base: np.uint64 = BASES[0]) -> np.ndarray:
    """Hash of ``values[i:i + width]`` for each i that has so many, whatever text
    they belong to; callers leave out windows that leave their text."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    done, total, power, span = 0, None, values, 1
    rest, factor = width, int(base)
    while rest:
        if rest & 1:
            if total is None:
                total, done = power, span
            else:
                m = len(power) - done
                total = total[:m] * np.uint64(factor) + power[done : done + m]
                done += span
        rest >>= 1
        if rest:
            m = len(power) - span
            power = power[:m] * np.uint64(factor) + power[span : span + m]
            factor = factor * factor % 2**64
            span *= 2
    return mix(total[:n] + np.uint64(width))


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return np.ascontiguousarray(h).view(np.int64)
